"""The command line, inside the test session."""

import json

from test_jobs import land

from captide.__main__ import main


def run(capsys, *argv):
    code = main([str(a) for a in argv])
    out = capsys.readouterr()
    return code, json.loads((out.out if out.out.strip() else out.err).strip().splitlines()[-1])


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    where = ("--store", tmp_path / "store")
    assert run(capsys, "transform", *where)[0] == 1
    assert run(capsys, "create", *where)[1]["result"]["status"] == "ok"
    landing = land(tmp_path / "a", ["v1"], captions=["v1"])
    code, out = run(capsys, "ingest", *where, "--landing", landing, "--playlist", "PL1")
    assert (code, out["result"]["ok"]) == (0, 1)
    assert run(capsys, "validate", *where)[0] == 1
    assert run(capsys, "transform", *where)[1]["result"]["processed"] == 1
    assert run(capsys, "validate", *where)[0] == 0
    broken = land(tmp_path / "b", ["v1"], returncode=1)
    assert run(capsys, "refresh", *where, "--landing", broken, "--playlist", "PL1")[0] == 1
