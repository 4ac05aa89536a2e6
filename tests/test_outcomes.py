"""Outcome, date and landing-name expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from captide.functions import outcomes as O
from captide.sources import landing


def one(spark, schema, row, expression):
    return spark.createDataFrame([row], schema).select(expression).first()[0]


@pytest.mark.parametrize(
    ("code", "stderr", "want"),
    [
        (0, "429", "ok"),
        (1, "HTTP Error 429: Too Many Requests", "rate_limited"),
        (1, "Rate Limit reached", "rate_limited"),
        (1, "There are no subtitles for this", "no_subtitles"),
        (1, "No automatic captions", "no_subtitles"),
        (1, "subtitles not available", "no_subtitles"),
        (1, "video abc429: private video", "rate_limited"),
        (1, "Private video", "unavailable"),
        (1, "HTTP Error 403", "unavailable"),
        (1, "something else", "unavailable"),
        (1, "", "unavailable"),
        (1, None, "unavailable"),
    ],
)
def test_failures(spark, code, stderr, want):
    expression = O.classify_failure(F.col("c"), F.col("e"))
    assert one(spark, "c int, e string", (code, stderr), expression) == want


@pytest.mark.parametrize(
    ("caption", "code", "want"), [(True, 1, "ok"), (False, 0, "no_subtitles"), (False, 1, "rate_limited")]
)
def test_outcome(spark, caption, code, want):
    expression = O.resolve_outcome(F.col("has"), F.col("c"), F.lit("429"))
    assert one(spark, "has boolean, c int", (caption, code), expression) == want


def by_strptime(text):
    try:
        return datetime.strptime(text, "%Y%m%d").date()
    except (TypeError, ValueError):
        return None


def test_dates(spark):
    texts = ["20200406", None, "", "bad", "20200230", "2020406", "202046", "20201301", "00000101"]
    texts += ["2020-04-06", "20200406x", " 20200406", "202004 6", "20200100", "20240229", "20230229"]
    texts += [f"2023{i}" for i in range(0, 1400, 7)] + ["20200406\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = rows.select("id", O.compact_date(F.col("t")).alias("d")).orderBy("id").collect()
    assert [r.d for r in got] == [by_strptime(t) for t in texts]
    assert got[0].d == date(2020, 4, 6)


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://x.test/playlist?list=PLxxx&si=abc123", "PLxxx"),
        ("https://x.test/watch?v=1&list=PL1", "PL1"),
        ("list=a list=b", "a "),
        ("PLxxx123", "PLxxx123"),
    ],
)
def test_playlist_id(spark, url, want):
    assert one(spark, "u string", (url,), O.playlist_id(F.col("u"))) == want


def test_error_detail(spark):
    text = "\t " + "x" * 130 + " \n"
    assert one(spark, "e string", (text,), O.error_detail(F.col("e"))) == "x" * 120


@pytest.mark.parametrize(
    ("number", "want"), [("213", 213), ("213.5", 214), ("212.5", 212), (None, None), ("n/a", None)]
)
def test_whole_number(spark, number, want):
    assert one(spark, "n string", (number,), O.whole_number(F.col("n"), "int")) == want


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("abc.en.vtt", ("abc", "en")),
        ("abc.en-US.vtt", ("abc", "en-US")),
        ("abc.vtt", ("abc", "en")),
        ("abc..vtt", ("abc", "en")),
    ],
)
def test_caption_name(spark, name, want):
    assert tuple(one(spark, "n string", (name,), landing.caption_name(F.col("n")))) == want


def test_snapshot_lines(spark):
    lines = ['{"id": "a"}', "", "  ", "junk", '{"id": "b"', '{"id": "c"} x', '{"id": "d"}{"id": "e"}']
    lines += ['{"id": null}', '{"id": ""}', '{"x": 1}', ' {"id": "a"} ', '{"n": {"id": "z"}, "id": "f"}']
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.video_id for r in landing.snapshot_ids(rows).collect()) == ["a", "a", "f"]


def test_metadata_text(spark):
    texts = [
        ("full", '{"title": "T", "channel": "", "uploader": "U", "uploader_id": "UI", "duration": 61.5, '
                 '"view_count": 9007199254740993, "upload_date": "20200406", "formats": [{"a": 1}]}'),
        ("sparse", '{"title": "T"}'),
        ("other", '{"formats": []}'),
        ("empty", "{}"),
    ]
    rows = landing.parse_infos(spark.createDataFrame(texts, "video_id string, value string"))
    got = {r[0]: tuple(r)[1:] for r in rows.collect()}
    assert got["full"] == (True, "T", "U", "UI", date(2020, 4, 6), 62, 9007199254740993)
    assert got["sparse"] == (True, "T", None, None, None, None, None)
    assert got["other"] == (True, *[None] * 6)
    assert got["empty"] == (False, *[None] * 6)


def test_caption_files(spark, tmp_path):
    (tmp_path / "a.en.vtt").write_bytes(b"WEBVTT\r\n\rx")
    (tmp_path / "a.de.vtt").write_text("de")
    (tmp_path / "b.vtt").write_text("")
    (tmp_path / "c.info.json").write_text("{}")
    got = sorted(tuple(r) for r in landing.read_captions(spark, str(tmp_path)).collect())
    # File sources skip zero-byte files: b counts as having no caption.
    assert got == [("a", "de", "de"), ("a", "en", "WEBVTT\n\nx")]
    assert [r.video_id for r in landing.read_infos(spark, str(tmp_path)).collect()] == ["c"]
