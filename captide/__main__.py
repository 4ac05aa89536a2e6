"""Command line for the jobs, for use with spark-submit or ``python -m captide``.

    python -m captide ingest    --store DIR --landing DIR --playlist URL
    python -m captide refresh   --store DIR --landing DIR --playlist URL
                                [--refresh-metadata] [--force-tombstone]
    python -m captide transform --store DIR [--force]
    python -m captide validate  --store DIR
    python -m captide create    --store DIR
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from captide.plans.ingest import read_landing, run_ingest
from captide.plans.refresh import TooManyRemovals, run_refresh
from captide.plans.transform import run_transform
from captide.plans.validate import run_validate
from captide.session import build_session
from captide.sources.landing import IncompleteSnapshot
from captide.sources.store import Store


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="captide", description="Caption transcript jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("create", "ingest", "refresh", "transform", "validate"):
        job = jobs.add_parser(name)
        job.add_argument("--store", required=True, help="root folder of the tables")
        job.add_argument("--buckets", type=int, help="buckets of the id tables")
        job.add_argument("--text-buckets", type=int, help="buckets of the transcript tables")
        job.add_argument("--run-ts", help="timestamp recorded by this run (default: now, UTC)")
        if name in ("ingest", "refresh"):
            job.add_argument("--landing", required=True, help="folder filled by the fetcher")
            job.add_argument("--playlist", required=True, help="playlist URL or id")
        if name == "refresh":
            job.add_argument("--refresh-metadata", action="store_true")
            job.add_argument("--force-tombstone", action="store_true")
        if name == "transform":
            job.add_argument("--force", action="store_true", help="reprocess every row")
    return parser.parse_args(argv)


def _run(args: argparse.Namespace) -> dict:
    spark = build_session(f"captide-{args.job}")
    store = Store(spark, args.store, args.buckets, args.text_buckets)
    now = args.run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    if args.job == "create":
        store.create()
        return {"status": "ok", "tables": store.created()}
    if args.job == "transform":
        return run_transform(store, now, force=args.force)
    if args.job == "validate":
        return run_validate(store, now)
    landed = read_landing(spark, args.landing)
    if args.job == "ingest":
        return run_ingest(store, args.playlist, landed, now)
    return run_refresh(
        store, args.playlist, landed, now, args.refresh_metadata, args.force_tombstone
    )


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    try:
        result = _run(args)
    except (IncompleteSnapshot, TooManyRemovals, FileNotFoundError) as e:
        print(json.dumps({"action": args.job, "error": str(e)}), file=sys.stderr)
        return 1
    print(json.dumps({"action": args.job, "result": result}))
    return 1 if result.get("status") == "failed" else 0


if __name__ == "__main__":
    sys.exit(main())
