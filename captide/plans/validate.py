"""Quality report over the current tables."""

from __future__ import annotations

from datetime import datetime

from captide.operators.quality import ARTIFACT_PATTERNS, missing_tables, validation_report
from captide.schema import BRONZE, SILVER, VIDEOS
from captide.sources.store import Store


def run_validate(store: Store, run_ts: datetime | str) -> dict:
    missing = missing_tables(store.created())
    if missing:
        raise FileNotFoundError(f"missing tables: {missing}")
    tables = store.tables()
    row = validation_report(tables[VIDEOS], tables[BRONZE], tables[SILVER]).first().asDict()
    hits = {name: row.pop(name) for name in ARTIFACT_PATTERNS}
    result = {**row, "artifact_hits": hits}
    store.log_run("validate_transform", result, run_ts)
    return result
