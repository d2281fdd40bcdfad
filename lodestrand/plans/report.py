"""Run reports: counters gathered while a table is written, kept as JSON."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, reason: str) -> tuple[DataFrame, Observation]:
    """``df`` with counters of all rows and of those with a drop ``reason``, filled by the next action on it."""
    o = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(o, F.count(F.lit(1)).alias("attempted"), F.count(reason).alias("dropped")), o


def rates(attempted: int, dropped: int) -> dict:
    """Counters with the share that succeeded; 1.0 when nothing was tried."""
    done = attempted - dropped
    return {"attempted": attempted, "dropped": dropped, "uploaded": done, "success_rate": round(done / attempted, 6) if attempted else 1.0}


def status(failed: int, succeeded: int) -> str:
    return "success" if not failed else "partial_success" if succeeded else "failed"


def write_report(path: str, body: dict, run_id: str | None = None) -> dict:
    """The report as written: keys sorted, with a run id and the time in UTC."""
    out = {"run_id": run_id or uuid.uuid4().hex, "created_at": datetime.now(timezone.utc).isoformat(), **body}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, sort_keys=True, ensure_ascii=False, indent=2)
    return out
