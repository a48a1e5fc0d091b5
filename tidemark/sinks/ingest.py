"""One ingestion run: extract what changed per entity, land it, and move the checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks import control, landing

SYSTEMS = {"customers": "rds", "products": "rds", "orders": "rds", "payments": "api", "shipments": "api"}


def ingest_entity(spark: SparkSession, entity: str, read: Callable[[datetime], DataFrame], bronze_root: str,
                  checkpoints: str, started: datetime, load_type: str) -> int:
    """Lands the rows ``read(last_sync)`` returns. The checkpoint becomes the start of the run, so rows that
    change meanwhile are read again next time and deduplicated later."""
    full = load_type == "full"
    since = datetime(1970, 1, 1) if full else control.get_last_sync(spark, checkpoints, entity)
    rows = landing.write_to_bronze(bronze_root, entity, read(since), started, load_type, SYSTEMS.get(entity, "rds"))
    control.update_sync(spark, checkpoints, entity, started, rows, started)
    return rows


def ingest(spark: SparkSession, readers: dict[str, Callable[[datetime], DataFrame]], bronze_root: str, checkpoints: str,
           started: datetime, requested: str = "incremental", run_log: str | None = None) -> dict[str, dict]:
    """Every entity in turn; a failed one is reported and the others go on. The first run is a full one.

    With ``run_log`` the run is written there, as failed if any entity failed, so that the next load window starts again.
    """
    load_type = control.load_type(spark, checkpoints, requested)
    report = {}
    for entity, read in readers.items():
        try:
            rows = ingest_entity(spark, entity, read, bronze_root, checkpoints, started, load_type)
            report[entity] = {"status": "success", "load_type": load_type, "records": rows}
        except Exception as e:  # one entity must not stop the others
            report[entity] = {"status": "failed", "load_type": load_type, "records": 0, "error": str(e)}
    if run_log:
        errors = "; ".join(f"{e}: {r['error']}" for e, r in report.items() if "error" in r)
        done = (started - timedelta(days=1)).date()
        control.write_run_log(spark, run_log, done, "failed" if errors else "success", {e: r["records"] for e, r in report.items()}, errors or None, started)
    return report
