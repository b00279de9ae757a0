"""Run records, quality and reconciliation results, and structured logging."""

from __future__ import annotations

import contextvars
import json
import logging
import sys
import time
import uuid
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import SparkSession

from lakeloom.config import Environment
from lakeloom.operators.quality import FatalQualityError, QualityOutcome
from lakeloom.plans.reconcile import SIDES
from lakeloom.sources.session import rows_to_frame
from lakeloom.sources.tablestore import Table

RUNS = "run_id string, batch_id string, stage string, entity string, status string, started_at timestamp, ended_at timestamp, duration_s double, rows_in long, rows_out long, rows_quarantined long, error string"
QUALITY = "run_id string, batch_id string, entity string, layer string, rule string, type string, severity string, status string, violations long, rows_in long, pass_rate double, detail string, checked_at timestamp"
RECONCILIATION = "run_id string, check_name string, entity string, source_layer string, target_layer string, tolerance decimal(18,2), source_value decimal(18,2), target_value decimal(18,2), difference decimal(18,2), status string, checked_at timestamp"

_run_id: contextvars.ContextVar[str] = contextvars.ContextVar("run_id", default="")
_context: contextvars.ContextVar[dict] = contextvars.ContextVar("context", default={})


def run_id() -> str:
    if not _run_id.get():
        _run_id.set(uuid.uuid4().hex)
    return _run_id.get()


def set_run_id(value: str) -> None:
    _run_id.set(value)


@contextmanager
def log_context(**values):
    """Fields for every log line of this thread's work; other threads keep theirs."""
    token = _context.set(_context.get() | values)
    try:
        yield
    finally:
        _context.reset(token)


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line = {"ts": datetime.now(timezone.utc).isoformat(), "level": record.levelname, "run_id": run_id(), "message": record.getMessage()}
        line |= _context.get() | getattr(record, "fields", {})
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str)


def get_logger(name: str) -> logging.Logger:
    logger = logging.getLogger(name)
    if not logger.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(JsonFormatter())
        logger.addHandler(handler)
        logger.setLevel(logging.INFO)
        logger.propagate = False
    return logger


def log_event(logger: logging.Logger, event: str, **fields) -> None:
    logger.info(event, extra={"fields": fields})


@dataclass
class RunRecord:
    stage: str
    entity: str
    batch_id: str = ""
    run_id: str = field(default_factory=run_id)
    status: str = "RUNNING"
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    ended_at: datetime | None = None
    duration_s: float = 0.0
    rows_in: int = 0
    rows_out: int = 0
    rows_quarantined: int = 0
    error: str | None = None


class Audit:
    """The three audit tables of an environment."""

    def __init__(self, spark: SparkSession, env: Environment):
        self.spark = spark
        self.tables = {n: Table(spark, env.table_path("audit", n)) for n in ("runs", "quality", "reconciliation")}

    def write(self, table: str, rows: list[dict], schema: str) -> None:
        if rows:
            self.tables[table].append(rows_to_frame(self.spark, rows, schema))

    @contextmanager
    def task(self, stage: str, entity: str, batch_id: str = ""):
        """A run record for the work inside, written when it succeeds and when it fails; errors go on."""
        record, began = RunRecord(stage, entity, batch_id), time.monotonic()
        try:
            with log_context(stage=stage, entity=entity):
                yield record
            record.status = "SUCCESS"
        except FatalQualityError as e:
            record.status, record.error = "FATAL_DQ", str(e)
            raise
        except BaseException as e:
            record.status, record.error = "FAILED", f"{type(e).__name__}: {e}"[:2000]
            raise
        finally:
            record.ended_at, record.duration_s = datetime.now(timezone.utc), time.monotonic() - began
            self.write("runs", [asdict(record)], RUNS)

    def quality(self, entity: str, layer: str, batch_id: str, outcome: QualityOutcome) -> None:
        now = datetime.now(timezone.utc)
        base = {"run_id": run_id(), "batch_id": batch_id, "entity": entity, "layer": layer, "rows_in": outcome.rows_in, "pass_rate": outcome.pass_rate, "checked_at": now}
        self.write("quality", [base | asdict(r) for r in outcome.results], QUALITY)

    def reconciliation(self, results: list[dict]) -> None:
        now = datetime.now(timezone.utc)
        sides = {r["check_name"]: dict(zip(("source_layer", "target_layer", "tolerance"), SIDES[r["check_name"]])) for r in results}
        self.write("reconciliation", [{"run_id": run_id(), "checked_at": now} | sides[r["check_name"]] | r | {"tolerance": Decimal(sides[r["check_name"]]["tolerance"])} for r in results], RECONCILIATION)

    def trailing_mean_rows(self, entity: str, stage: str, days: int = 7) -> float | None:
        """Mean rows out of the entity's successful runs of one stage in the last days."""
        if not self.tables["runs"].exists():
            return None
        rows = self.tables["runs"].read().where(f"entity = '{entity}' and stage = '{stage}' and status = 'SUCCESS' and started_at >= current_timestamp() - interval {days} days")
        return rows.selectExpr("avg(rows_out)").first()[0]
