"""Data-quality rules: one pass flags every row, batch rules run beside it, severities route."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeloom.config import Rule, Severity

# What counts as an e-mail address or a phone number.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?\d{1,2}[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"

#: Offending rows that a result shows.
SAMPLES = 5
SKIPPED, PASSED, FAILED = "SKIPPED", "PASSED", "FAILED"


def row_predicate(rule: Rule) -> Column:
    """TRUE where a row passes; never NULL: a missing value passes all rules but not_null."""
    columns = [F.col(c) for c in rule.columns]

    def all_of(test: Callable[[Column], Column]) -> Column:
        out = F.lit(True)
        for c in columns:
            out = out & F.coalesce(test(c), F.lit(True))
        return out

    if rule.type == "not_null":
        out = F.lit(True)
        for c in columns:
            out = out & c.isNotNull()
        return out
    if rule.type == "range":

        def inside(c: Column) -> Column:
            value = c.try_cast("double")
            ok = F.lit(True)
            if rule.min is not None:
                ok = ok & (value >= rule.min)
            if rule.max is not None:
                ok = ok & (value <= rule.max)
            return ok

        return all_of(inside)
    if rule.type == "domain":
        return all_of(lambda c: c.isin(*rule.allowed))
    if rule.type == "regex":
        return all_of(lambda c: c.rlike(rule.pattern))
    if rule.type == "pii_scan":
        return all_of(lambda c: ~(c.cast("string").rlike(EMAIL) | c.cast("string").rlike(PHONE)))
    if rule.type == "expression":
        return F.coalesce(F.expr(rule.expression), F.lit(True))
    raise ValueError(f"{rule.type} isn't a row rule")


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key has no parent; NULL keys have none to miss."""
    keys = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def age_hours(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """One row: hours from the latest value to as_of; NULL for an empty table."""
    latest = F.max(F.col(column).try_cast("timestamp"))
    return df.agg(((F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(latest)) / 3600.0).alias("age_hours"))


def volume_ok(rows: int, trailing_mean: float | None, tolerance: float) -> bool:
    """Whether a batch is within tolerance of the mean; without history all is."""
    return not trailing_mean or abs(rows - trailing_mean) <= tolerance * trailing_mean


@dataclass
class RuleResult:
    rule: str
    type: str
    severity: str
    status: str
    violations: int
    detail: str = ""


@dataclass
class QualityOutcome:
    valid: DataFrame
    quarantined: DataFrame
    results: list[RuleResult] = field(default_factory=list)
    rows_in: int = 0
    rows_quarantined: int = 0

    @property
    def rows_valid(self) -> int:
        return self.rows_in - self.rows_quarantined

    @property
    def pass_rate(self) -> float:
        return self.rows_valid / self.rows_in if self.rows_in else 1.0


class FatalQualityError(Exception):
    """A fatal rule failed, or too few rows passed; carries the outcome, so it can still be recorded."""

    def __init__(self, message: str, outcome: QualityOutcome):
        super().__init__(message)
        self.outcome = outcome


def flag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds _dq_failed_rules and _dq_warnings (arrays of rule names, in rule order)."""

    def failed(severities: tuple[Severity, ...]) -> Column:
        tests = [F.when(~row_predicate(r), F.lit(r.name)) for r in rules if not r.is_batch and r.severity in severities]
        return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")

    return df.withColumns({"_dq_failed_rules": failed((Severity.ERROR, Severity.FATAL)), "_dq_warnings": failed((Severity.WARN,))})


def route(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without failed rules (their warnings stay on them), and the others."""
    return flagged.where(F.size("_dq_failed_rules") == 0).drop("_dq_failed_rules"), flagged.where(F.size("_dq_failed_rules") > 0)


def counted(bad: DataFrame, samples: int = SAMPLES) -> tuple[int, list]:
    """How many rows, and a few of them, in one job: no task sends more than `samples`."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the task
    some = bad.select(F.when(place < samples, F.struct(*bad.columns)).alias("x"))
    row = some.agg(F.count(F.lit(1)).alias("n"), F.slice(F.collect_list("x"), 1, samples).alias("some")).first()
    return row["n"], row["some"]


def bindable(rule: Rule, columns: list[str], df: DataFrame) -> bool:
    if not set(rule.columns) <= set(columns):
        return False
    if rule.type == "expression":
        try:
            df.select(F.expr(rule.expression)).schema
        except Exception:
            return False
    return True


def evaluate(
    df: DataFrame,
    rules: list[Rule],
    fail_threshold: float = 0.8,
    reference: Callable[[str], DataFrame | None] = lambda name: None,
    trailing_mean: float | None = None,
    as_of: dt.datetime | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> QualityOutcome:
    """Flags and counts in one pass; a rule whose columns or reference are missing is SKIPPED.

    stage writes the flagged rows down and returns what it wrote: then the counts come from that write, and
    valid rows, quarantine and batch rules read what is written.
    """
    known = [r for r in rules if bindable(r, df.columns, df)]
    row_rules = [r for r in known if not r.is_batch]
    flagged = flag(df, row_rules)
    counts = [F.count_if(F.array_contains(F.concat("_dq_failed_rules", "_dq_warnings"), r.name)).alias(r.name) for r in row_rules]
    counts += [F.count(F.lit(1)).alias("_rows"), F.count_if(F.size("_dq_failed_rules") > 0).alias("_bad")]
    if stage is None:
        totals = flagged.agg(*counts).first().asDict()
    else:
        seen = Observation()
        flagged = stage(flagged.observe(seen, *counts))
        totals, df = seen.get, flagged.drop("_dq_failed_rules", "_dq_warnings")
    valid, bad = route(flagged)
    outcome = QualityOutcome(valid, bad, rows_in=totals["_rows"], rows_quarantined=totals["_bad"])
    for r in rules:
        if r not in known:
            result = (SKIPPED, 0, "a column is missing")
        elif not r.is_batch:
            result = (FAILED if totals[r.name] else PASSED, totals[r.name], "")
        else:
            result = _batch_rule(r, df, totals["_rows"], reference, trailing_mean, as_of)
        outcome.results.append(RuleResult(r.name, r.type, r.severity.value, *result))
    fatal = [r.rule for r in outcome.results if r.status == FAILED and r.severity == Severity.FATAL.value]
    if fatal:
        raise FatalQualityError(f"fatal rules failed: {', '.join(fatal)}", outcome)
    if outcome.pass_rate < fail_threshold:
        raise FatalQualityError(f"only {outcome.pass_rate:.1%} of rows passed", outcome)
    return outcome


def _batch_rule(rule: Rule, df: DataFrame, rows: int, reference, trailing_mean, as_of) -> tuple[str, int, str]:
    if rule.type == "unique":
        n, some = counted(unique_violations(df, list(rule.columns)))
        return (FAILED if n else PASSED), n, str([r.asDict() for r in some]) if n else ""
    if rule.type == "referential":
        table, column = rule.reference.split(".")
        parent = reference(table)
        if parent is None:
            return SKIPPED, 0, f"no table {table}"
        n, some = counted(orphans(df, rule.columns[0], parent, column).select(rule.columns[0]))
        return (FAILED if n else PASSED), n, str([r[0] for r in some]) if n else ""
    if rule.type == "freshness":
        now = F.lit(as_of) if as_of else F.current_timestamp()
        age = age_hours(df, rule.columns[0], now).first()[0]
        late = age is None or age > rule.max_age_hours
        return (FAILED if late else PASSED), int(late), f"age {age} hours"
    ok = volume_ok(rows, trailing_mean, rule.tolerance)
    return (PASSED if ok else FAILED), int(not ok), f"{rows} rows, mean {trailing_mean}"
