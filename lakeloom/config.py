"""Declared entities, rules and environments, and the checks that keep them consistent."""

from __future__ import annotations

import os
import re
from enum import Enum
from functools import lru_cache
from pathlib import Path
from typing import Any

import yaml
from pydantic import BaseModel, ConfigDict, Field, model_validator

#: Columns that ingestion or unwrapping adds; rules and orderings may name them.
SYSTEM_COLUMNS = frozenset(
    "_ingest_ts _ingest_date _source_system _batch_id _run_id _file_name _record_hash _op _source_lsn _source_ts_ms _is_delete _is_snapshot".split()
)
#: Names that an ordering may use for a system column.
ALIASES = {"source_lsn": "_source_lsn", "source_ts_ms": "_source_ts_ms"}


class LoadType(str, Enum):
    FULL = "full"
    INCREMENTAL = "incremental"
    CDC = "cdc"


class SCDType(str, Enum):
    NONE = "none"
    SCD1 = "scd1"
    SCD2 = "scd2"


class Severity(str, Enum):
    WARN = "warn"
    ERROR = "error"
    FATAL = "fatal"


class Strict(BaseModel):
    model_config = ConfigDict(extra="forbid", frozen=True)


class Environment(Strict):
    name: str
    warehouse: str
    landing_root: str
    checkpoint_root: str
    schema_root: str
    catalog: str | None = None
    fail_threshold: float = Field(0.80, ge=0, le=1)
    warn_threshold: float = Field(0.95, ge=0, le=1)
    max_parallel: int = Field(2, ge=1, le=4)
    #: Buckets of silver tables and dimensions, for their first version; a few hundred MB each is right.
    buckets: int = Field(64, ge=1)

    @model_validator(mode="after")
    def _thresholds(self):
        if self.fail_threshold >= self.warn_threshold:
            raise ValueError("fail_threshold must be below warn_threshold")
        return self

    def table(self, layer: str, name: str) -> str:
        """catalog.layer.name, or layer.name where there is no catalog."""
        return ".".join(x for x in (self.catalog, layer, name) if x)

    def table_path(self, layer: str, name: str) -> str:
        return f"{self.warehouse}/{layer}/{name}"

    def checkpoint_path(self, entity: str) -> str:
        return f"{self.checkpoint_root}/{entity}"

    def schema_path(self, entity: str) -> str:
        return f"{self.schema_root}/{entity}.json"

    def landing_path(self, glob: str) -> str:
        return f"{self.landing_root}/{glob}"


class Source(Strict):
    system: str
    format: str
    path_glob: str
    options: dict[str, str] = {}
    envelope: bool = False

    @model_validator(mode="after")
    def _format(self):
        if self.format not in ("json", "csv", "parquet", "avro"):
            raise ValueError(f"unknown format {self.format}")
        return self


class Entity(Strict):
    name: str
    source: Source
    load_type: LoadType
    primary_key: tuple[str, ...]
    watermark: str | None = None
    order_by: tuple[str, ...] = ()
    scd_type: SCDType = SCDType.NONE
    tracked: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    schema_hints: str | None = None
    active: bool = True

    @model_validator(mode="after")
    def _consistent(self):
        if not self.primary_key:
            raise ValueError("primary_key must not be empty")
        if self.load_type is LoadType.INCREMENTAL and not self.watermark:
            raise ValueError("an incremental entity needs a watermark")
        if self.load_type is LoadType.CDC and not self.order_by:
            raise ValueError("a cdc entity needs order_by")
        if self.scd_type is SCDType.SCD2 and not self.tracked:
            raise ValueError("an scd2 entity needs tracked columns")
        if any(c.startswith("_") for c in self.tracked):
            raise ValueError("system columns can't be tracked")
        if self.partition_by and self.cluster_by:
            raise ValueError("partition_by and cluster_by exclude each other")
        if set(self.exclude) & set(self.primary_key):
            raise ValueError("a key column can't be excluded")
        return self


#: What each rule type must be given.
RULE_NEEDS = {
    "not_null": ("columns",),
    "unique": ("columns",),
    "range": ("columns",),
    "domain": ("columns", "allowed"),
    "regex": ("columns", "pattern"),
    "expression": ("expression",),
    "referential": ("columns", "reference"),
    "freshness": ("columns", "max_age_hours"),
    "volume": (),
    "pii_scan": ("columns",),
}
BATCH_RULES = ("unique", "referential", "freshness", "volume")


class Rule(Strict):
    name: str
    type: str
    severity: Severity
    columns: tuple[str, ...] = ()
    min: float | None = None
    max: float | None = None
    allowed: tuple[str, ...] = ()
    pattern: str | None = None
    expression: str | None = None
    reference: str | None = None  # table.column
    max_age_hours: float | None = None
    tolerance: float = 0.5

    @model_validator(mode="after")
    def _needs(self):
        if self.type not in RULE_NEEDS:
            raise ValueError(f"unknown rule type {self.type}")
        for need in RULE_NEEDS[self.type]:
            if not getattr(self, need):
                raise ValueError(f"{self.type} needs {need}")
        if self.type == "range" and self.min is None and self.max is None:
            raise ValueError("range needs min or max")
        if self.type == "range" and self.min is not None and self.max is not None and self.min > self.max:
            raise ValueError("range needs min <= max")
        if self.pattern is not None:
            try:
                re.compile(self.pattern)
            except re.error as e:
                raise ValueError(f"bad pattern: {e}") from e
        if not re.fullmatch(r"\w+", self.name):
            raise ValueError("a rule's name becomes a column: letters, digits and _ only")
        return self

    @property
    def is_batch(self) -> bool:
        return self.type in BATCH_RULES


class UnsetVariable(KeyError):
    """A declaration names a variable that has no value and no default."""


_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def expand(value: Any) -> Any:
    """${NAME} and ${NAME:-default} in strings, from the process environment."""
    if isinstance(value, str):

        def one(m: re.Match) -> str:
            got = os.environ.get(m[1], m[2])
            if got is None:
                raise UnsetVariable(f"{m[1]} is not set")
            return got

        return _VARIABLE.sub(one, value)
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    return [expand(v) for v in value] if isinstance(value, list) else value


HOME = Path(__file__).parent / "conf"


@lru_cache(maxsize=64)
def _yaml(path: str) -> Any:
    return yaml.safe_load(Path(path).read_text())


def load_environment(name: str, home: Path = HOME) -> Environment:
    found = _yaml(str(home / "environments.yaml"))
    if name not in found:
        raise KeyError(f"no environment {name}; there are {', '.join(sorted(found))}")
    return Environment(name=name, **expand(found[name]))


def load_entities(home: Path = HOME, active_only: bool = True) -> dict[str, Entity]:
    found = {k: Entity(name=k, **v) for k, v in _yaml(str(home / "entities.yaml")).items()}
    return {k: e for k, e in found.items() if e.active or not active_only}


def load_rules(home: Path = HOME) -> dict[str, list[Rule]]:
    return {k: [Rule(**r) for r in rules] for k, rules in _yaml(str(home / "rules.yaml")).items()}


def problems(home: Path = HOME) -> list[str]:
    """All that is wrong with the declarations of a folder; empty if they are consistent."""
    out: list[str] = []
    for name in _yaml(str(home / "environments.yaml")):
        try:
            load_environment(name, home)
        except UnsetVariable:
            pass  # of another machine's environment
        except ValueError as e:
            out.append(f"environment {name}: {e}")
    entities, rules = {}, {}
    for name, body in _yaml(str(home / "entities.yaml")).items():
        try:
            entities[name] = Entity(name=name, **body)
        except ValueError as e:
            out.append(f"entity {name}: {e}")
    for name, bodies in _yaml(str(home / "rules.yaml")).items():
        for body in bodies:
            try:
                rules.setdefault(name, []).append(Rule(**body))
            except ValueError as e:
                out.append(f"rule {name}.{body.get('name')}: {e}")
    for name, own in rules.items():
        if name not in entities:
            out.append(f"rules for unknown entity {name}")
            continue
        if len({r.name for r in own}) < len(own):
            out.append(f"{name}: two rules have one name")
        for r in own:
            for c in set(r.columns) & set(entities[name].exclude):
                out.append(f"{name}.{r.name}: column {c} is excluded before rules run")
            if r.reference and r.reference.split(".")[0] not in entities:
                out.append(f"{name}.{r.name}: unknown reference {r.reference}")
        keyed = [r for r in own if r.type in ("not_null", "unique") and set(r.columns) == set(entities[name].primary_key)]
        if any(r.severity is not Severity.FATAL for r in keyed) or {r.type for r in keyed} != {"not_null", "unique"}:
            out.append(f"{name}: its key must be not null and unique, both fatal")
    out += [f"{name}: no rules" for name in entities if name not in rules]
    for name, e in entities.items():
        if e.source.envelope and e.order_by[:1] != ("source_lsn",):
            out.append(f"{name}: change events are ordered by source_lsn first")
    return out
