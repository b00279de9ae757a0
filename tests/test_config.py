import pytest
from pydantic import ValidationError

from lakeloom import config as C

SOURCE = {"system": "s", "format": "json", "path_glob": "a/dt=*/*.json"}


def entity(**kw):
    return C.Entity(**({"name": "a", "source": SOURCE, "load_type": "full", "primary_key": ["id"]} | kw))


def test_declarations_are_consistent():
    assert C.problems() == []
    assert len(C.load_entities()) == 12
    rules = [r for own in C.load_rules().values() for r in own]
    assert len(rules) == 68
    assert sum(r.severity is C.Severity.FATAL for r in rules) == 28


@pytest.mark.parametrize("name", ["local", "dev", "test", "prod"])
def test_environments(name, monkeypatch):
    monkeypatch.delenv("LAKE_ROOT", raising=False)
    if name != "local":  # no tables in a machine's own folder by default
        with pytest.raises(C.UnsetVariable):
            C.load_environment(name)
    monkeypatch.setenv("LAKE_ROOT", "s3a://lake")
    env = C.load_environment(name)
    assert env.warehouse == "s3a://lake/warehouse"
    assert env.fail_threshold < env.warn_threshold
    assert env.table("gold", "t") == ("gold.t" if name == "local" else f"{name}.gold.t")


@pytest.mark.parametrize(
    "kw",
    [
        {"primary_key": []},
        {"load_type": "incremental"},
        {"load_type": "cdc"},
        {"scd_type": "scd2"},
        {"scd_type": "scd2", "tracked": ["_ingest_ts"]},
        {"partition_by": ["a"], "cluster_by": ["b"]},
        {"exclude": ["id"]},
        {"source": SOURCE | {"format": "xml"}},
        {"surprise": 1},
    ],
)
def test_bad_entities(kw):
    with pytest.raises(ValidationError):
        entity(**kw)


@pytest.mark.parametrize(
    "kw",
    [
        {"type": "not_null"},
        {"type": "domain", "columns": ["a"]},
        {"type": "range", "columns": ["a"]},
        {"type": "range", "columns": ["a"], "min": 2, "max": 1},
        {"type": "regex", "columns": ["a"], "pattern": "("},
        {"type": "expression"},
        {"type": "referential", "columns": ["a"]},
        {"type": "freshness", "columns": ["a"]},
        {"type": "other"},
    ],
)
def test_bad_rules(kw):
    with pytest.raises(ValidationError):
        C.Rule(name="r", severity="warn", **kw)


def test_variables(monkeypatch):
    monkeypatch.setenv("X", "1")
    monkeypatch.delenv("Y", raising=False)
    assert C.expand({"a": "${X}/${Y:-2}"}) == {"a": "1/2"}
    with pytest.raises(KeyError):
        C.expand("${Y}")


def test_problems_are_found(tmp_path):
    (tmp_path / "environments.yaml").write_text("bad: {warehouse: w, landing_root: l, checkpoint_root: c, schema_root: s, fail_threshold: 0.9, warn_threshold: 0.8}")
    (tmp_path / "entities.yaml").write_text('a: {source: {system: s, format: json, path_glob: "a/*.json"}, load_type: full, primary_key: [id], exclude: [x]}')
    (tmp_path / "rules.yaml").write_text("a:\n- {name: r, type: not_null, severity: error, columns: [x]}\nb:\n- {name: r, type: unique, severity: fatal, columns: [id]}")
    found = "\n".join(C.problems(tmp_path))
    for part in ("environment bad", "excluded", "unknown entity b", "fatal"):
        assert part in found
