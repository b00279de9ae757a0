import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.config import Rule
from lakeloom.functions import keys, masks
from lakeloom.operators import dedup, envelope, merge, quality, scd
from lakeloom.operators.standardise import standardise
from lakeloom.plans import governance

T = dt.datetime


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_keys_tell_nulls_and_parts_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", None), (None, "ab"), ("", "ab"), ("a ", "b")], "x string, y string")
    found = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert len(set(found)) == 4 and found[0] == found[4]
    assert df.select(keys.record_hash(["x", "y"])).distinct().count() == 4


def test_masks(spark):
    df = spark.createDataFrame([("Ann Lee", "a@b.c", "12345"), (None, None, None), ("X", "none", "1")], "n string, e string, p string")
    got = rows(df, masks.mask_name(F.col("n")), masks.mask_postal(F.col("p")), masks.mask_email(F.col("e")))
    assert ("A. L.", "123**") in [g[:2] for g in got] and (None, None, None) in got and ("X.", "1**", "***") in got
    assert df.select(masks.mask_email(F.col("e"), clear=True).alias("e")).first().e == "a@b.c"


def test_dedup_does_not_depend_on_order(spark):
    data = [(1, 5, "a"), (1, 5, "b"), (1, None, "c"), (2, None, None), (2, None, "x"), (None, 1, "n")]
    seen = set()
    for p in itertools.islice(itertools.permutations(data), 0, 720, 240):
        df = spark.createDataFrame(list(p), "id int, v int, w string")
        seen.add(tuple(rows(dedup.deduplicate(df, ["id"], ["v"]), "id", "v", "w")))
    assert len(seen) == 1 and len(next(iter(seen))) == 3
    with pytest.raises(ValueError):
        dedup.total_order(df, ["absent"])


def test_standardise(spark):
    df = spark.createDataFrame([(" a ", " x ", "", "p", " keep ")], "name string, order_status string, state string, phone string, _sys string")
    assert rows(standardise(df, ("phone",)), "*") == [("a", "X", None, " keep ")]


EVENT = "op string, ts_ms long, before struct<id:int,v:string>, after struct<id:int,v:string>, source struct<lsn:long,snapshot:string>"


def test_envelope(spark):
    df = spark.createDataFrame([("c", 1, None, (1, "a"), (5, "false")), ("d", 2, (1, "a"), None, (6, None)), ("d", 2, None, None, (6, None)), ("r", 1, None, (2, "z"), (1, "true"))], EVENT)
    assert envelope.is_envelope(df) and not envelope.is_envelope(df.select("op"))
    flat = envelope.unwrap(df, ["id"])
    assert rows(flat, "id", "v", "_op", "_source_lsn", "_is_delete", "_is_snapshot") == [(1, "a", "c", 5, False, False), (1, "a", "d", 6, True, False), (2, "z", "r", 1, False, True)]
    assert [x.count() for x in envelope.split_deletes(flat)] == [2, 1]
    with pytest.raises(ValueError):
        envelope.unwrap(df, ["nope"])


def rule(**kw):
    return Rule(**({"name": "r", "severity": "error"} | kw))


@pytest.mark.parametrize(
    "kw, good, bad",
    [
        ({"type": "not_null"}, ["a"], [None]),
        ({"type": "range", "min": 1, "max": 2}, ["1", "2", None, "x"], ["0", "2.5"]),
        ({"type": "domain", "allowed": ["a"]}, ["a", None], ["b"]),
        ({"type": "regex", "pattern": "^a"}, ["ab", None], ["ba"]),
        ({"type": "pii_scan"}, ["hello 12", None], ["x a@b.com", "call 555-123-4567"]),
        ({"type": "expression", "expression": "c > 'b'"}, ["c", None], ["a"]),
    ],
)
def test_row_rules(spark, kw, good, bad):
    own = rule(**(kw if kw["type"] == "expression" else kw | {"columns": ["c"]}))
    df = spark.createDataFrame([(v, v in good) for v in good + bad], "c string, ok boolean")
    assert all(r.ok == r.got for r in df.select("ok", quality.row_predicate(own).alias("got")).collect())


def test_routing_keeps_every_row_once(spark):
    rules = [rule(name="a", type="range", columns=["v"], min=0), rule(name="b", type="expression", expression="v / nullif(v, 0) > 0"), rule(name="w", type="domain", columns=["v"], allowed=["1"], severity="warn"), rule(name="gone", type="not_null", columns=["zz"])]
    df = spark.createDataFrame([(1,), (0,), (-1,), (None,), (2,)], "v int")
    out = quality.evaluate(df, rules, 0.5)
    assert out.valid.count() + out.quarantined.count() == 5 == out.rows_in and out.rows_quarantined == 1
    assert {r.rule: r.status for r in out.results} == {"a": "FAILED", "b": "PASSED", "w": "FAILED", "gone": "SKIPPED"}
    assert [r[0] for r in out.valid.where("v = 2").select("_dq_warnings").collect()] == [["w"]]


def test_fatal_carries_its_outcome(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "id int, v int")
    with pytest.raises(quality.FatalQualityError) as e:
        quality.evaluate(df, [rule(name="u", type="unique", columns=["id"], severity="fatal")])
    assert e.value.outcome.results[0].violations == 1
    with pytest.raises(quality.FatalQualityError):
        quality.evaluate(df, [rule(name="n", type="not_null", columns=["v"])], 0.8)


def test_batch_rules(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1)), (9, T(2024, 1, 2)), (None, None)], "id int, at timestamp")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    rules = [rule(name="ref", type="referential", columns=["id"], reference="p.id"), rule(name="fresh", type="freshness", columns=["at"], max_age_hours=30), rule(name="vol", type="volume")]
    out = quality.evaluate(df, rules, 0.1, reference=lambda n: parent, trailing_mean=10, as_of=T(2024, 1, 3))
    assert [(r.status, r.violations) for r in out.results] == [("FAILED", 1), ("PASSED", 0), ("FAILED", 1)]
    assert quality.evaluate(df, rules[:1], 0.1).results[0].status == "SKIPPED"


MERGE = "id int, v string, _source_lsn long, is_deleted boolean"


def test_merge_is_idempotent_and_ignores_old(spark):
    target = spark.createDataFrame([(1, "a", 5, False), (2, "b", None, False), (3, "c", 9, False), (None, "n", 1, False)], MERGE)
    source = spark.createDataFrame([(1, "A", 6, False), (2, "B", 1, False), (3, "old", 8, False), (4, "D", 1, True), (None, "N", 2, False)], MERGE)
    once = merge.merge(target, source, ["id"])
    assert rows(once, "id", "v") == sorted([(1, "A"), (2, "B"), (3, "c"), (4, "D"), (None, "N")], key=repr)
    assert rows(merge.merge(once, source, ["id"]), "*") == rows(once, "*")
    assert merge.merge_metrics(target, source, ["id"]).first().asDict() == {"inserted": 1, "updated": 3, "ignored": 1}
    marked = merge.merge_marked(target, source.withColumn("_merge_copies", F.lit(1)), ["id"])
    assert rows(marked.where("_merge_kind is not null"), "id", "_merge_kind", "_merge_copies") == sorted([(1, "updated", 1), (2, "updated", 1), (3, "ignored", 1), (4, "inserted", 1), (None, "updated", 1)], key=repr)


HISTORY = "id int, c string, at timestamp"


def test_scd2_intervals(spark):
    changes = [(1, "a", T(2020, 1, 1)), (1, "a", T(2020, 2, 1)), (1, "b", T(2020, 3, 1)), (1, "a", T(2020, 4, 1)), (2, None, T(2020, 1, 1)), (2, "x", T(2021, 1, 1))]
    df = spark.createDataFrame(changes, HISTORY)
    dim = scd.scd2(df, ["id"], ["c"], "at", "things")
    got = rows(dim, "id", "c", "effective_start_ts", "effective_end_ts", "is_current")
    begin, end = T(1900, 1, 1), T(9999, 12, 31, 23, 59, 59)
    assert got == sorted([(1, "a", begin, T(2020, 3, 1), False), (1, "b", T(2020, 3, 1), T(2020, 4, 1), False), (1, "a", T(2020, 4, 1), end, True), (2, None, begin, T(2021, 1, 1), False), (2, "x", T(2021, 1, 1), end, True)], key=repr)
    assert dim.select("things_sk").distinct().count() == 5
    # later changes, in any order, give the same versions
    first = scd.scd2(df.where("month(at) < 3"), ["id"], ["c"], "at", "things")
    late = scd.apply_scd2(first, df.where("month(at) >= 3").orderBy(F.desc("at")), ["id"], ["c"], "at", "things")
    assert rows(late, "id", "c", "effective_end_ts", "is_current") == rows(dim, "id", "c", "effective_end_ts", "is_current")


def test_late_changes_equal_a_full_rebuild(spark):
    """Random histories with ties and unchanged deliveries, in random batches: as if all had come at once."""
    random.seed(4)
    changes = [(k, random.choice("aab") if k % 3 else random.choice("ab"), T(2020, 1, random.randint(1, 28))) for k in range(60) for _ in range(random.randint(1, 14))]
    frame = lambda part: spark.createDataFrame(part, HISTORY)
    random.shuffle(changes)
    dim = scd.scd2(frame(changes[:150]), ["id"], ["c"], "at", "things")
    for a, b in ((150, 157), (157, 300), (300, len(changes))):
        kept = dim.toArrow()  # cuts the plan, as a written table does
        dim = scd.apply_scd2(spark.createDataFrame(kept, dim.schema), frame(changes[a:b]), ["id"], ["c"], "at", "things")
    whole = scd.scd2(frame(changes), ["id"], ["c"], "at", "things")
    seen = F.array_sort("_seen").cast("string").alias("seen")
    columns = ("id", "c", "at", "effective_start_ts", "effective_end_ts", "is_current", "things_sk", seen)
    assert rows(dim, *columns) == rows(whole, *columns)


def test_as_of_join_of_a_hot_key(spark):
    """10,000 versions of one key and as many facts: every operator's output stays linear."""
    n = 10_000
    dim = spark.range(n).selectExpr("1 as id", "cast(id as string) as c", "timestamp_seconds(id * 3600) as effective_start_ts", "timestamp_seconds((id + 1) * 3600) as effective_end_ts")
    facts = spark.range(n).selectExpr("1 as id", "id as f", "timestamp_seconds(id * 3601) as t")
    got = scd.as_of_join(facts, dim, "id", "t", ["c"])
    assert {r.f: r.c for r in got.collect()} == {f: str(f * 3601 // 3600) if f * 3601 < n * 3600 else None for f in range(n)}
    metrics, nodes = [], [got._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numOutputRows"):
            metrics.append(node.metrics().apply("numOutputRows").value())
        for get in ("executedPlan", "plan"):
            try:
                nodes.append(getattr(node, get)())
            except Exception:
                pass
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    assert metrics and max(metrics) <= 3 * n


def test_as_of_join_and_inferred(spark):
    dim = scd.scd2(spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "b", T(2020, 3, 1))], HISTORY), ["id"], ["c"], "at", "things")
    facts = spark.createDataFrame([(1, T(2019, 1, 1)), (1, T(2020, 3, 1)), (1, T(2020, 2, 29, 23, 59, 59, 999999)), (7, T(2020, 1, 1)), (None, None)], "id int, t timestamp")
    got = scd.as_of_join(facts, dim, "id", "t", ["c"])
    assert rows(got, "id", "t", "c") == sorted([(1, T(2019, 1, 1), "a"), (1, T(2020, 3, 1), "b"), (1, T(2020, 2, 29, 23, 59, 59, 999999), "a"), (7, T(2020, 1, 1), None), (None, None, None)], key=repr)
    more = scd.add_inferred_members(dim, facts, "id", "things")
    assert more.where("is_inferred").count() == 1
    keyed = scd.resolve_keys(facts, {"thing_sk": (dim, "id", "things_sk", "scd2")}, "t")
    assert keyed.where("thing_sk = -1").count() == 2


def test_governance(spark):
    text = "SELECT 1; -- a; b\nSELECT ';' /* ; */ AS x;\n"
    assert governance.split_statements(text) == ["SELECT 1", "SELECT ';'  AS x"]
    failures = governance.apply_statements(spark, "SELECT ${n}; SELECT nope; SELECT 2", {"n": "1"})
    assert [f.statement for f in failures] == ["SELECT nope"]
    df = spark.createDataFrame([("a@b.c", "12345", False), ("d@e.f", "1", True)], "email string, postal_code string, is_deleted boolean")
    assert governance.secured(df, "dim_customers", ("pii_reader",)).where("email = 'a@b.c'").count() == 1
    assert rows(governance.secured(df, "dim_customers", ("analyst",)), "postal_code") == [("123**",)]


def test_dedup_report_counts_rows_as_they_are(spark):
    """NULLs are equal to each other; values that differ in blanks alone are not equal."""
    df = spark.createDataFrame([(1, "a"), (1, "a "), (1, "a"), (None, "b"), (None, "b"), (2, None)], "k int, v string")
    assert dedup.dedup_report(df, ["k"], ["k", "v"]).first().asDict() == {"rows_in": 6, "distinct_keys": 3, "duplicate_rows": 3, "exact_duplicates": 2}
    assert dedup.dedup_report(df.limit(0), ["k"], ["k", "v"]).first().asDict() == {"rows_in": 0, "distinct_keys": 0, "duplicate_rows": 0, "exact_duplicates": 0}
