"""What the lake must survive and what it must not read: buckets, torn commits, snapshots, schemas, rescued values."""

import json
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.config import Entity, Environment, Rule, Source
from lakeloom.operators import quality
from lakeloom.operators.clustering import clustered
from lakeloom.plans import reconcile, runner
from lakeloom.plans.audit import Audit
from lakeloom.sources import files
from lakeloom.sources.tablestore import ATTEMPTS, CommitConflict, Table
from lakeloom.streaming.ingest import OPEN_FILES, bronze_batches, ingest_entity, read_bronze, validate_bronze


def stamps(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if "_manifests" not in d}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["id"], buckets=64)
    t.overwrite(spark.range(2000).selectExpr("id", "id * 2 as v"))
    before, folders = stamps(tmp_path), set(t.history()[-1]["folders"])
    assert len(folders) == 64
    assert t.merge(spark.createDataFrame([(7, 0)], "id long, v long"), mark="x") == {"inserted": 0, "updated": 1, "ignored": 0}
    now = set(t.history()[-1]["folders"])
    assert len(folders & now) == 63 and before.items() <= stamps(tmp_path).items()
    # readers of other versions, and the change feed, which reads that bucket alone
    assert t.read(0).where("id = 7").first().v == 14 and t.read().where("id = 7").first().v == 0 and t.read().count() == 2000
    feed = t.changes(0)
    assert [tuple(r) for r in feed.collect()] == [(7, 0, "update")] and len(feed.inputFiles()) == 2
    assert t.metrics()["mark"] == "x" and t.metrics()["rows"] < 200
    # a new column, a new key, and more rows of one key
    t.merge(spark.createDataFrame([(5000, 1, "n")], "id long, v long, more string"))
    t.replace(spark.createDataFrame([(8,)], "id long"), spark.createDataFrame([(8, 1), (8, 2)], "id long, v long"))
    assert t.read().where("id = 8").count() == 2 and t.read().where("more = 'n'").count() == 1 and t.read().count() == 2002
    with pytest.raises(ValueError):
        t.merge(spark.createDataFrame([(1, 1), (1, 2)], "id long, v long"))
    assert t.version() == 3


def test_counts_come_from_the_write(spark, tmp_path):
    t, sc = Table(spark, str(tmp_path / "t")), spark.sparkContext
    df = spark.range(0, 1000, 1, 3)
    sc.setJobGroup("one-write", "")
    t.overwrite(df.where("id % 7 = 0"))
    jobs = sc.statusTracker().getJobIdsForGroup("one-write")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and t.metrics()["rows"] == 143 == t.read().count()
    t.overwrite(df.limit(0))
    assert t.metrics()["rows"] == 0 and t.read().columns == ["id"]
    rules = [Rule(name="small", type="range", severity="error", columns=["id"], max=900), Rule(name="once", type="unique", severity="warn", columns=["id"])]
    path = str(tmp_path / "staged")

    def stage(flagged):
        flagged.write.parquet(path)
        return spark.read.schema(flagged.schema).parquet(path)

    got = quality.evaluate(df.unionAll(df.limit(3)), rules, 0.5, stage=stage)
    assert (got.rows_in, got.rows_quarantined, got.valid.count()) == (1003, 99, 904)
    assert {r.rule: r.violations for r in got.results} == {"small": 99, "once": 3}
    assert quality.counted(df.where("id < 17"))[0] == 17 and len(quality.counted(df)[1]) == quality.SAMPLES


def test_partitions_prune(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), partition_by=["day"])
    t.overwrite(spark.range(0, 300, 1, 5).selectExpr("id", "cast(20240101 + id % 3 as int) as day"))
    assert sorted(p.name for p in tmp_path.glob("t/v=*/day=*")) == [f"day=2024010{i}" for i in (1, 2, 3)]
    assert t.read().where("day = 20240102").count() == 100 and dict(t.read().dtypes)["day"] == "int"
    assert "PartitionFilters: [isnotnull(day" in t.read().where("day = 20240102")._jdf.queryExecution().toString()


def test_torn_manifests_and_orphans(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["id"])
    one = spark.createDataFrame([(1,)], "id int")
    t.append(one)
    for number, text in ((1, ""), (2, '{"version": 9')):
        (tmp_path / f"t/_manifests/{number:012d}.json").write_text(text)
    assert t.append(one) == 1 and t.read().count() == 2
    assert t.merge(spark.createDataFrame([(2,)], "id int"))["inserted"] == 1
    one.write.parquet(str(tmp_path / "t/v=9-dead"))  # of a writer that died
    assert t.vacuum() == []  # younger than the limit: it may still commit
    gone = t.vacuum(0, now=time.time() + 10, force=True)
    assert "v=9-dead" in gone and not (tmp_path / "t/v=9-dead").exists() and t.read().count() == 3


def test_appends_end(spark, tmp_path, monkeypatch):
    t, tries = Table(spark, str(tmp_path / "t")), []

    def lost(*args, **kw):
        tries.append(1)
        raise CommitConflict("again")

    monkeypatch.setattr(t, "_commit", lost)
    monkeypatch.setattr(time, "sleep", lambda s: None)
    with pytest.raises(CommitConflict):
        t.append(spark.range(1))
    assert len(tries) == ATTEMPTS


def test_row_flow_sees_loss(spark):
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    check = lambda *frames: reconcile.row_flow("e", *frames, ["id"]).first().status
    assert check(rows(1, 2, None), rows(1), rows(2, None)) == "PASSED"
    assert check(rows(1, 2), rows(1), rows(3)) == check(rows(1, 2), rows(), rows()) == "FAILED"


@pytest.fixture
def products(spark, tmp_path):
    """Two snapshots wait in one batch, a third comes later."""
    env = Environment(name="demo", warehouse=str(tmp_path / "w"), landing_root=str(tmp_path / "l"), checkpoint_root=str(tmp_path / "c"), schema_root=str(tmp_path / "s"), fail_threshold=0.1, buckets=4)
    entity = Entity(name="products", source=Source(system="pim", format="csv", path_glob="products/dt=*/*.csv", options={"header": "true"}), load_type="full", primary_key=["id"], watermark="at", order_by=["at"], scd_type="scd2", tracked=["price"])
    rules = [Rule(name="price", type="range", severity="error", columns=["price"], min=0)]

    def land(date, *rows):
        p = tmp_path / f"l/products/dt={date}/a.csv"
        p.parent.mkdir(parents=True)
        p.write_text("id,price,at\n" + "".join(f"{i},{price},{date}T00:00:00\n" for i, price in rows))

    def run(batch):
        ingest_entity(spark, env, entity, batch, "r")
        return runner.process_silver(spark, env, entity, rules, Audit(spark, env), batch)

    return env, entity, land, run


def test_each_snapshot_in_its_turn(spark, products, tmp_path):
    env, entity, land, run = products
    land("2024-01-01", ("p1", 1), ("p2", 2), ("p3", 3), ("p9", -1))
    land("2024-02-01", ("p1", 1), ("p3", -3))
    assert run("b1") == {"status": "SUCCESS", "rows": 4, "quarantined": 2}
    state = lambda: {r.id: (r.price, r.is_deleted) for r in Table(spark, env.table_path("silver", "products")).read().collect()}
    assert state() == {"p1": (1, False), "p2": (2, True), "p3": (3, False)}
    current = lambda: {r.id: r.is_deleted for r in Table(spark, env.table_path("gold", "dim_products")).read().where("is_current").collect()}
    assert current() == {"p1": False, "p2": True, "p3": False}
    # what was read isn't needed again
    os.rename(tmp_path / "w/bronze/pim_products/_batch=b-b1", tmp_path / "read-already")
    land("2024-03-01", ("p2", 2), ("p3", 5), ("p4", -4))
    run("b2")
    assert state() == {"p1": (1, True), "p2": (2, False), "p3": (5, False)}
    assert current() == {"p1": True, "p2": False, "p3": False}
    versions = Table(spark, env.table_path("gold", "dim_products")).read()
    assert versions.count() == 4 and not versions.where("price < 0").count()
    kept = runner.read_quarantine(spark, env, entity)
    assert {(r.id, r["_delivery"]) for r in kept.collect()} == {("p9", "b1-2024-01-01"), ("p3", "b1-2024-02-01"), ("p4", "b2-2024-03-01")}
    os.rename(tmp_path / "read-already", tmp_path / "w/bronze/pim_products/_batch=b-b1")
    assert bronze_batches(spark, env, entity) == ["b1", "b2"] and bronze_batches(spark, env, entity, ["b1"]) == ["b2"]
    flow = reconcile.row_flow("products", runner.tidied(spark, env, entity), Table(spark, env.table_path("silver", "products")).read(), kept, ["id"]).first()
    assert (flow.status, int(flow.source_value)) == ("PASSED", 5)


def test_tasks_dont_grow_with_a_delivery(spark, products, tmp_path, monkeypatch):
    """More rows are more tasks, whatever their compressed bytes; before, one task sorted all that fit in 64 MB of a shuffle."""
    env, entity, land, run = products
    monkeypatch.setattr("lakeloom.operators.clustering.ROWS_A_TASK", 3)
    land("2024-01-01", *((f"p{i:02}", i) for i in range(60)))
    assert run("b1") == {"status": "SUCCESS", "rows": 60, "quarantined": 0}
    land("2024-02-01", *((f"p{i:02}", i + i % 2) for i in range(59)))
    run("b2")
    parts = [f for f in os.listdir(tmp_path / "w/silver/products_staged") if f.endswith(".parquet")]
    assert len(parts) > 10
    assert {r.id: (r.price, r.is_deleted) for r in Table(spark, env.table_path("silver", "products")).read().collect()} == {f"p{i:02}": (i + i % 2 * (i < 59), i == 59) for i in range(60)}
    versions = Table(spark, env.table_path("gold", "dim_products")).read()
    assert versions.count() == 60 + 29 and versions.where("is_current").count() == 60 and versions.where("is_deleted").count() == 1
    assert spark.conf.get(OPEN_FILES, None) is None


def test_dimension_of_a_late_delivery(spark, tmp_path):
    """Incremental batches out of order give the dimension that all at once give; Bronze of earlier batches isn't read."""
    made = {}
    rows = [("k1", "a", "01"), ("k1", "b", "05"), ("k2", "x", "02"), ("k1", "a", "03"), ("k2", "x", "09"), ("k1", "b", "07"), ("k2", "y", "04"), ("k3", "n", "01")]
    for name, parts in (("late", [rows[:3], rows[3:5], rows[5:]]), ("whole", [rows])):
        root = tmp_path / name
        env = Environment(name="demo", warehouse=f"{root}/w", landing_root=f"{root}/l", checkpoint_root=f"{root}/c", schema_root=f"{root}/s", buckets=4)
        entity = Entity(name="people", source=Source(system="crm", format="json", path_glob="people/*.json"), load_type="incremental", primary_key=["id"], watermark="at", order_by=["at"], scd_type="scd2", tracked=["c"])
        for k, part in enumerate(parts):
            (root / "l/people").mkdir(parents=True, exist_ok=True)
            (root / f"l/people/{k}.json").write_text("".join(json.dumps({"id": i, "c": c, "at": f"2024-01-{d}T00:00:00"}) + "\n" for i, c, d in part))
            ingest_entity(spark, env, entity, f"b{k}", "r")
            assert runner.process_silver(spark, env, entity, [], Audit(spark, env), f"b{k}")["status"] == "SUCCESS"
            for old in range(k + 1):
                if (folder := root / f"w/bronze/crm_people/_batch=b-b{old}").exists():
                    os.rename(folder, root / f"read-{old}")
        dim = Table(spark, env.table_path("gold", "dim_people")).read()
        made[name] = sorted(tuple(map(str, r)) for r in dim.select("id", "c", "effective_start_ts", "effective_end_ts", "is_current", F.array_sort("_seen")).collect())
    assert made["late"] == made["whole"] and len(made["whole"]) == 6


# --- files


def entity_of(fmt, **options):
    return Entity(name="things", source=Source(system="s", format=fmt, path_glob=f"things/*.{fmt}", options=options), load_type="incremental", primary_key=["id"], watermark="id", order_by=["id"])


@pytest.fixture
def landing(tmp_path):
    env = Environment(name="demo", warehouse=str(tmp_path / "w"), landing_root=str(tmp_path / "l"), checkpoint_root=str(tmp_path / "c"), schema_root=f"file://{tmp_path}/s")
    (tmp_path / "l/things").mkdir(parents=True)
    return env, lambda name, text: (tmp_path / "l/things" / name).write_text(text)


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("deep", T.StructType([T.StructField("x", T.IntegerType())]))])


def test_rescued_json(spark, landing):
    env, put = landing
    put("a.json", '{"id": 1, "n": 2, "deep": {"x": 5}}\n{"id": 2, "n": "two", "extra": {"y": [1]}, "none": null}\nnot json\n\n{"id": 12345678901234567890, "n": 1.5}\n')
    want = {(1, 2, 5, None), (2, None, None, '{"extra":"{\\"y\\":[1]}","n":"two"}'), (None, None, None, '{"_broken":"not json"}'), (None, None, None, '{"id":"12345678901234567890","n":"1.5"}')}
    entity = entity_of("json")
    for df in (files.read_batch(spark, env, entity, SCHEMA), bronze_of(spark, env, entity, SCHEMA)):
        got = {(r.id, r.n, r.deep and r.deep.x, r[files.RESCUED]) for r in df.collect()}
        assert got == want
        assert all(r[files.FILE].endswith("a.json") for r in df.collect())


def bronze_of(spark, env, entity, schema):
    df = files.read_stream(spark, env, entity, schema)
    query = df.writeStream.format("memory").queryName("rescued").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table("rescued")


def test_rescued_csv_and_parquet(spark, landing, tmp_path):
    env, put = landing
    schema = T.StructType(SCHEMA.fields[:2])
    put("a.csv", "id,n\n1,2\n2,two\n3,4,5\n")
    put("b.csv", "id,n,extra\n4,5,six\n")
    got = {(r.id, r.n, r[files.RESCUED]) for r in files.read_batch(spark, env, entity_of("csv", header="true"), schema).collect()}
    assert got == {(1, 2, None), (2, None, '{"n":"two"}'), (3, 4, '{"_broken":"3,4,5"}'), (4, 5, '{"extra":"six"}')}
    spark.createDataFrame([(1, "2", "e"), (2, "two", None)], "id int, n string, extra string").write.parquet(str(tmp_path / "p/x"))
    spark.createDataFrame([(3, 4)], "id bigint, n int").write.parquet(str(tmp_path / "p/y"))
    spark.createDataFrame([(5, 6.0), (7, 8.5)], "id bigint, n double").write.parquet(str(tmp_path / "p/z"))
    for k, d in enumerate(("x", "y", "z")):
        for i, f in enumerate((tmp_path / "p" / d).glob("part-*.parquet")):
            os.rename(f, tmp_path / f"l/things/{k}{i}.parquet")
    got = {(r.id, r.n, r[files.RESCUED]) for r in files.read_batch(spark, env, entity_of("parquet"), schema).collect()}
    assert got == {(1, 2, '{"extra":"e"}'), (2, None, '{"n":"two"}'), (3, 4, None), (5, 6, None), (7, None, '{"n":"8.5"}')}


def test_schemas_widen_by_new_files_alone(spark, landing, monkeypatch):
    env, put = landing
    entity, read, infer = entity_of("json"), [], files.infer_schema
    monkeypatch.setattr(files, "infer_schema", lambda spark, paths, *a: read.append([os.path.basename(p) for p in paths]) or infer(spark, paths, *a))
    put("a.json", '{"id": 1, "n": 1, "later": null}\n')
    monkeypatch.setattr(files, "hinted", lambda schema, hints: T.StructType([T.StructField(f.name, T.IntegerType() if f.name == "n" and not os.path.exists(f"{env.landing_root}/things/b.json") else f.dataType) for f in schema.fields]))
    assert files.registered_schema(spark, env, entity).simpleString() == "struct<id:bigint,n:int>"
    assert files.registered_schema(spark, env, entity).simpleString() == "struct<id:bigint,n:int>"
    put("b.json", '{"n": 3000000000, "later": 1.5}\n')
    assert files.registered_schema(spark, env, entity).simpleString() == "struct<id:bigint,n:bigint,later:double>"
    put("c.json", '{"id": "x", "n": 1}\n{"id": 7}\n')  # one value fits: the other is rescued
    assert files.registered_schema(spark, env, entity)["id"].dataType == T.LongType()
    put("d.json", '{"id": "y"}\n')
    with pytest.raises(files.SchemaDriftError):
        files.registered_schema(spark, env, entity)
    assert read == [["a.json"], ["b.json"], ["c.json"], ["d.json"]]
    assert files.Registry(spark, env.schema_path("things")).latest()["version"] == 2


@pytest.mark.parametrize("a, b, out", [("int", "bigint", "bigint"), ("bigint", "tinyint", "bigint"), ("float", "double", "double"), ("int", "double", "double"), ("bigint", "double", None), ("bigint", "string", None), ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("array<int>", "array<bigint>", "array<bigint>"), ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("struct<a:int>", "struct<a:string>", None), ("date", "timestamp", None)])
def test_widening(spark, a, b, out):
    kind = lambda t: T.StructType.fromDDL(f"c {t}")["c"].dataType
    got = files.widened(kind(a), kind(b))
    assert (got and got.simpleString()) == out


def test_ingestion_counts(spark, landing):
    env, put = landing
    put("a.json", '{"id": 1}\n{"id": 2}\nnope\n')
    put("b.json", '{"id": 3}\n')
    entity = entity_of("json")
    got = ingest_entity(spark, env, entity, "b1", "r")
    recount = validate_bronze(read_bronze(spark, env, entity, ["b1"]))
    assert (got["rows"], got["rescued"]) == (recount["rows"], recount["rescued"]) == (4, 1)
    assert ingest_entity(spark, env, entity, "b2", "r")["rows"] == 0


def test_clustering_by_two_keys(spark, tmp_path):
    """Filters on either key leave under a quarter of the files, by their footers."""
    df = spark.range(0, 200_000, 1, 4).selectExpr("id", "cast(pmod(xxhash64(id), 1000) as int) as a", "date_add(date '2024-01-01', cast(pmod(xxhash64(id, 1), 1000) as int)) as b")
    clustered(df, ["a", "b"], files=64).write.parquet(str(tmp_path / "t"))
    footers = [pq.ParquetFile(p).metadata for p in (tmp_path / "t").glob("part-*.parquet")]
    assert len(footers) >= 60

    def touched(column, value):
        stats = [[m.row_group(i).column(column).statistics for i in range(m.num_row_groups)] for m in footers]
        return sum(any(s.min <= value <= s.max for s in own) for own in stats)

    import datetime as dt

    assert touched(1, 500) < len(footers) / 4 and touched(2, dt.date(2025, 6, 1)) < len(footers) / 4
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.count("*"), F.sum("id")).first()[:] == (200_000, sum(range(200_000)))
