"""Stages end to end: bronze (parallel, isolated), silver (in order), gold, reconciliation; and their command line."""

from __future__ import annotations

import argparse
import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.config import Entity, Environment, LoadType, SCDType, load_entities, load_environment, load_rules
from lakeloom.operators import envelope, merge
from lakeloom.operators.clustering import dealt
from lakeloom.operators.dedup import deduplicate
from lakeloom.operators.quality import FatalQualityError, bindable, evaluate, flag, route
from lakeloom.operators.scd import add_inferred_members, apply_scd2, scd1, scd2
from lakeloom.operators.standardise import standardise
from lakeloom.plans import catalog, dims, facts, marts, reconcile, session_views
from lakeloom.plans.audit import Audit, get_logger, log_event, run_id
from lakeloom.sources.files import control_totals
from lakeloom.sources.session import get_spark, table_exists
from lakeloom.sources.tablestore import Table
from lakeloom.streaming.ingest import bronze_batches, ingest_entity, read_bronze

#: Parents before children, so references can be checked.
ORDER = ("categories", "promotions", "stores", "customers", "products", "orders", "order_items", "payments", "shipments", "returns", "inventory", "events")
#: US states by census region, for customers that come without one.
REGIONS = {
    "NORTHEAST": "CT ME MA NH RI VT NJ NY PA",
    "MIDWEST": "IL IN MI OH WI IA KS MN MO NE ND SD",
    "SOUTH": "DE FL GA MD NC SC VA DC WV AL KY MS TN AR LA OK TX",
    "WEST": "AZ CO ID MT NV NM UT WY AK CA HI OR WA",
}
#: Amounts that change events carry as strings.
MONEY = ("unit_price", "discount_amount", "tax_amount", "payment_amount", "refund_amount")
logger = get_logger("lakeloom")


def run_bronze(spark: SparkSession, env: Environment, entities: dict[str, Entity], batch_id: str) -> dict[str, dict]:
    """Each entity on its own thread; one that fails doesn't stop the others."""
    audit = Audit(spark, env)

    def one(entity: Entity) -> dict:
        try:
            with audit.task("bronze", entity.name, batch_id) as record:
                report = ingest_entity(spark, env, entity, batch_id, run_id())
                record.rows_in = record.rows_out = report["rows"]
            return report | {"status": "SUCCESS"}
        except Exception as e:
            log_event(logger, "bronze failed", entity=entity.name, error=str(e)[:500])
            return {"status": "FAILED", "error": str(e)[:500]}

    run_id()
    with ThreadPoolExecutor(env.max_parallel) as pool:
        futures = {name: pool.submit(copy_context().run, one, e) for name, e in entities.items()}
        return {name: f.result() for name, f in futures.items()}


def silver_table(spark: SparkSession, env: Environment, entity: Entity) -> Table:
    return Table(spark, env.table_path("silver", entity.name), list(entity.primary_key), list(entity.partition_by), list(entity.cluster_by), buckets=env.buckets)


def dimension_table(spark: SparkSession, env: Environment, entity: Entity) -> Table:
    return Table(spark, env.table_path("gold", f"dim_{entity.name}"), list(entity.primary_key), buckets=env.buckets)


def derive(df: DataFrame, name: str) -> DataFrame:
    """Columns that contracts name and sources lack (a customer's region, an event's date), and money as decimals."""
    if name == "customers" and "region" not in df.columns and "state" in df.columns:
        region = F.lit(None).cast("string")
        for r, states in REGIONS.items():
            region = F.when(F.col("state").isin(*states.split()), r).otherwise(region)
        df = df.withColumn("region", region)
    kinds = dict(df.dtypes)
    df = df.withColumns({c: F.col(c).try_cast("decimal(18,2)") for c in MONEY if kinds.get(c) == "string"})
    if name == "events" and "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date(F.col("event_time").cast("timestamp")))
    return df


def process_silver(spark: SparkSession, env: Environment, entity: Entity, rules: list, audit: Audit, batch_id: str) -> dict:
    """Unwrap, standardise, deduplicate, check, merge, and write the dimension's history, of new batches alone.

    Each snapshot of a full load is applied in its turn, also where a batch brings several (dt folders) or
    several batches wait: rows that one lacks are soft-deleted, and come back with the next that has them. The
    table's notes name the batches it holds, so a batch whose entity failed comes again with the next.
    """
    table = silver_table(spark, env, entity)
    done = table.metrics().get("batches", [])
    new = bronze_batches(spark, env, entity, done)
    out = {"status": "SUCCESS", "rows": 0, "quarantined": 0}
    if not new:
        return out
    if entity.load_type is not LoadType.FULL:
        steps = [(tidied(spark, env, entity, new), new[-1], [*done, *new], new)]
    else:
        steps = []
        for batch in new:
            delivery, held = tidied(spark, env, entity, [batch]), done + new[: new.index(batch)]
            # as many dates as the batch has folders
            dates = sorted((r[0] for r in delivery.select("dt").distinct().collect()), key=str) if "dt" in delivery.columns else [None]
            for k, date in enumerate(dates):
                snapshot = delivery.where(F.col("dt").eqNullSafe(F.lit(date))) if "dt" in delivery.columns else delivery
                steps.append((snapshot, f"{batch}-{date}" if date is not None else batch, [*held, batch] if k == len(dates) - 1 else held, [batch]))
    for delivery, name, batches, read in steps:
        # footers tell how many rows there are
        delivery = dealt(delivery, entity.primary_key, read_bronze(spark, env, entity, read).count())
        rows, quarantined = _silver_step(spark, env, entity, rules, audit, batch_id, delivery, name, batches)
        out["rows"] += rows
        out["quarantined"] += quarantined
    return out


def _silver_step(spark: SparkSession, env: Environment, entity: Entity, rules: list, audit: Audit, batch_id: str, delivery: DataFrame, name: str, batches: list[str]) -> tuple[int, int]:
    """One delivery (of incremental batches, or one snapshot), dealt by key, into silver, quarantine and the dimension."""
    table, key = silver_table(spark, env, entity), list(entity.primary_key)
    staged = f"{env.table_path('silver', entity.name)}_staged"

    def stage(flagged: DataFrame) -> DataFrame:
        # checks, quarantine and merge all read what is written down here once
        flagged.write.mode("overwrite").parquet(staged)
        return spark.read.schema(flagged.schema).parquet(staged)

    def reference(table: str) -> DataFrame | None:
        t = Table(spark, env.table_path("silver", table))
        return t.read() if t.exists() else None

    latest = deduplicate(delivery, key, list(entity.order_by or (entity.watermark,)))
    with audit.task("silver", entity.name, batch_id) as record:
        try:
            outcome = evaluate(latest, rules, env.fail_threshold, reference, audit.trailing_mean_rows(entity.name, "silver"), stage=stage)
        except FatalQualityError as e:
            audit.quality(entity.name, "silver", batch_id, e.outcome)
            write_quarantine(env, entity, e.outcome.quarantined, name)
            raise
        audit.quality(entity.name, "silver", batch_id, outcome)
        write_quarantine(env, entity, outcome.quarantined, name)
        valid, before, now = dealt(outcome.valid.drop("_dq_warnings"), key, outcome.rows_in), table.version(), F.current_timestamp()
        if entity.load_type is LoadType.FULL and before >= 0:
            # a row that came but was quarantined isn't gone: its last valid state stays
            state = dealt(table.read(), key)
            kept = state.join(outcome.quarantined.select(*key).distinct(), key, "left_semi").select(*[c for c in valid.columns if c in state.columns])
            table.overwrite(merge.snapshot_deletes(state, valid.unionByName(kept, allowMissingColumns=True), key, now), batches=batches)
        else:
            table.merge(merge.with_soft_delete(valid, now), entity.watermark, batches=batches)
        if entity.scd_type is not SCDType.NONE:
            _write_dimension(spark, env, entity, delivery, before, rules, now)
        record.rows_in, record.rows_out, record.rows_quarantined = outcome.rows_in, outcome.rows_valid, outcome.rows_quarantined
    return outcome.rows_valid, outcome.rows_quarantined


def quarantine_path(env: Environment, entity: Entity) -> str:
    return f"{env.table_path('silver', entity.name)}_quarantine"


def write_quarantine(env: Environment, entity: Entity, bad: DataFrame, step: str) -> None:
    """A folder for each delivery: one that comes again replaces its own, all others stay."""
    folder = re.sub(r"[^\w.-]", "_", step)
    bad.withColumn("_quarantined_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{quarantine_path(env, entity)}/_delivery={folder}")


def read_quarantine(spark: SparkSession, env: Environment, entity: Entity) -> DataFrame | None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(quarantine_path(env, entity))
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.option("mergeSchema", "true").parquet(quarantine_path(env, entity))


def tidied(spark: SparkSession, env: Environment, entity: Entity, batches: list[str] | None = None) -> DataFrame:
    """Bronze rows of the named batches (or all), unwrapped and standardised."""
    bronze = read_bronze(spark, env, entity, batches)
    if envelope.is_envelope(bronze):
        bronze = envelope.unwrap(bronze, entity.primary_key)
    return derive(standardise(bronze, entity.exclude), entity.name)


def _write_dimension(spark: SparkSession, env: Environment, entity: Entity, delivery: DataFrame, before: int, rules: list, now) -> None:
    """The dimension after one delivery, of that delivery and the dimension's own versions alone.

    Only rows that pass their rules make versions. Deletions come from what has changed in silver since version
    `before`. With buckets only those of the keys concerned are read and written.
    """
    table, silver, key = dimension_table(spark, env, entity), silver_table(spark, env, entity), list(entity.primary_key)
    state = silver.changes(before).where("_change_type <> 'delete'").drop("_change_type") if before >= 0 else silver.read()
    if entity.scd_type is SCDType.SCD1:
        table.merge(scd1(state, entity.name, key, now), always=True)
        return
    changes = route(flag(delivery, [r for r in rules if not r.is_batch and bindable(r, delivery.columns, delivery)]))[0].drop("_dq_warnings")
    when = entity.watermark if entity.watermark in changes.columns else "updated_at" if "updated_at" in changes.columns else "_ingest_ts"
    changes = changes.withColumn(when, F.col(when).cast("timestamp"))
    gone = state.select(*key, F.col("is_deleted").alias("_gone"))
    if not table.exists():
        first = scd2(changes, key, list(entity.tracked), when, entity.name)
        table.overwrite(merge.carry_deletes(first, gone))
        return
    keys = changes.select(*key).unionByName(gone.select(*key)).distinct()
    near = dealt(table.read(buckets=table.touched(keys) if table.buckets else None), key).join(keys, key, "left_semi")
    sliced = apply_scd2(near, changes, key, list(entity.tracked), when, entity.name)
    table.replace(keys, merge.carry_deletes(sliced, gone, near))


def run_silver(spark: SparkSession, env: Environment, entities: dict[str, Entity], batch_id: str) -> dict[str, dict]:
    audit, rules, out = Audit(spark, env), load_rules(), {}
    for name in [n for n in ORDER if n in entities]:
        try:
            out[name] = process_silver(spark, env, entities[name], rules.get(name, []), audit, batch_id)
        except FatalQualityError as e:
            out[name] = {"status": "FATAL_DQ", "error": str(e)}
        except Exception as e:
            out[name] = {"status": "FAILED", "error": str(e)[:500]}
    return out


#: Dimensions that facts name: key column, dimension, business key, its surrogate key, how it is kept.
DIMENSIONS = {
    "customer_sk": ("dim_customers", "customer_id", "customers_sk", "scd2"),
    "product_sk": ("dim_products", "product_id", "products_sk", "scd2"),
    "store_sk": ("dim_stores", "store_id", "stores_sk", "scd2"),
    "category_sk": ("dim_categories", "category_id", "categories_sk", "scd1"),
    "promotion_sk": ("dim_promotions", "promotion_id", "promotions_sk", "scd1"),
}
#: Where facts' keys come from: members that a dimension lacks are inferred from there.
NAMED_BY = {"dim_customers": "orders", "dim_products": "order_items", "dim_stores": "orders"}
#: Grain and clustering of facts.
GRAIN = {
    "fact_sales": ["order_id", "order_line_number"],
    "fact_order_fulfillment": ["order_id"],
    "fact_inventory_snapshot": ["snapshot_date", "product_id", "location_id"],
    "fact_returns": ["return_id"],
    "fact_customer_events": ["event_id"],
    "fact_payment": ["payment_id"],
}
CLUSTER = {"fact_sales": ["date_key", "product_sk"], "fact_order_fulfillment": ["date_key"], "fact_payment": ["date_key"], "fact_returns": ["date_key"]}
#: Facts of which whole days are read and replaced: a folder for each.
PARTITIONED = {"fact_customer_events": ["date_key"], "fact_inventory_snapshot": ["date_key"]}


class Lake:
    """The tables of an environment by layer and name."""

    def __init__(self, spark: SparkSession, env: Environment):
        self.spark, self.env = spark, env

    def table(self, layer: str, name: str, cluster_by: list[str] | None = None, partition_by: list[str] | None = None) -> Table:
        return Table(self.spark, self.env.table_path(layer, name), partition_by=partition_by, cluster_by=cluster_by)

    def silver(self, name: str) -> DataFrame:
        return self.table("silver", name).read()

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name).read()

    def there(self, name: str, layer: str = "silver") -> bool:
        return self.table(layer, name).exists()


def infer_members(lake: Lake) -> dict[str, int]:
    """Placeholders for members that orders and lines name and a dimension lacks, before facts look them up."""
    out = {}
    for _, (dimension, key, _, _) in DIMENSIONS.items():
        source = NAMED_BY.get(dimension)
        if source and lake.there(dimension, "gold") and lake.there(source) and key in lake.silver(source).columns:
            now = lake.gold(dimension)
            placeholders = add_inferred_members(now.limit(0), lake.silver(source).join(now.select(key).distinct(), key, "left_anti"), key, dimension.removeprefix("dim_"))
            table = lake.table("gold", dimension)
            table.append(placeholders)
            if missing := table.history()[-1]["metrics"]["rows"]:
                out[dimension] = missing
    return out


def run_gold(spark: SparkSession, env: Environment, batch_id: str, only: list[str] | None = None) -> dict[str, int]:
    """Inferred members, dates, conformed products, facts and marts (or only those named); each audited."""
    audit, lake = Audit(spark, env), Lake(spark, env)
    silver, gold, there = lake.silver, lake.gold, lake.there
    infer_members(lake)
    dimensions = {k: (gold(v[0]), *v[1:]) for k, v in DIMENSIONS.items() if there(v[0], "gold")}
    of = lambda *names: {k: v for k, v in dimensions.items() if k in names}
    builds = {"dim_date": lambda: dims.dim_date(spark)}
    if there("dim_products", "gold") and there("dim_categories", "gold"):
        builds["dim_products_conformed"] = lambda: dims.conform_products(gold("dim_products"), gold("dim_categories"))
    typed = lambda df, *cs: df.withColumns({c: F.col(c).cast("timestamp") for c in cs if c in df.columns})
    orders = (lambda: typed(silver("orders"), "order_date", "updated_at")) if there("orders") else None
    products = (lambda: silver("products")) if there("products") else (lambda: None)
    maybe = lambda name: silver(name) if there(name) else None
    if orders and there("order_items"):
        builds["fact_sales"] = lambda: facts.fact_sales(silver("order_items"), orders(), dimensions, products())
    if orders and there("shipments"):
        builds["fact_order_fulfillment"] = lambda: facts.fact_order_fulfillment(orders(), typed(silver("shipments"), "shipped_at", "delivered_at"), maybe("payments"), maybe("returns"), of("customer_sk", "store_sk"), maybe("order_items"))
    if there("inventory"):
        # a place is a store
        builds["fact_inventory_snapshot"] = lambda: facts.fact_inventory_snapshot(facts.active(silver("inventory")).withColumn("store_id", F.col("location_id")), of("product_sk", "store_sk"))
    if orders and there("returns"):
        builds["fact_returns"] = lambda: facts.fact_returns(typed(silver("returns"), "return_date"), orders(), of("customer_sk", "product_sk"))
    if there("events"):
        builds["fact_customer_events"] = lambda: facts.fact_customer_events(typed(silver("events"), "event_time"), of("customer_sk", "product_sk"))
    if orders and there("payments"):
        builds["fact_payment"] = lambda: facts.fact_payment(typed(silver("payments"), "paid_at"), orders(), of("customer_sk"))
    if "fact_sales" in builds:
        builds["agg_daily_sales"] = lambda: marts.daily_sales(session_views.sales_star(lake))
        builds["agg_customer_lifetime"] = lambda: marts.customer_lifetime(gold("fact_sales"), maybe("customers"))
        if there("customers"):
            builds["agg_customer_cohort"] = lambda: marts.customer_cohort(gold("fact_sales"), silver("customers"))
        if "fact_returns" in builds:
            builds["agg_product_performance"] = lambda: marts.product_performance(gold("fact_sales"), gold("fact_returns").join(gold("fact_sales").where(~F.col("is_cancelled")).select("order_id").distinct(), "order_id", "left_semi"), maybe("products"))
    if unknown := set(only or ()) - set(builds):
        raise ValueError(f"not to be built: {', '.join(sorted(unknown))}")
    out = {}
    for name, build in builds.items():
        if only and name not in only:
            continue
        with audit.task("gold", name, batch_id) as record:
            frame = build()
            table = lake.table("gold", name, [c for c in CLUSTER.get(name, ()) if c in frame.columns], PARTITIONED.get(name))
            table.overwrite(frame)
            out[name] = record.rows_out = table.metrics()["rows"]
    return out


def run_reconcile(spark: SparkSession, env: Environment) -> list[dict]:
    """All checks that the tables allow; raises if one failed, after all are recorded."""
    lake, entities = Lake(spark, env), load_entities()
    checks = []
    for name, entity in entities.items():
        if lake.there(name):
            key = list(entity.primary_key)
            bronze = tidied(spark, env, entity, lake.table("silver", name).metrics().get("batches"))
            quarantine = read_quarantine(spark, env, entity)
            checks += [reconcile.row_flow(name, bronze, lake.silver(name), bronze.limit(0) if quarantine is None else quarantine, key), reconcile.soft_delete_rate(name, lake.silver(name))]
    checks += [reconcile.grain(name, lake.gold(name), key) for name, key in GRAIN.items() if lake.there(name, "gold")]
    if lake.there("fact_sales", "gold"):
        sales = lake.gold("fact_sales")
        lines = facts.active(lake.silver("order_items")).withColumns({"gross_amount": facts.money(facts.money("unit_price") * F.col("quantity")), "discount_amount": facts.money("discount_amount")})
        checks.append(reconcile.money(lines, facts.active(lake.silver("orders")), sales))
        if totals := control_totals(spark, env.landing_path("control_totals.json")):
            checks.append(reconcile.control_totals(sales, totals, totals.get("planted")))
    results = [r.asDict() for r in reconcile.run_all(checks).collect()] if checks else []
    Audit(spark, env).reconciliation(results)
    if failed := [f"{r['check_name']} of {r['entity']}" for r in results if r["status"] != "PASSED"]:
        raise RuntimeError(f"reconciliation failed: {', '.join(failed)}")
    return results


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=("bronze", "silver", "gold", "reconcile", "optimize", "publish", "all"))
    parser.add_argument("--env", default="local")
    parser.add_argument("--entity")
    parser.add_argument("--system")
    parser.add_argument("--batch-id", default=None)
    parser.add_argument("--sequential", action="store_true")
    parser.add_argument("--only", action="append", help="gold table to build; may come several times")
    args = parser.parse_args(argv)
    env = load_environment(args.env)
    if args.sequential:
        env = env.model_copy(update={"max_parallel": 1})
    entities = {n: e for n, e in load_entities().items() if args.entity in (None, n) and args.system in (None, e.source.system)}
    spark, batch, ok = get_spark(), args.batch_id or uuid.uuid4().hex, True
    if args.stage in ("bronze", "all"):
        print(json.dumps(report := run_bronze(spark, env, entities, batch)))
        ok &= all(r["status"] == "SUCCESS" for r in report.values())
    if args.stage in ("silver", "all"):
        print(json.dumps(report := run_silver(spark, env, entities, batch)))
        ok &= all(r["status"] == "SUCCESS" for r in report.values())
    if args.stage in ("gold", "all"):
        print(json.dumps(run_gold(spark, env, batch, args.only)))
    if args.stage in ("reconcile", "all"):
        print(json.dumps(run_reconcile(spark, env), default=str))
    if args.stage in ("optimize", "all"):
        for name, e in entities.items():
            if silver_table(spark, env, e).exists():
                silver_table(spark, env, e).optimize()
                silver_table(spark, env, e).vacuum()
    if args.stage == "publish":
        lake = Lake(spark, env)
        print(json.dumps(catalog.publish(lake) + (catalog.secure(lake) if table_exists(spark, catalog.ROLES) else [])))
    return 0 if ok else 1


if __name__ == "__main__":
    raise SystemExit(main())
