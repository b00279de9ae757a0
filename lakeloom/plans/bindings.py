"""The driver's tables as the engine's entities: lines, orders, customers, products, places, events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.dedup import deduplicate
from lakeloom.plans import dims, facts, views

#: Lines come twice with one key; the latest shipment wins, then the larger amount, then every other column.
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


class Tables:
    """Frames over the Parquet files of one directory; each reads only the columns it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def latest_lines(self) -> DataFrame:
        return deduplicate(self.raw("lineitem"), LINE_KEY, order=[F.col(c).desc_nulls_last() for c in LINE_ORDER])

    def lines(self) -> DataFrame:
        gross = facts.money("l_extendedprice")
        return self.latest_lines().select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("location_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            facts.money(F.floor(F.round(F.col("l_extendedprice") * 100) / F.col("l_quantity")) / 100).alias("unit_price"),
            gross.alias("gross_amount"),
            facts.money(gross * F.col("l_discount").cast("decimal(4,2)")).alias("discount_amount"),
            facts.money(gross * F.col("l_tax").cast("decimal(4,2)")).alias("tax_amount"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_shipdate").alias("shipped_at"),
        )

    def orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "P", "CANCELLED").when(F.col("o_orderstatus") == "F", "DELIVERED").otherwise("PLACED")
        o = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date"), status.alias("order_status"), facts.money("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority")
        )
        k = F.col("order_id")
        o = o.withColumns(
            {
                "store_id": k % 10 + 1,
                "promotion_id": F.when(k % 3 == 0, F.concat(F.lit("P"), (k % 5).cast("string"))),
                "payment_status": F.when(k % 7 == 0, "RETRIED").otherwise("CAPTURED"),
            }
        )
        return o.join(self.customers().select("customer_id", "region", "customer_segment"), "customer_id", "left")

    def dates(self) -> DataFrame:
        return dims.dim_date(self.spark, dt.date(1992, 1, 1), dt.date(2024, 12, 31))

    def promotions(self) -> DataFrame:
        """Five campaigns; every third order names one."""
        i = F.col("id").cast("string")
        return self.spark.range(5).select(F.concat(F.lit("P"), i).alias("promotion_id"), F.concat(F.lit("Campaign "), i).alias("promotion_name"), F.when(F.col("id") % 2 == 0, "PERCENT").otherwise("FIXED").alias("promo_type"), facts.money(F.col("id") * 5).alias("discount_value"))

    def customers(self) -> DataFrame:
        c, n, r = self.raw("customer"), self.raw("nation"), self.raw("region")
        # nations and regions are fixed lists
        c = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
            F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("postal_code"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            facts.money("c_acctbal").alias("balance"),
        )

    def signups(self) -> DataFrame:
        """A customer's signup is the day of the first order."""
        return self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").cast("date").alias("signup_date"))

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category_id"), F.col("p_type").alias("category_name"), F.col("p_size").alias("size"), facts.money("p_retailprice").alias("price")
        )

    def places(self) -> DataFrame:
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        s = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
        return s.select(F.col("s_suppkey").alias("location_id"), F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("r_name").alias("region"))

    def sales(self) -> DataFrame:
        """fact_sales with the product's category."""
        return facts.fact_sales(self.lines(), self.orders(), products=self.products(), rows=self.raw("lineitem").count())

    def star(self) -> DataFrame:
        return views.star(self.sales(), self.dates(), self.customers(), self.products(), self.places(), self.promotions())

    def stock(self) -> DataFrame:
        return views.stocked(facts.fact_inventory_snapshot(self.inventory()), self.dates(), self.products(), self.places())

    def returns(self) -> DataFrame:
        """Returned lines, a fortnight after shipment, with the order's date."""
        back = self.lines().where("return_flag = 'R'")
        back = back.select("order_id", "order_line_number", "product_id", "quantity", F.element_at(F.array(F.lit("DAMAGED"), F.lit("WRONG ITEM"), F.lit("CHANGED MIND")), (F.col("order_line_number") % 3 + 1).cast("int")).alias("return_reason"), F.col("gross_amount").alias("refund_amount"), (F.col("shipped_at") + F.expr("interval 14 days")).alias("return_date"))
        return back

    def shipments(self) -> DataFrame:
        """A line's shipment, delivered as many days later as its number."""
        return self.lines().select("order_id", "shipped_at", F.timestamp_add("DAY", F.col("order_line_number"), F.col("shipped_at")).alias("delivered_at"))

    def payments(self) -> DataFrame:
        """An attempt a day after the order; every seventh order's first one fails and is repeated a day later."""
        o = self.orders().select("order_id", "order_date", "total")
        fails = F.col("order_id") % 7 == 0
        first = o.select(F.concat(F.col("order_id").cast("string"), F.lit("-1")).alias("payment_id"), "order_id", F.lit(1).alias("attempt_number"), F.when(fails, "FAILED").otherwise("CAPTURED").alias("payment_status"), F.col("total").alias("payment_amount"), (F.col("order_date") + F.expr("interval 1 day")).alias("paid_at"))
        again = o.where(fails).select(F.concat(F.col("order_id").cast("string"), F.lit("-2")).alias("payment_id"), "order_id", F.lit(2).alias("attempt_number"), F.lit("CAPTURED").alias("payment_status"), F.col("total").alias("payment_amount"), (F.col("order_date") + F.expr("interval 2 days")).alias("paid_at"))
        return first.unionByName(again)

    def inventory(self) -> DataFrame:
        """A product's stock at the place of a shipment that day: on hand 50 less what went out, a tenth reserved."""
        went = self.lines().groupBy(F.col("shipped_at").cast("date").alias("snapshot_date"), "product_id", "location_id").agg(F.sum("quantity").cast("bigint").alias("went"))
        on_hand = F.greatest(F.lit(0).cast("bigint"), 50 - F.col("went"))
        df = went.select("snapshot_date", "product_id", "location_id", on_hand.alias("quantity_on_hand"), F.floor(on_hand / 10).cast("bigint").alias("quantity_reserved"), F.lit(10).cast("bigint").alias("reorder_point"))
        return df.withColumn("quantity_available", F.col("quantity_on_hand") - F.col("quantity_reserved"))

    def events(self) -> DataFrame:
        """A session is a user's day."""
        return self.raw("events").select(
            "event_id", "event_type", F.col("ts").alias("event_time"), F.col("user_id").alias("customer_id"), F.when(F.col("event_id") % 2 == 0, "web").otherwise("app").alias("channel"), "value", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"), F.get_json_object("props", "$.k").cast("bigint").alias("k")
        )

    def runs(self) -> DataFrame:
        """Run records made of events: a stage for each type, an entity for each user modulo 12."""
        e = self.raw("events")
        return e.select(
            F.col("event_type").alias("stage"),
            F.concat(F.lit("entity_"), (F.col("user_id") % 12).cast("string")).alias("entity"),
            F.when(F.col("event_id") % 10 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
            (F.col("event_id") % 100).alias("duration_s"),
            (F.col("event_id") % 1000 + 5).alias("rows_in"),
            (F.col("event_id") % 1000).alias("rows_out"),
            (F.col("event_id") % 5).alias("rows_quarantined"),
            F.col("ts").alias("started_at"),
            F.col("ts").alias("ended_at"),
        )

    def results(self) -> DataFrame:
        """Quality results made of events."""
        e = self.raw("events")
        return e.select(
            F.concat(F.lit("entity_"), (F.col("user_id") % 12).cast("string")).alias("entity"),
            F.when(F.col("event_id") % 3 == 0, "fatal").when(F.col("event_id") % 3 == 1, "error").otherwise("warn").alias("severity"),
            F.when(F.col("event_id") % 20 == 0, "FAILED").when(F.col("event_id") % 50 == 1, "SKIPPED").otherwise("PASSED").alias("status"),
            F.when(F.col("event_id") % 20 == 0, F.col("event_id") % 7 + 1).otherwise(0).cast("bigint").alias("violations"),
            F.col("event_type").alias("rule"),
            F.lit("range").alias("type"),
            ((F.col("event_id") % 4) / 4).alias("pass_rate"),
            F.col("ts").alias("checked_at"),
        )

    def checks(self) -> DataFrame:
        """Reconciliation results made of events."""
        e, k = self.raw("events"), F.col("event_id")
        return e.select(
            F.col("event_type").alias("check_name"),
            F.concat(F.lit("entity_"), (F.col("user_id") % 12).cast("string")).alias("entity"),
            F.lit("silver").alias("source_layer"),
            F.lit("gold").alias("target_layer"),
            facts.money(k).alias("source_value"),
            facts.money(k - k % 30).alias("target_value"),
            facts.money(k % 30).alias("difference"),
            facts.money(F.lit(20)).alias("tolerance"),
            F.when(k % 30 > 20, "FAILED").otherwise("PASSED").alias("status"),
            F.col("ts").alias("checked_at"),
        )

    def order_changes(self) -> DataFrame:
        """Change events: each order is inserted; some are updated, deleted, or get a stale update and a tombstone."""
        o = self.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
        k = F.col("o_orderkey")
        kinds = F.array_compact(
            F.array(
                F.struct(F.lit("c").alias("op"), (k * 10).alias("lsn"), F.lit("new").alias("how")),
                F.when(k % 3 == 0, F.struct(F.lit("u").alias("op"), (k * 10 + 5).alias("lsn"), F.lit("update").alias("how"))),
                F.when(k % 4 == 0, F.struct(F.lit("u").alias("op"), (k * 10 - 1).alias("lsn"), F.lit("stale").alias("how"))),
                F.when(k % 10 == 0, F.struct(F.lit("d").alias("op"), (k * 10 + 7).alias("lsn"), F.lit("delete").alias("how"))),
                F.when(k % 10 == 0, F.struct(F.lit("d").alias("op"), (k * 10 + 7).alias("lsn"), F.lit("tombstone").alias("how"))),
            )
        )
        e = o.select("*", F.inline(kinds))
        status = F.when(F.col("how") == "update", "X").when(F.col("how") == "stale", "S").otherwise(F.col("o_orderstatus"))
        price = F.when(F.col("how") == "update", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
        new = F.struct(k.alias("order_id"), status.alias("status"), price.alias("total"))
        old = F.struct(k.alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
        return e.select(
            "op",
            F.col("lsn").alias("ts_ms"),
            F.when(F.col("how").isin("update", "stale", "delete"), old).alias("before"),
            F.when(F.col("how").isin("new", "update", "stale"), new).alias("after"),
            F.struct("lsn", F.lit("false").alias("snapshot")).alias("source"),
        )

    def customer_history(self) -> DataFrame:
        """Changes of customers: the first state, a move a year on for every third, a return two years on for every ninth."""
        c = self.customers().select("customer_id", "customer_segment", "region")
        day = lambda s: F.lit(s).cast("timestamp_ntz")
        k = F.col("customer_id")
        steps = F.array_compact(
            F.array(
                F.struct(day("1996-01-01").alias("changed_at"), F.col("region").alias("region_now")),
                F.struct(day("1996-06-01").alias("changed_at"), F.col("region").alias("region_now")),
                F.when(k % 3 == 0, F.struct(day("1997-01-01").alias("changed_at"), F.lit("MOVED").alias("region_now"))),
                F.when(k % 9 == 0, F.struct(day("1998-01-01").alias("changed_at"), F.col("region").alias("region_now"))),
            )
        )
        return c.select("customer_id", "customer_segment", F.inline(steps)).select("customer_id", "customer_segment", F.col("region_now").alias("region"), "changed_at")
