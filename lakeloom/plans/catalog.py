"""Views in the catalog, which last and which every session sees; what is secret is decided when they are read.

`publish` gives each table of the lake a view on the folders of its current version, to be renewed after a
commit; views on top of it see the new one at once. `secure` adds, for tables with tagged columns, views that
look up the reader's roles in governance.roles at each query: one view shows readers of personal data the
clear values and others the masked ones, without the rows that are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakeloom.plans import governance
from lakeloom.sources.session import LAYERS, ensure_namespaces
from lakeloom.sources.tablestore import Table

ROLES = "governance.roles"
#: Masks as SQL, the same as functions.masks (tests compare them).
MASKS = {
    ("dim_customers", "email"): "CASE WHEN contains({c}, '@') THEN concat(substring(sha2({c}, 256), 1, 12), '@', split_part({c}, '@', 2)) WHEN {c} IS NOT NULL THEN '***' END",
    ("dim_customers", "postal_code"): "concat(substring({c}, 1, 3), '**')",
    ("dim_products", "cost"): "nullif({c}, {c})",
}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _source(table: Table) -> str:
    """The current version's rows as SQL."""
    entry = table.history()[-1]
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    if not entry["folders"]:
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in schema.fields)
        return f"SELECT {nothing} WHERE false"
    folders = ",".join(entry["folders"])
    path = f"{table.path}/{{{folders}}}" if len(entry["folders"]) > 1 else f"{table.path}/{folders}"
    return f"SELECT {', '.join(_quoted(f.name) for f in schema.fields)} FROM parquet.`{path}` WITH (mergeSchema = 'true')"


def publish(lake, names: list[str] | None = None) -> list[str]:
    """Creates or renews the views of the lake's tables (or those named, as layer.name); their names."""
    spark, made = lake.spark, []
    ensure_namespaces(spark, lake.env)
    for layer, name in names and [n.split(".") for n in names] or tables(lake):
        if lake.there(name, layer):
            spark.sql(f"CREATE OR REPLACE VIEW {layer}.{_quoted(name)} AS {_source(lake.table(layer, name))}")
            made.append(f"{layer}.{name}")
    return made


def tables(lake) -> list[tuple[str, str]]:
    """Layer and name of all tables that a folder of the warehouse holds."""
    path = lake.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, out = path(lake.env.warehouse).getFileSystem(lake.spark.sparkContext._jsc.hadoopConfiguration()), []
    for layer in LAYERS:
        where = path(f"{lake.env.warehouse}/{layer}")
        if fs.exists(where):
            out += [(layer, f.getPath().getName()) for f in fs.listStatus(where) if fs.exists(path(f"{f.getPath().toString()}/_manifests"))]
    return out


def set_roles(spark: SparkSession, members: dict[str, list[str]]) -> None:
    """Who has which roles; views follow at their next query."""
    spark.sql("CREATE DATABASE IF NOT EXISTS governance")
    unknown = {r for roles in members.values() for r in roles} - set(governance.CLEAR)
    if unknown:
        raise ValueError(f"no role {', '.join(sorted(unknown))}")
    rows = [(m, r) for m, roles in members.items() for r in roles]
    spark.createDataFrame(rows, "member string, role string").coalesce(1).write.mode("overwrite").saveAsTable(ROLES)


def _may(kind: str) -> str:
    """Whether the reader has a role that sees columns of a class."""
    roles = ", ".join(f"'{r}'" for r, kinds in governance.CLEAR.items() if kind in kinds)
    return f"(SELECT count(*) > 0 FROM {ROLES} WHERE member = current_user() AND role IN ({roles}))"


def secure(lake) -> list[str]:
    """Creates secured.<table> over gold.<table> for the tables with masks; their names."""
    spark, made = lake.spark, []
    spark.sql("CREATE DATABASE IF NOT EXISTS secured")
    for name in dict.fromkeys(t for t, _ in MASKS):
        if not lake.there(name, "gold"):
            continue
        tags = {c: t["data_classification"] for t_, c, t in governance.TAGS if t_ == name}
        columns = lake.gold(name).columns
        shown = [f"CASE WHEN {_may(tags[c])} THEN {_quoted(c)} ELSE {MASKS[name, c].format(c=_quoted(c))} END AS {_quoted(c)}" if (name, c) in MASKS else _quoted(c) for c in columns]
        rows = f" WHERE NOT coalesce(is_deleted, false) OR {_may('P0')}" if "is_deleted" in columns else ""
        spark.sql(f"CREATE OR REPLACE VIEW secured.{name} AS SELECT {', '.join(shown)} FROM gold.{name}{rows}")
        made.append(f"secured.{name}")
    return made
