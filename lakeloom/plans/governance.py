"""Tags, comments, secured views, and files of SQL statements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import masks

# Classes of columns, and which role may read which class in the clear.
CLASSES = {"P0": "direct identifier", "P1": "indirect identifier", "P2": "commercial", "P3": "open"}
CLEAR = {"pii_reader": ("P0", "P1", "P3"), "finance": ("P2", "P3"), "engineer": ("P2", "P3"), "analyst": ("P3",)}
GRANTS = {"engineer": ("bronze", "silver", "gold", "audit"), "analyst": ("gold",), "finance": ("gold",), "pii_reader": ("gold",)}
TAGS = [
    ("dim_customers", "email", {"data_classification": "P0", "pii_type": "email", "masked": "true"}),
    ("dim_customers", "postal_code", {"data_classification": "P1", "pii_type": "location", "masked": "true"}),
    ("dim_customers", "city", {"data_classification": "P1", "pii_type": "location"}),
    ("dim_customers", "customer_id", {"data_classification": "P1", "pii_type": "pseudonymous_key"}),
    ("dim_products", "cost", {"data_classification": "P2", "masked": "true"}),
    ("dim_products", "supplier", {"data_classification": "P2"}),
]
MASKS = {("dim_customers", "email"): masks.mask_email, ("dim_customers", "postal_code"): masks.mask_postal, ("dim_products", "cost"): masks.mask_cost}


def tag_table(spark: SparkSession) -> DataFrame:
    rows = [(t, c, k, v) for t, c, tags in TAGS for k, v in tags.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, tag_name string, tag_value string")


def secured(df: DataFrame, table: str, roles: tuple[str, ...]) -> DataFrame:
    """What readers with the given roles see: masked columns, and no soft-deleted rows for those without personal data."""
    classes = {k for r in roles for k in CLEAR.get(r, ())}
    tags = {c: t["data_classification"] for t_, c, t in TAGS if t_ == table}
    out = df.withColumns({c: f(F.col(c), tags[c] in classes) for (t, c), f in MASKS.items() if t == table and c in df.columns})
    if "is_deleted" in df.columns and "P0" not in classes:
        out = out.where(~F.col("is_deleted"))
    return out


def split_statements(text: str) -> list[str]:
    """Statements between semicolons that stand outside of quotes and comments; comments go."""
    out, now, i, quote = [], [], 0, ""
    while i < len(text):
        c, two = text[i], text[i : i + 2]
        if quote:
            now.append(c)
            if c == quote:
                quote = ""
        elif two == "--":
            i = text.find("\n", i)
            if i < 0:
                break
            now.append("\n")
        elif two == "/*":
            end = text.find("*/", i + 2)
            i = len(text) if end < 0 else end + 1
        elif c in "'\"`":
            quote = c
            now.append(c)
        elif c == ";":
            out.append("".join(now).strip())
            now = []
        else:
            now.append(c)
        i += 1
    out.append("".join(now).strip())
    return [s for s in out if s]


@dataclass
class Failure:
    statement: str
    error: str


def apply_statements(spark: SparkSession, text: str, variables: dict[str, str] | None = None) -> list[Failure]:
    """Runs all statements; those that fail are returned, the others take effect."""
    failures = []
    for name, value in (variables or {}).items():
        text = text.replace("${" + name + "}", value)
    for s in split_statements(text):
        try:
            spark.sql(s)
        except Exception as e:
            failures.append(Failure(s, str(e).split("\n")[0]))
    return failures
