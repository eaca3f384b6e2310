"""The ``shipments`` table: a flight-shaped stand-in built from lineitem and orders.

``delay`` (days from order to shipment) plays the role of the departure delay; the
numeric and categorical columns play the flight features. The stored tables have no
NULLs, so four columns get NULLs injected by integer rules that every SQL engine
evaluates alike (one per tier of the null policies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET = "delay"
KEYS = ["l_orderkey", "l_linenumber"]
NUMERIC_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
CATEGORICAL = ["l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus"]
CALENDAR = ["order_year", "order_month"]

# NULL-injection rules (multiplier, share in percent) per column.
# A value is NULL when (l_orderkey * multiplier + l_linenumber) % 100 < share.
NULL_RULES = {
    "l_quantity": (7, 3),
    "l_tax": (11, 25),
    "l_discount": (13, 70),
    "l_returnflag": (17, 2),
}

COLUMNS = KEYS + [TARGET] + NUMERIC_FEATURES + CATEGORICAL + CALENDAR


def _nullable(name: str, inject: bool):
    c = F.col(name)
    if not inject or name not in NULL_RULES:
        return c.alias(name)
    mult, share = NULL_RULES[name]
    rule = (F.col("l_orderkey") * F.lit(mult) + F.col("l_linenumber")) % F.lit(100) < F.lit(share)
    return F.when(rule, F.lit(None)).otherwise(c).alias(name)


def shipments(spark: SparkSession, sf_dir: str, inject_nulls: bool = True) -> DataFrame:
    """lineitem JOIN orders with the derived delay and calendar columns.

    The join is an equi-join on the order key: at scale a sort-merge join whose
    partitions AQE may split when a key is hot. Only the columns used are read.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
        .cast("double")
        .alias(TARGET),
        *[_nullable(c, inject_nulls) for c in NUMERIC_FEATURES],
        *[_nullable(c, inject_nulls) for c in CATEGORICAL],
        F.year("o_orderdate").cast("int").alias("order_year"),
        F.month("o_orderdate").cast("int").alias("order_month"),
    ).select(*COLUMNS)


def _sql_nullable(name: str, alias: str = "") -> str:
    ref = f"{alias}{name}"
    if name not in NULL_RULES:
        return f"{ref} AS {name}"
    mult, share = NULL_RULES[name]
    return (
        f"CASE WHEN (l.l_orderkey * {mult} + l.l_linenumber) % 100 < {share} "
        f"THEN NULL ELSE {ref} END AS {name}"
    )


def shipments_sql() -> str:
    """The same table as a SQL SELECT over ``lineitem`` and ``orders``."""
    def src(c: str) -> str:
        return "l." if c.startswith("l_") else "o."

    nums = ",\n  ".join(_sql_nullable(c, src(c)) for c in NUMERIC_FEATURES)
    cats = ",\n  ".join(_sql_nullable(c, src(c)) for c in CATEGORICAL)
    return f"""SELECT
  l.l_orderkey AS l_orderkey,
  l.l_linenumber AS l_linenumber,
  CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS DOUBLE) AS delay,
  {nums},
  {cats},
  CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
  CAST(month(o.o_orderdate) AS INTEGER) AS order_month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
