"""Driver tables -> the three all-string trading tabs.

The driver ships TPC-H-like parquet tables; this module renders them into
the shapes of the sheet tabs (``transaction_log``, ``vendor_rates``,
``customer_rates``) so that every trading plan runs on data whose size grows
with the driver's scale factor.  The mapping is documented in FIXTURES.md.

Every line, every supplier and every customer of the driver tables is used.

Plan shape: the lines of ``lineitem ⋈ part`` are dealt once, by order, then
added up per form and joined to ``orders`` where they lie (a form has few lines,
so sums before the shuffle would not make it smaller, only wider).
The part lookup is a plain equi-join; AQE turns it into a broadcast only
when the runtime size of ``part`` is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config

# --- fixed values: driver p_type values of each product slot ------------------
SLOT_TYPES = (("MEDIUM",), ("STANDARD",), ("LARGE",), ("PROMO",), ("SMALL", "ECONOMY"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    """Render as a sheet cell: text, NULL as ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _lines_with_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey, "left")


def _slot() -> Column:
    """Number of the line's product slot; NULL if its type has none."""
    out = F.when(F.col("p_type").isin(*SLOT_TYPES[0]), F.lit(1))
    for i, types in enumerate(SLOT_TYPES[1:], 2):
        out = out.when(F.col("p_type").isin(*types), F.lit(i))
    return out


def raw_transaction_log(spark: SparkSession, sf_dir: str, with_row_number: bool = False) -> DataFrame:
    """All-string log rows: a form per (order, supplier) for purchases, per order for sales (FIXTURES.md B, 'Log row').

    ``with_row_number`` adds ``source_row_number`` (header is row 1; rows follow
    the order key, and the forms of one order, which differ in vendor, share it).
    """
    lines = _lines_with_type(spark, sf_dir)
    q = F.col("l_quantity").cast(DecimalType(10, 3))
    dealt = lines.select("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, F.col("l_suppkey")).alias("supp"), F.col("l_extendedprice").cast(DecimalType(12, 2)).alias("price"),
                         q.alias("qty"), _slot().alias("slot")).repartition("l_orderkey")
    per_form = dealt.groupBy("l_orderkey", "supp").agg(
        F.sum("price").alias("form_price"), *[F.sum(F.when(F.col("slot") == i, F.col("qty"))).alias(f"q{i}") for i in range(1, len(SLOT_TYPES) + 1)])
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = orders.join(per_form, orders.o_orderkey == per_form.l_orderkey, "left")
    k = F.col("o_orderkey")
    even = k % 2 == 0
    out = o.select(
        F.when(k % 10 == 8, F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.when(k % 7 == 0, F.date_format(F.date_sub(F.col("o_orderdate").cast("date"), 7), "yyyy-MM-dd"))
        .otherwise(F.lit("")).alias("transaction_date"),
        F.when(k % 20 == 0, F.lit(" purchases ")).when(even, F.lit("Purchase")).otherwise(F.lit("Sale"))
        .alias("transaction_type"),
        F.when(even, _s(F.concat(F.lit("V"), F.col("supp").cast("string")))).otherwise(F.lit(""))
        .alias("vendor_name"),
        F.when(~even, F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).otherwise(F.lit(""))
        .alias("customer_name"),
        F.when(k % 3 == 0, F.lit("")).when(k % 50 == 1, F.lit("n/a")).when(k % 101 == 5, F.lit("-25.00"))
        .otherwise(F.coalesce(F.when(even, F.col("form_price")), F.col("o_totalprice")).cast(DecimalType(12, 2)).cast("string")).alias("payment_rs"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Cash"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Online")).otherwise(F.lit("")).alias("payment_mode"),
        *[_s(F.col(f"q{i}")).alias(c) for i, c in enumerate(config.QTY_COLUMNS, 1)],
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("remarks"),
        *([(k + 2).cast("bigint").alias("source_row_number")] if with_row_number else []),
    )
    return out


def _rates(lines: DataFrame, name_col: str, letter: str, key: str) -> DataFrame:
    """Grouped by quarter and key as they are; only the few rates are rendered as text."""
    price = F.col("p_retailprice").cast(DecimalType(10, 2))
    agg = lines.groupBy(F.date_trunc("quarter", "l_shipdate").alias("quarter"), F.col(key).alias("key")).agg(
        *[F.max(F.when(F.col("p_type").isin(*t), price)).alias(f"r{i}") for i, t in enumerate(SLOT_TYPES, 1)])
    return agg.select(
        F.date_format("quarter", "yyyy-MM-dd").alias("effective_from"), F.concat(F.lit(letter), F.col("key").cast("string")).alias(name_col),
        *[_s(F.col(f"r{i}")).alias(c) for i, c in enumerate(config.RATE_COLUMNS, 1)],
        F.lit("").alias("remarks"),
    )


def raw_vendor_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (supplier, quarter of ship date); cell = max retail price of the slot."""
    lines = _lines_with_type(spark, sf_dir)
    return _rates(lines, "vendor_name", "V", "l_suppkey")


def raw_customer_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, quarter of ship date), customers reached through orders."""
    lines = _lines_with_type(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lo = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
    return _rates(lo, "customer_name", "C", "o_custkey")


def raw_tabs(spark: SparkSession, sf_dir: str, with_row_number: bool = False) -> dict[str, DataFrame]:
    return {
        "transaction_log": raw_transaction_log(spark, sf_dir, with_row_number),
        "vendor_rates": raw_vendor_rates(spark, sf_dir),
        "customer_rates": raw_customer_rates(spark, sf_dir),
    }
