"""The trading tabs use every line, supplier and customer of the driver tables."""

from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_quantities_and_counterparties_are_whole(spark):
    log = fixtures.raw_transaction_log(spark, SF, with_row_number=True).cache()
    lines = fixtures.read_table(spark, SF, "lineitem")
    orders = fixtures.read_table(spark, SF, "orders")
    cells = sum((F.coalesce(F.expr(f"try_cast(nullif({c}, '') as decimal(18,3))"), F.lit(0)) for c in config.QTY_COLUMNS), F.lit(0))
    typed = lines.join(fixtures.read_table(spark, SF, "part"), F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert log.agg(F.sum(cells)).first()[0] == typed.agg(F.sum(F.col("l_quantity").cast("decimal(18,3)"))).first()[0]
    sold = orders.where("o_orderkey % 2 = 1").select("o_custkey").distinct().count()
    assert log.where("customer_name <> ''").select("customer_name").distinct().count() == sold
    bought = typed.where("o_orderkey % 2 = 0").select("l_orderkey", "l_suppkey").distinct().count()
    assert log.where("vendor_name <> ''").count() == bought
    assert dict(log.dtypes)["source_row_number"] == "bigint"
