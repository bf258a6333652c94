"""Lines valued by name even where the log and the rate tabs spell a counterparty differently.

A name's normal form is its text in lower case with single blanks.  Where the rate tabs
spell one normal form in several ways, the spelling with the most rate rows is canonical
(then the newest row, then the alphabet).  A line takes the rate in force under its own
spelling; only if there is none, the one in force under its normal form, where the newest
row of any spelling wins and the canonical spelling decides between rows of one day.  The
second look-up is made for the lines that the first left unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config
from ledgerflow.operators.asof import asof_join
from ledgerflow.plans import analytics
from ledgerflow.plans.warehouse import Warehouse


def normal_form(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(name), r"\s+", " "))


def canonical_names(rates: DataFrame) -> DataFrame:
    """(side, normal_name, canonical_name, spellings)."""
    spelled = rates.groupBy("side", normal_form(F.col("counterparty")).alias("normal_name"), "counterparty").agg(F.count("*").alias("n"), F.max("effective_from").alias("newest"))
    order = Window.partitionBy("side", "normal_name").orderBy(F.desc("n"), F.desc("newest"), "counterparty")
    first = spelled.withColumn("place", F.row_number().over(order))
    return first.groupBy("side", "normal_name").agg(F.max(F.when(F.col("place") == 1, F.col("counterparty"))).alias("canonical_name"), F.count("*").alias("spellings"))


def rated_by_name(wh: Warehouse) -> DataFrame:
    """Lines with rate, value, three-way status, the name whose rates were used, and whether it differs from the line's."""
    stage = wh._stage
    rates = wh.rates
    names = stage("canonical_names", lambda: canonical_names(rates))
    cells = ["effective_from", *config.RATE_COLUMNS]
    exact = rates.select("side", "counterparty", *cells, F.col("counterparty").alias("rate_name"))
    with wh._passing("rated_exactly") as passing:
        first = stage("rated_exactly", lambda: asof_join(wh.lines, exact, ["counterparty", "side"], "transaction_date", "effective_from", tiebreak=list(config.RATE_COLUMNS), stage=passing))
    matched, open_lines = first.where("effective_from IS NOT NULL"), first.where("effective_from IS NULL").select(*wh.lines.columns)
    grouped = rates.withColumn("normal_name", normal_form(F.col("counterparty"))).join(names, ["side", "normal_name"]).select(
        "side", "normal_name", *cells, F.col("counterparty").alias("rate_name"), (F.col("counterparty") == F.col("canonical_name")).alias("is_canonical"))
    asked = open_lines.withColumn("normal_name", normal_form(F.col("counterparty")))
    again = lambda passing: asof_join(asked, grouped, ["normal_name", "side"], "transaction_date", "effective_from",
                                      tiebreak=["is_canonical", "rate_name", *config.RATE_COLUMNS], stage=passing).drop("normal_name", "is_canonical")
    with wh._passing("rated_by_name") as passing:
        second = again(None) if passing is None else stage("rated_by_name", lambda: again(passing))
    rated = matched.unionByName(second).withColumn("rate_rs", analytics.pick_by_name("product_name", analytics.RATE_BY_PRODUCT))
    known = names.select("side", "normal_name", "canonical_name")
    j = rated.withColumn("normal_name", normal_form(F.col("counterparty"))).join(known, ["side", "normal_name"], "left")
    status = (F.when(F.col("rate_rs").isNotNull(), F.lit(config.MATCHED)).when(F.col("canonical_name").isNotNull(), F.lit(config.MISSING_RATE))
              .otherwise(F.lit(config.MISSING_COUNTERPARTY)))
    return j.select("source_row_id", "transaction_date", "transaction_type", "counterparty", "product_name", "quantity_kg", "rate_rs",
                    F.round(F.col("quantity_kg") * F.col("rate_rs"), 2).cast(DecimalType(18, 2)).alias("line_value_rs"), status.alias("rate_lookup_status"),
                    "rate_name", F.coalesce(F.col("rate_name") != F.col("counterparty"), F.lit(False)).alias("name_mismatch"))
