import os
import tempfile

import pytest

from ledgerflow.config import TRANSACTION_LOG_COLUMN_MAP
from ledgerflow.sources.tabs import UnknownHeaderError, check_headers, clean_cells, read_tab_export


def test_unknown_header_raises():
    with pytest.raises(UnknownHeaderError):
        check_headers(["Timestamp", "Surprise"], TRANSACTION_LOG_COLUMN_MAP, "Transaction Log")
    assert check_headers(["Timestamp", " ", "Remarks "], TRANSACTION_LOG_COLUMN_MAP) == {
        "Timestamp": "timestamp", "Remarks ": "remarks"}


def test_read_csv_export_pads_strips_and_drops_blank_rows(spark):
    d = tempfile.mkdtemp(prefix="ledgerflow-tab-")
    p = os.path.join(d, "log.csv")
    with open(p, "w") as f:
        f.write("Timestamp,Transaction Type,Payment (Rs)\n")
        f.write("2026-06-10 09:00:00, Purchase , 500\n")
        f.write(" , , \n")
        f.write("2026-06-11 10:00:00,Sale\n")
    df = clean_cells(read_tab_export(spark, p, TRANSACTION_LOG_COLUMN_MAP))
    rows = df.collect()
    assert len(df.columns) == 13 and len(rows) == 2
    assert rows[0].transaction_type == "Purchase" and rows[0].payment_rs == "500"
    assert rows[1].payment_rs == "" and rows[1].remarks == ""


def test_json_and_parquet_exports(spark):
    d = tempfile.mkdtemp(prefix="ledgerflow-tab-")
    rows = [{"Timestamp": "2026-06-10 09:00:00", "Transaction Type": "Sale", "Customer Name": " C1 "}]
    spark.createDataFrame(rows).write.json(os.path.join(d, "log.json"))
    spark.createDataFrame(rows).write.parquet(os.path.join(d, "log.parquet"))
    for fmt in ("json", "parquet"):
        df = clean_cells(read_tab_export(spark, os.path.join(d, f"log.{fmt}"), TRANSACTION_LOG_COLUMN_MAP, fmt))
        (r,) = df.collect()
        assert r.customer_name == "C1" and r.vendor_name == "" and len(df.columns) == 13


def test_quoted_cells_line_breaks_and_blank_headers(spark, tmp_path):
    header = ",".join(list(TRANSACTION_LOG_COLUMN_MAP)[:3]) + ",,"
    (tmp_path / "log.csv").write_text(header + '\n"a ""quoted"", cell","two\nlines",c,ignored\n1,2,3,,\n')
    rows = read_tab_export(spark, str(tmp_path / "log.csv"), TRANSACTION_LOG_COLUMN_MAP).collect()
    targets = [TRANSACTION_LOG_COLUMN_MAP[h] for h in list(TRANSACTION_LOG_COLUMN_MAP)[:3]]
    assert [tuple(r[t] for t in targets) for r in rows] == [('a "quoted", cell', "two\nlines", "c"), ("1", "2", "3")]


def test_times_do_not_depend_on_the_session_zone(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from ledgerflow.functions.expr import parse_timestamp
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:  # 02:30 does not exist there on that day
        df = spark.createDataFrame([("2001-04-01 02:30:00",), ("bad",), (None,)], "t string").select(parse_timestamp(F.col("t")).alias("t"))
        assert [r.t for r in df.collect()] == [dt.datetime(2001, 4, 1, 2, 30), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_shared_keys_keep_one_rate_per_product(spark):
    import datetime as dt
    import decimal

    from ledgerflow.plans.analytics import key_rates
    rows = [("k", "Lahsun", decimal.Decimal(5), dt.date(2020, 1, 1)), ("k", "Lahsun", decimal.Decimal(7), dt.date(2021, 1, 1))]
    out = key_rates(spark.createDataFrame(rows, "transaction_key string, product_name string, applicable_rate decimal(10,2), effective_from date")).collect()
    assert len(out) == 1 and out[0]["__lahsun_rate_rs"].applicable_rate == 7
