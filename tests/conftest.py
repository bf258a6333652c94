import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="ledgerflow-tests")
    yield s
    s.stop()


LOG_COLUMNS = ["timestamp", "transaction_date", "transaction_type", "vendor_name", "customer_name", "payment_rs",
               "payment_mode", "mushroom_bulk_qty_kg", "mushroom_pannet_qty_kg", "mushroom_b_grade_qty_kg",
               "baby_corn_qty_kg", "lahsun_qty_kg", "remarks"]
RATE_COLUMNS = ["effective_from", "NAME", "mushroom_bulk_rate_rs", "mushroom_pannet_rate_rs",
                "mushroom_b_grade_rate_rs", "baby_corn_rate_rs", "lahsun_rate_rs", "remarks"]


def log_row(ts, ttype, vendor="", customer="", payment="", mode="", qty=("", "", "", "", ""), date="", remarks=""):
    return (ts, date, ttype, vendor, customer, payment, mode, *qty, remarks)


def tabs_from(spark, log_rows, vendor_rates=(), customer_rates=()):
    schema = ", ".join(f"{c} string" for c in LOG_COLUMNS)
    vr = ", ".join(f"{c.replace('NAME', 'vendor_name')} string" for c in RATE_COLUMNS)
    cr = ", ".join(f"{c.replace('NAME', 'customer_name')} string" for c in RATE_COLUMNS)
    return {
        "transaction_log": spark.createDataFrame(list(log_rows), schema),
        "vendor_rates": spark.createDataFrame(list(vendor_rates), vr),
        "customer_rates": spark.createDataFrame(list(customer_rates), cr),
    }
