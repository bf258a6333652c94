"""Fixed values of the trading domain and the sheet contract.

Everything in this module is a value that must stay equal to the source
system's contract for results to match (product names, column maps, status
labels).  Generic operators never import it; only the trading plans do.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: product catalogue, in sheet order -------------------------
# (display name, quantity column in the log, rate column in the rate tabs)
PRODUCTS: tuple[tuple[str, str, str], ...] = (
    ("Mushroom Bulk", "mushroom_bulk_qty_kg", "mushroom_bulk_rate_rs"),
    ("Mushroom Pannet", "mushroom_pannet_qty_kg", "mushroom_pannet_rate_rs"),
    ("Mushroom B Grade", "mushroom_b_grade_qty_kg", "mushroom_b_grade_rate_rs"),
    ("Baby Corn", "baby_corn_qty_kg", "baby_corn_rate_rs"),
    ("Lahsun", "lahsun_qty_kg", "lahsun_rate_rs"),
)
PRODUCT_NAMES = tuple(p[0] for p in PRODUCTS)
QTY_COLUMNS = tuple(p[1] for p in PRODUCTS)
RATE_COLUMNS = tuple(p[2] for p in PRODUCTS)

# --- fixed values: sheet header -> column name maps ---------------------------
TRANSACTION_LOG_COLUMN_MAP: dict[str, str] = {
    "Timestamp": "timestamp",
    "Transaction Date (if not same as today)": "transaction_date",
    "Transaction Type": "transaction_type",
    "Vendor Name": "vendor_name",
    "Customer Name": "customer_name",
    "Payment (Rs)": "payment_rs",
    "Payment Mode": "payment_mode",
    "Mushroom Bulk Qty (kg)": "mushroom_bulk_qty_kg",
    "Mushroom Pannet Qty (kg)": "mushroom_pannet_qty_kg",
    "Mushroom B Grade Qty (kg)": "mushroom_b_grade_qty_kg",
    "Baby Corn Qty (kg)": "baby_corn_qty_kg",
    "Lahsun Qty (kg)": "lahsun_qty_kg",
    "Remarks": "remarks",
}
VENDOR_RATES_COLUMN_MAP: dict[str, str] = {
    "Effective From Date": "effective_from",
    "Vendor Name": "vendor_name",
    "Mushroom Bulk Rate (Rs)": "mushroom_bulk_rate_rs",
    "Mushroom Pannet Rate (Rs)": "mushroom_pannet_rate_rs",
    "Mushroom B Grade Rate (Rs)": "mushroom_b_grade_rate_rs",
    "Baby Corn Rate (Rs)": "baby_corn_rate_rs",
    "Lahsun Rate (Rs)": "lahsun_rate_rs",
    "Remarks": "remarks",
}
CUSTOMER_RATES_COLUMN_MAP: dict[str, str] = {
    "Effective From Date": "effective_from",
    "Customer Name": "customer_name",
    "Mushroom Bulk Rate (Rs)": "mushroom_bulk_rate_rs",
    "Mushroom Pannet Rate (Rs)": "mushroom_pannet_rate_rs",
    "Mushroom B Grade Rate (Rs)": "mushroom_b_grade_rate_rs",
    "Baby Corn Rate (Rs)": "baby_corn_rate_rs",
    "Lahsun Rate (Rs)": "lahsun_rate_rs",
    "Remarks": "remarks",
}
TAB_COLUMN_MAPS = {
    "transaction_log": TRANSACTION_LOG_COLUMN_MAP,
    "vendor_rates": VENDOR_RATES_COLUMN_MAP,
    "customer_rates": CUSTOMER_RATES_COLUMN_MAP,
}

# --- fixed values: parse formats (first match wins) ---------------------------
TIMESTAMP_FORMATS = ("y-M-d H:m:s", "M/d/y H:m:s", "d/M/y H:m:s")
DATE_FORMATS = ("y-M-d", "M/d/y", "d/M/y")

# --- fixed values: labels -------------------------------------------------------
PURCHASE = "Purchase"
SALE = "Sale"
MATCHED = "matched"
MISSING_RATE = "missing_rate"
MISSING_COUNTERPARTY = "missing_counterparty"
VENDOR_PAYMENT = "vendor_payment"
CUSTOMER_COLLECTION = "customer_collection"
PAYMENT_MODES = ("Cash", "Online")
FISCAL_YEAR_START_MONTH = 4

# Fixture run date (the business "today" used by date resolution).
RUN_DATE = _dt.date(2001, 7, 1)
