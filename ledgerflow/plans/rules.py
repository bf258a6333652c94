"""Rule-driven data quality: violations, quarantine, validation summary, KPI alerts.

A rule is (rule_id, severity, predicate).  All row-level rules of a tab are
evaluated in one pass: each row gets an array of the rules it breaks
(``array_compact`` of ``when(pred, struct(rule, severity))``), which is then
exploded into violations or filtered into the quarantine - no shuffle.
Rules that need other rows (duplicate keys, duplicate submissions) are
separate partial-aggregated or bucketed-window passes unioned in.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.functions.expr import blank_to_null, naive_ts, parse_date, to_decimal
from ledgerflow.operators.cdc import fingerprint
from ledgerflow.operators.dedup import near_duplicates
from ledgerflow.plans import analytics, staging
from ledgerflow.plans.warehouse import CUSTOMER_SALE, INVENTORY_PURCHASE, LOG_TAB, PRODUCT_CODES, Warehouse

Rule = tuple[str, str, Column]
OLDEST_DATE = _dt.date(2020, 1, 1)


def _least(cols: Sequence[str]) -> Column:
    return F.least(*[F.col(c) for c in cols])


def _not_numeric(raw: str, p: int, s: int) -> Column:
    return blank_to_null(raw).isNotNull() & to_decimal(raw, p, s).isNull()


def log_rules(run_date: _dt.date, run_ts: _dt.datetime) -> list[Rule]:
    """Row-level rules of the transaction log (raw cells are ``raw_*``)."""
    t = F.col("transaction_type")
    purchase = t == config.PURCHASE
    sale = t == config.SALE
    vendor = F.col("vendor_name").isNotNull()
    customer = F.col("customer_name").isNotNull()
    any_qty_bad = None
    for c in config.QTY_COLUMNS:
        bad = _not_numeric(f"raw_{c}", 10, 3)
        any_qty_bad = bad if any_qty_bad is None else any_qty_bad | bad
    return [
        ("stg_txn_type_invalid", "error", blank_to_null("raw_transaction_type").isNotNull() & ~t.isin(config.PURCHASE, config.SALE)),
        ("stg_txn_type_null", "error", blank_to_null("raw_transaction_type").isNull()),
        ("stg_txn_timestamp_null", "error", F.col("transaction_timestamp").isNull()),
        ("stg_txn_timestamp_future", "warning",
         F.col("transaction_timestamp") > naive_ts(run_ts) + F.expr("interval 5 minutes")),
        ("stg_txn_date_future", "warning", F.col("transaction_date") > F.lit(run_date)),
        ("stg_txn_date_too_old", "warning", F.col("transaction_date") < F.lit(OLDEST_DATE)),
        ("stg_txn_vendor_required", "error", purchase & ~vendor),
        ("stg_txn_customer_required", "error", sale & ~customer),
        ("stg_txn_vendor_on_sale", "warning", sale & vendor),
        ("stg_txn_customer_on_purchase", "warning", purchase & customer),
        ("stg_txn_both_counterparties", "warning", vendor & customer),
        ("stg_txn_payment_negative", "warning", F.col("payment_rs") < 0),
        ("stg_txn_qty_negative", "error", _least(config.QTY_COLUMNS) < 0),
        ("stg_txn_payment_mode_invalid", "error",
         F.col("payment_mode").isNotNull() & ~F.col("payment_mode").isin(*config.PAYMENT_MODES)),
        ("stg_txn_payment_mode_default", "warning",
         (F.col("payment_rs") != 0) & blank_to_null("raw_payment_mode").isNull()),
        ("stg_txn_noop_row", "error", (F.col("total_qty_kg") == 0) & (F.col("payment_rs") == 0)),
        ("stg_txn_qty_not_numeric", "error", any_qty_bad),
        ("stg_txn_payment_not_numeric", "error", _not_numeric("raw_payment_rs", 12, 2)),
        ("stg_txn_name_whitespace", "warning",
         (F.col("raw_vendor_name") != F.trim("raw_vendor_name")) | (F.col("raw_customer_name") != F.trim("raw_customer_name"))),
    ]


def rate_rules(name_col: str, prefix: str, run_date: _dt.date) -> list[Rule]:
    rates = [F.col(c) for c in config.RATE_COLUMNS]
    bad = None
    for c in config.RATE_COLUMNS:
        b = _not_numeric(f"raw_{c}", 10, 2)
        bad = b if bad is None else bad | b
    return [
        (f"{prefix}_effective_from_null", "error", F.col("effective_from").isNull()),
        (f"{prefix}_{name_col.split('_')[0]}_null", "error", F.col(name_col).isNull()),
        (f"{prefix}_rate_negative", "error", F.least(*rates) < 0),
        (f"{prefix}_rate_not_numeric", "error", bad),
        (f"{prefix}_all_rates_null", "warning", F.coalesce(F.greatest(*rates), F.lit(0)) == 0),
        (f"{prefix}_effective_from_future", "info", F.col("effective_from") > F.lit(run_date)),
    ]


def broken_rules(rules: Sequence[Rule], severity: str | None = None) -> Column:
    """array<struct<rule_id, severity>> of the rules the row breaks."""
    items = [F.when(F.coalesce(pred, F.lit(False)), F.struct(F.lit(rid).alias("rule_id"), F.lit(sev).alias("severity")))
             for rid, sev, pred in rules if severity is None or sev == severity]
    return F.array_compact(F.array(*items))


#: Raw cells that the row rules look at.
RAW_COLUMNS = ["transaction_type", "vendor_name", "customer_name", "payment_rs", "payment_mode", *config.QTY_COLUMNS]


def _log_input(wh: Warehouse) -> DataFrame:
    """Typed log rows with their identity, raw cells (``raw_*``) and the raw row as JSON."""
    raw_cols = RAW_COLUMNS
    raw_json = F.to_json(F.struct(*[F.col(c) for c in sorted(wh.raw_log.columns) if c != "source_row_number"]))
    ident = wh.identified.select("*", *[F.col(c).alias(f"raw_{c}") for c in raw_cols], raw_json.alias("raw_json"))
    keep = ["source_row_id", "source_row_number", "content_fingerprint", "raw_json"] + [f"raw_{c}" for c in raw_cols]
    return staging.stg_transaction_log(ident, wh.run_date, keep=keep)


def _rates_input(raw: DataFrame, name_col: str, tab: str) -> DataFrame:
    raw_rates = raw.select("*", *[F.col(c).alias(f"raw_{c}") for c in config.RATE_COLUMNS])
    typed = raw_rates.select(
        parse_date("effective_from").alias("effective_from"), blank_to_null(name_col).alias(name_col),
        *[to_decimal(c, 10, 2).alias(c) for c in config.RATE_COLUMNS],
        *[f"raw_{c}" for c in config.RATE_COLUMNS],
        F.concat_ws(":", F.lit("sheet"), F.lit(tab),
                    F.substring(fingerprint(["effective_from", name_col, *config.RATE_COLUMNS, "remarks"]), 1, 16))
        .alias("source_row_id"))
    return typed


def violations(wh: Warehouse, run_ts: _dt.datetime | None = None) -> DataFrame:
    """(sheet_tab, source_row_id, rule_id, severity) for every broken rule."""
    run_ts = run_ts or _dt.datetime.combine(wh.run_date, _dt.time()) + _dt.timedelta(days=1)
    log = _log_input(wh)
    parts = [log.select(F.lit(LOG_TAB).alias("sheet_tab"), "source_row_id",
                        F.explode(broken_rules(log_rules(wh.run_date, run_ts))).alias("v"))]
    dup = near_duplicates(log.select("source_row_id", "content_fingerprint", "transaction_timestamp"),
                          ["content_fingerprint"], "transaction_timestamp", 60)
    parts.append(dup.where("is_near_duplicate").select(
        F.lit(LOG_TAB).alias("sheet_tab"), "source_row_id",
        F.struct(F.lit("stg_txn_duplicate_submission").alias("rule_id"), F.lit("warning").alias("severity")).alias("v")))
    for raw, name_col, prefix, tab in ((wh.vendor_rates, "vendor_name", "stg_vr", "Vendor Rates"),
                                       (wh.customer_rates, "customer_name", "stg_cr", "Customer Rates")):
        r = _rates_input(raw, name_col, tab)
        parts.append(r.select(F.lit(tab).alias("sheet_tab"), "source_row_id",
                              F.explode(broken_rules(rate_rules(name_col, prefix, wh.run_date))).alias("v")))
        keys = r.where(F.col("effective_from").isNotNull() & F.col(name_col).isNotNull()) \
            .groupBy("effective_from", name_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(r.join(keys, ["effective_from", name_col], "left_semi").select(
            F.lit(tab).alias("sheet_tab"), "source_row_id",
            F.struct(F.lit(f"{prefix}_duplicate_key").alias("rule_id"), F.lit("error").alias("severity")).alias("v")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("sheet_tab", "source_row_id", "v.rule_id", "v.severity")


# --- transformation, referential, reconciliation and ingest rules (ids are fixed values) ---------------------

def transform_violations(wh: Warehouse) -> DataFrame:
    """(rule_id, severity, source_row_id, product_name): classification and rate lookup, one pass over each input."""
    c = wh.classified
    moves, pays = F.col("inventory_movement_type").isNotNull(), F.col("payment_type").isNotNull()
    known = F.col("transaction_type").isin(config.PURCHASE, config.SALE)
    rows = c.select("source_row_id", F.lit(None).cast("string").alias("product_name"), F.explode(broken_rules([
        ("xform_class_unknown", "error", known & ~F.col("is_noop") & ~moves & ~pays),
        ("xform_class_multi_event", "info", moves & pays),
        ("xform_class_inventory_no_qty", "error", moves & (F.col("total_qty_kg") == 0)),
        ("xform_class_payment_no_amount", "error", pays & (F.col("payment_rs") == 0)),
    ])).alias("v"))
    status, found = F.col("rate_lookup_status"), F.col("rate_effective_from").isNotNull()
    lines = wh.rated_lines.withColumn("side", F.col("transaction_type")).withColumn("counterparty", analytics.counterparty_of())
    checked = lines.select("source_row_id", "product_name", F.explode(broken_rules([
        ("xform_rate_missing_counterparty", "error", status == config.MISSING_COUNTERPARTY),
        ("xform_rate_missing_product", "error", found & (F.coalesce("rate_rs", F.lit(0)) == 0)),
        ("xform_rate_no_match", "error", (status != config.MISSING_COUNTERPARTY) & ~found),
        ("xform_rate_zero", "warning", F.col("rate_rs") == 0),
        ("xform_rate_counterparty_name_mismatch", "warning", F.col("name_mismatch")),
    ])).alias("v"))
    ties = wh.rates.groupBy("side", "counterparty", F.col("effective_from").alias("rate_effective_from")).count().where("count > 1")
    tied = lines.join(ties, ["side", "counterparty", "rate_effective_from"], "left_semi").select(
        "source_row_id", "product_name", F.struct(F.lit("xform_rate_multiple_match").alias("rule_id"), F.lit("error").alias("severity")).alias("v"))
    return rows.unionByName(checked).unionByName(tied).select("v.rule_id", "v.severity", "source_row_id", "product_name")


def referential_violations(wh: Warehouse) -> DataFrame:
    """(rule_id, severity, source_row_id): fact rows whose keys are in no dimension or whose source row is not staged."""
    dims = wh.dim_counterparty
    facts = wh.fact_inventory.select("source_row_id", "vendor_key", "customer_key", "product_key").unionByName(
        wh.fact_payment.select("source_row_id", "vendor_key", "customer_key", F.lit(None).cast("string").alias("product_key")))
    parts = []
    for rule, column, kind in (("xform_ref_vendor_key", "vendor_key", "vendor"), ("xform_ref_customer_key", "customer_key", "customer")):
        keys = dims.where(F.col("counterparty_type") == kind).select(F.col("counterparty_key").alias(column))
        parts.append((rule, facts.where(F.col(column).isNotNull()).join(keys, column, "left_anti")))
    parts.append(("xform_ref_product_key", facts.where(F.col("product_key").isNotNull() & ~F.col("product_key").isin(*PRODUCT_CODES.values()))))
    parts.append(("xform_ref_source_row", facts.join(wh.stg.select("source_row_id").distinct(), "source_row_id", "left_anti")))
    out = [df.select(F.lit(rule).alias("rule_id"), F.lit("error").alias("severity"), "source_row_id") for rule, df in parts]
    return reduce(DataFrame.unionByName, out)


#: Tolerated change of the staging row count, and the balance below which a counterparty is flagged.
ROW_COUNT_CHANGE, BALANCE_FLOOR = 0.10, -1000


def reconciliation(wh: Warehouse, previous_ids: DataFrame, current_ids: DataFrame) -> DataFrame:
    """(rule_id, severity, expected, actual, violations): target-layer totals against staging, one row per rule.

    Sums are exact decimals; a violation count of 0 means the rule holds.
    """
    stg, pay, inv = wh.stg, wh.fact_payment, wh.fact_inventory
    double = lambda c: F.coalesce(c, F.lit(0)).cast("double")

    def compare(rule: str, expected: DataFrame, actual: DataFrame, bad) -> DataFrame:
        none = F.lit(None).cast("double")
        both = expected.select(F.col("v").alias("expected"), none.alias("actual")).unionByName(actual.select(none.alias("expected"), F.col("v").alias("actual")))
        both = both.groupBy(F.lit(rule).alias("rule_id")).agg(F.max("expected").alias("expected"), F.max("actual").alias("actual"))
        return both.select("rule_id", F.lit("warning").alias("severity"), "expected", "actual", bad(F.col("expected"), F.col("actual")).cast("long").alias("violations"))

    def counted(rule: str, severity: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("violations")).select(
            F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(0.0).alias("expected"), F.col("violations").cast("double").alias("actual"), "violations")

    total = lambda df, c: df.agg(double(F.sum(c)).alias("v"))
    size = lambda df: df.agg(F.count("*").cast("double").alias("v"))
    differ = lambda a, b: a != b
    event = F.col("inventory_movement_type").isNotNull() | F.col("payment_type").isNotNull()
    valid = F.col("transaction_type").isin(config.PURCHASE, config.SALE) & ~F.col("is_noop")
    facts = inv.select("source_row_id").unionByName(pay.select("source_row_id"))
    gone = previous_ids.distinct().join(current_ids.distinct(), "source_row_id", "left_anti")
    on_hand = inv.groupBy("product_key").agg(F.sum(F.when(F.col("movement_type") == INVENTORY_PURCHASE, F.col("quantity_kg"))
                                                   .when(F.col("movement_type") == CUSTOMER_SALE, -F.col("quantity_kg"))).alias("kg"))
    return reduce(DataFrame.unionByName, [
        compare("tgt_row_count_staging", size(previous_ids), size(current_ids), lambda a, b: F.abs(b - a) > ROW_COUNT_CHANGE * a),
        compare("tgt_payment_sum", total(stg.where("payment_rs <> 0"), "payment_rs"), total(pay, "amount_rs"), differ),
        compare("tgt_qty_sum", total(stg, "total_qty_kg"), total(inv, "quantity_kg"), differ),
        counted("tgt_event_coverage", "error", wh.classified.where(valid & ~event)),
        counted("tgt_orphan_facts", "error", facts.join(stg.select("source_row_id").distinct(), "source_row_id", "left_anti")),
        counted("tgt_deleted_row_in_marts", "error", facts.join(gone, "source_row_id", "left_semi")),
        counted("tgt_ar_negative", "warning", wh.ar_balance().where(F.col("ar_balance") < BALANCE_FLOOR)),
        counted("tgt_ap_negative", "warning", wh.ap_balance().where(F.col("ap_balance") < BALANCE_FLOOR)),
        counted("tgt_inventory_negative", "warning", on_hand.where("kg < 0")),
    ])


def ingest_violations(first: DataFrame, second: DataFrame, third: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule_id, severity, load_no, source_row_id): rows that left, or came back after they had left, in three extracts in turn.

    ``known``: more ids, once each, whose extracts are known already (booleans ``in1``, ``in2``, ``in3``); they are not shuffled.
    """
    flags = reduce(lambda a, b: a.join(b, "source_row_id", "full"), [
        ids.distinct().withColumn(f"in{i}", F.lit(True)) for i, ids in enumerate((first, second, third), 1)])
    flags = flags if known is None else flags.unionByName(known)
    was = [F.coalesce(F.col(f"in{i}"), F.lit(False)) for i in (1, 2, 3)]
    event = lambda rule, severity, load, pred: F.when(pred, F.struct(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(load).alias("load_no")))
    events = F.array_compact(F.array(
        event("ingest_source_row_deleted", "warning", 2, was[0] & ~was[1]),
        event("ingest_source_row_deleted", "warning", 3, was[1] & ~was[2]),
        event("ingest_source_row_reactivated", "info", 3, was[0] & ~was[1] & was[2])))
    return flags.select(F.explode(events).alias("e"), "source_row_id").select("e.rule_id", "e.severity", "e.load_no", "source_row_id")


def quarantine(wh: Warehouse, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Log rows with at least one error: id, sorted rule ids and the raw row as JSON - one narrow pass."""
    run_ts = run_ts or _dt.datetime.combine(wh.run_date, _dt.time()) + _dt.timedelta(days=1)
    log = _log_input(wh)
    errs = F.transform(broken_rules(log_rules(wh.run_date, run_ts), "error"), lambda s: s["rule_id"])
    # A generator keeps only rows with errors.  (A Filter on the computed ids would be pushed below
    # the projection with the whole rule expression substituted into it - evaluated twice per row.)
    joined = F.array(F.array_join(F.array_sort(errs), ","))
    return log.select("source_row_id", F.explode(F.filter(joined, lambda x: x != "")).alias("rule_ids"), "raw_json")


def judged(wh: Warehouse, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Typed log rows with the sorted ids of the error rules they break (NULL: none) and, if any, the raw row as JSON.

    ``quarantine`` and the rows that are not in it, in one pass; the JSON is written for broken rows only.
    """
    run_ts = run_ts or _dt.datetime.combine(wh.run_date, _dt.time()) + _dt.timedelta(days=1)
    raw = F.struct(*[F.col(c) for c in sorted(wh.raw_log.columns) if c != "source_row_number"])
    ident = wh.identified.select("*", *[F.col(c).alias(f"raw_{c}") for c in RAW_COLUMNS], raw.alias("raw_cells"))
    log = staging.stg_transaction_log(ident, wh.run_date, keep=["source_row_id", "raw_cells"] + [f"raw_{c}" for c in RAW_COLUMNS])
    errs = F.transform(broken_rules(log_rules(wh.run_date, run_ts), "error"), lambda s: s["rule_id"])
    found = log.withColumn("rule_ids", F.array_join(F.array_sort(errs), ","))
    broken = F.col("rule_ids") != ""
    return found.select("*", F.when(broken, F.to_json("raw_cells")).alias("raw_json")).withColumn("rule_ids", F.when(broken, F.col("rule_ids"))).drop(
        "raw_cells", *[f"raw_{c}" for c in RAW_COLUMNS])


# --- fixed values: the nine validation checks ------------------------------------------------------
CHECKS = ("quality_unknown_vendor", "quality_unknown_customer", "quality_missing_rate",
          "quality_future_transaction_date", "quality_invalid_transaction_type", "quality_invalid_payment_mode",
          "quality_negative_quantity", "quality_negative_payment", "quality_suspicious_business_event")


def _checked(wh: Warehouse) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """Active log rows with what the checks need; the condition of every check; for checks of several parts, an array of the parts that failed."""
    stg = wh.stg
    names = wh.rates.select(F.col("side").alias("transaction_type"), F.col("counterparty").alias("__cp")).distinct() \
        .withColumn("__known", F.lit(True))
    cp = F.when(F.col("transaction_type") == config.PURCHASE, F.col("vendor_name")) \
        .when(F.col("transaction_type") == config.SALE, F.col("customer_name"))
    unmatched = wh.rated_lines.where(F.col("rate_lookup_status") == config.MISSING_RATE) \
        .groupBy("source_row_id").agg(F.array_sort(F.collect_set("product_name")).alias("__missing"))  # products of one row
    j = stg.withColumn("__cp", cp).join(names, ["transaction_type", "__cp"], "left") \
        .join(unmatched, "source_row_id", "left")
    t = F.col("transaction_type")
    vendor, customer = F.col("vendor_name").isNotNull(), F.col("customer_name").isNotNull()
    suspicious = {"vendor_and_customer": vendor & customer, "sale_with_vendor": (t == config.SALE) & vendor,
                  "purchase_with_customer": (t == config.PURCHASE) & customer, "nothing_moved": (F.col("total_qty_kg") == 0) & (F.col("payment_rs") == 0)}
    flags = {
        "quality_unknown_vendor": (t == config.PURCHASE) & F.col("__known").isNull(),
        "quality_unknown_customer": (t == config.SALE) & F.col("__known").isNull(),
        "quality_missing_rate": F.col("__missing").isNotNull(),
        "quality_future_transaction_date": F.col("transaction_date") > F.lit(wh.run_date),
        "quality_invalid_transaction_type": ~F.coalesce(t.isin(config.PURCHASE, config.SALE), F.lit(False)),
        "quality_invalid_payment_mode": (F.col("payment_rs") != 0)
        & ~F.coalesce(F.col("payment_mode").isin(*config.PAYMENT_MODES), F.lit(False)),
        "quality_negative_quantity": _least(config.QTY_COLUMNS) < 0,
        "quality_negative_payment": F.col("payment_rs") < 0,
        "quality_suspicious_business_event": reduce(Column.__or__, suspicious.values()),
    }
    parts = {"quality_missing_rate": F.col("__missing"),
             "quality_negative_quantity": F.array_compact(F.array(*[F.when(F.col(c) < 0, F.lit(c)) for c in config.QTY_COLUMNS])),
             "quality_suspicious_business_event": F.array_compact(F.array(*[F.when(e, F.lit(n)) for n, e in suspicious.items()]))}
    return j, {n: F.coalesce(e, F.lit(False)) for n, e in flags.items()}, parts


def validation_flags(wh: Warehouse) -> DataFrame:
    """One row per active log row with a boolean per check."""
    j, flags, _ = _checked(wh)
    return j.select("source_row_id", *[e.alias(n) for n, e in flags.items()])


def validation_details(wh: Warehouse) -> DataFrame:
    """(source_row_id, check_id, sub_check, severity): a row per failed check, of checks of several parts (products, columns, kinds) per part."""
    j, flags, parts = _checked(wh)
    whole = F.array(F.lit(None).cast("string"))
    found = F.array(*[F.when(e, F.struct(F.lit(n).alias("check_id"), parts.get(n, whole).alias("sub_checks"))) for n, e in flags.items()])
    failed = j.select("source_row_id", F.inline(F.array_compact(found)))
    return failed.select("source_row_id", "check_id", F.explode("sub_checks").alias("sub_check"), F.lit("warning").alias("severity"))


def validation_overall(wh: Warehouse) -> DataFrame:
    """One row: mean score of the checks, and the share of active rows without and with a warning."""
    f = validation_flags(wh)
    warned = F.greatest(*[F.col(c).cast("int") for c in CHECKS])
    score = reduce(Column.__add__, [(1 - F.count_if(F.col(c)) / F.count(F.lit(1))) * 100 for c in CHECKS]) / len(CHECKS)
    return f.agg(F.count(F.lit(1)).alias("active_rows"), score.alias("quality_score"), (F.avg((1 - warned).cast("double")) * 100).alias("row_pass_rate_pct"),
                 (F.avg(warned.cast("double")) * 100).alias("warning_rate_pct"))


def validation_summary(wh: Warehouse) -> DataFrame:
    """Per check: violating rows, active rows, pass % ; plus an ``overall`` row (score, row pass/warning rate)."""
    f = validation_flags(wh)
    any_flag = F.greatest(*[F.col(c).cast("int") for c in CHECKS])
    agg = f.agg(F.count(F.lit(1)).alias("active_rows"),
                *[F.count_if(F.col(c)).alias(c) for c in CHECKS],
                F.count_if(any_flag == 1).alias("__warned"))
    rows = F.array(*[F.struct(F.lit(c).alias("check_id"), F.col(c).alias("violating_rows")) for c in CHECKS])
    per = agg.select("active_rows", F.inline(rows)).select(
        "check_id", "violating_rows", "active_rows",
        ((1 - F.col("violating_rows") / F.col("active_rows")) * 100).alias("pass_pct"))
    score = F.aggregate(F.array(*[(1 - F.col(c) / F.col("active_rows")) * 100 for c in CHECKS]), F.lit(0.0),
                        lambda acc, x: acc + x) / len(CHECKS)
    overall = agg.select(F.lit("overall").alias("check_id"), F.col("__warned").alias("violating_rows"), "active_rows",
                         score.alias("pass_pct"))
    return per.unionByName(overall)


# --- fixed values: provisional KPI thresholds (metric, direction, warning, critical) ---------------
THRESHOLDS = [
    ("data_quality_error_rate", "above", 5.0, 10.0),
    ("data_quality_warning_rate", "above", 15.0, 25.0),
    ("rate_match_rate", "below", 95.0, 90.0),
    ("gross_margin_pct", "below", 15.0, 10.0),
    ("collection_rate_pct", "below", 75.0, 60.0),
    ("inventory_on_hand_qty_kg", "below", None, 0.0),
]


def kpi_alerts(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Metric values joined to their bounds -> ok / warning / critical."""
    metrics = wh.metrics_catalog()
    v = violations(wh)
    log_rows = wh.stg.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    rates = v.where(F.col("sheet_tab") == LOG_TAB).agg(
        (F.count_distinct(F.when(F.col("severity") == "error", F.col("source_row_id"))) / log_rows * 100)
        .alias("data_quality_error_rate"),
        (F.count_distinct(F.when(F.col("severity") == "warning", F.col("source_row_id"))) / log_rows * 100)
        .alias("data_quality_warning_rate"))
    allm = metrics.unionByName(rates.unpivot([], rates.columns, "metric", "value"))
    bounds = spark.createDataFrame(THRESHOLDS, "metric string, direction string, warning double, critical double")
    j = allm.join(F.broadcast(bounds), "metric", "inner")
    above = F.col("direction") == "above"
    crit = F.when(above, F.col("value") > F.col("critical")).otherwise(F.col("value") < F.col("critical"))
    warn = F.when(above, F.col("value") > F.col("warning")).otherwise(F.col("value") < F.col("warning"))
    status = F.when(F.coalesce(crit, F.lit(False)), F.lit("critical")) \
        .when(F.coalesce(warn, F.lit(False)), F.lit("warning")).otherwise(F.lit("ok"))
    return j.select("metric", "value", "warning", "critical", status.alias("status"))
