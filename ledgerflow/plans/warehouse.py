"""Second stage (documented target model): identity, events, dims, facts, fact marts.

Built on the same tabs as the first stage but keyed by the content-based
``source_row_id`` instead of the colliding transaction key:

* every log row gets ``source_row_id`` (``operators.cdc``);
* rows are classified into inventory / payment events;
* product lines are valued with the rate in force on *their own* date
  (per-line as-of) and get the three-way status matched / missing_rate /
  missing_counterparty, plus a case/space-insensitive name-match flag;
* dimensions, ``fact_inventory_movement``, ``fact_payment`` and the marts on
  top of them (daily sales / purchases, cash flow, AR / AP balances,
  inventory snapshot, monthly P&L) and the metric catalogue.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import nullcontext
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config
from ledgerflow.functions.expr import cond_sum, fiscal_year_start, month_start, week_start
from ledgerflow.operators.asof import asof_join, value_literal
from ledgerflow.operators.cdc import with_source_row_id
from ledgerflow.operators.prefix import running_sums
from ledgerflow.operators.reshape import unpivot_columns
from ledgerflow.plans import analytics, staging

MONEY = DecimalType(18, 2)
QTY = DecimalType(18, 3)

# --- fixed values: tab names and fingerprint columns (json key -> raw column) ----------
LOG_TAB = "Transaction Log"
LOG_FINGERPRINT = {
    "timestamp": "timestamp", "transaction_date_raw": "transaction_date", "transaction_type": "transaction_type",
    "vendor_name": "vendor_name", "customer_name": "customer_name", "payment_rs": "payment_rs",
    "payment_mode": "payment_mode", **{c: c for c in config.QTY_COLUMNS}, "remarks": "remarks",
}
PRODUCT_CODES = dict(zip(config.PRODUCT_NAMES, (c[: -len("_qty_kg")] for c in config.QTY_COLUMNS)))
INVENTORY_PURCHASE = "inventory_purchase"
CUSTOMER_SALE = "customer_sale"


def norm_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def surrogate(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def counterparty_key(kind: str, name: Column) -> Column:
    """md5 of ``kind|normalised name``; NULL when there is no name (no dimension row to point at)."""
    return F.md5(F.concat(F.lit(f"{kind}|"), norm_name(name)))


class Warehouse:
    def __init__(self, raw_log: DataFrame, vendor_rates: DataFrame, customer_rates: DataFrame,
                 run_date: _dt.date = config.RUN_DATE, sheet_id: str = "sheet", stage=None, passing=None):
        """``raw_log`` = cleaned all-string log plus ``source_row_number``.

        ``stage(name, build)`` (optional) materialises the hashed rows, the
        typed log and the valued lines once per run - each is read by several
        facts, marts and quality checks; without it they stay lazy.
        ``passing(name)`` (optional) gives a context with a ``stage`` for what is
        read only inside it (``store.passing``).
        """
        self.raw_log = raw_log
        self.vendor_rates = vendor_rates
        self.customer_rates = customer_rates
        self.run_date = run_date
        self.sheet_id = sheet_id
        self._stage = stage or (lambda name, build: build())
        self._passing = passing or (lambda name: nullcontext())
        self.carry: tuple[str, ...] = ()  # more columns of ``identified`` that go with a row into its facts

    @cached_property
    def identified(self) -> DataFrame:
        return with_source_row_id(self.raw_log, self.sheet_id, LOG_TAB, list(LOG_FINGERPRINT.values()),
                                  names=list(LOG_FINGERPRINT), stage=self._stage)

    @cached_property
    def typed(self) -> DataFrame:
        """The typed log, lazily: for what reads few of its columns once."""
        return staging.stg_transaction_log(self.identified, self.run_date,
                                           keep=["source_row_id", "source_row_number", *self.carry])

    @cached_property
    def stg(self) -> DataFrame:
        return self._stage("typed_log", lambda: self.typed)

    @cached_property
    def rates(self) -> DataFrame:
        return analytics.unified_rates(staging.stg_vendor_rates(self.vendor_rates),
                                       staging.stg_customer_rates(self.customer_rates))

    # --- X8 event classification -------------------------------------------------------
    @cached_property
    def classified(self) -> DataFrame:
        t = F.col("transaction_type")
        inv = F.col("total_qty_kg") > 0
        pay = F.col("payment_rs") != 0
        refund = F.col("payment_rs") < 0
        movement = F.when(inv & (t == config.PURCHASE), F.lit(INVENTORY_PURCHASE)) \
            .when(inv & (t == config.SALE), F.lit(CUSTOMER_SALE))
        ptype = F.when(pay & (t == config.PURCHASE), F.lit(config.VENDOR_PAYMENT)) \
            .when(pay & (t == config.SALE), F.lit(config.CUSTOMER_COLLECTION))
        pevent = F.when(refund, F.concat(ptype, F.lit("_refund"))).otherwise(ptype)
        events = F.array_compact(F.array(movement, pevent))
        return self.stg.select(
            "source_row_id", "transaction_timestamp", "transaction_date", "transaction_type",
            "vendor_name", "customer_name", "total_qty_kg", "payment_rs", "payment_mode",
            inv.alias("event_inventory"), pay.alias("event_payment"),
            movement.alias("inventory_movement_type"), ptype.alias("payment_type"),
            F.array_join(events, ",").alias("business_event_types"),
            (~inv & ~pay).alias("is_noop"), "remarks", *self.carry)

    # --- lines valued on their own date, three-way status (X9, X10) ----------------------
    @cached_property
    def lines(self) -> DataFrame:
        ids = ["source_row_id", "transaction_timestamp", "transaction_date", "transaction_type",
               "vendor_name", "customer_name", "remarks", *self.carry]
        long = unpivot_columns(self.stg, ids, dict(zip(config.QTY_COLUMNS, config.PRODUCT_NAMES)),
                               "product_name", "quantity_kg").where(F.col("quantity_kg") > 0)
        return long.withColumn("side", F.col("transaction_type")) \
            .withColumn("counterparty", analytics.counterparty_of())

    @cached_property
    def rated_lines(self) -> DataFrame:
        return self._stage("rated_lines", self._rated_lines)

    def _rated_lines(self) -> DataFrame:
        with self._passing("dated_lines") as passing:
            dated = self._stage("dated_lines", lambda: self._dated_lines(passing))
        names = self.rates.select("side", "counterparty").distinct()
        exact = names.withColumn("__exact", F.lit(True))
        loose = names.select("side", norm_name(F.col("counterparty")).alias("__norm")).distinct() \
            .withColumn("__loose", F.lit(True))
        # a line that met a rate row has its counterparty spelled as in the rate tabs: only the others ask for names
        met = dated.where("effective_from IS NOT NULL").withColumns({"__exact": F.lit(True), "__loose": F.lit(True)})
        asked = (dated.where("effective_from IS NULL")
                 .join(exact, ["side", "counterparty"], "left")
                 .withColumn("__norm", norm_name(F.col("counterparty")))
                 .join(loose, ["side", "__norm"], "left"))
        j = met.unionByName(asked.drop("__norm"))
        status = (F.when(F.col("rate_rs").isNotNull(), F.lit(config.MATCHED))
                  .when(F.col("__exact").isNotNull(), F.lit(config.MISSING_RATE))
                  .otherwise(F.lit(config.MISSING_COUNTERPARTY)))
        value = F.round(F.col("quantity_kg") * F.col("rate_rs"), 2).cast(MONEY)
        return j.select(
            "source_row_id", "transaction_timestamp", "transaction_date", "transaction_type", "vendor_name",
            "customer_name", "product_name", "quantity_kg", "rate_rs", value.alias("line_value_rs"),
            status.alias("rate_lookup_status"),
            (F.col("__exact").isNull() & F.col("__loose").isNotNull()).alias("name_mismatch"),
            "remarks", F.col("effective_from").alias("rate_effective_from"), *self.carry)

    def _dated_lines(self, passing=None) -> DataFrame:
        """Lines with the rate row in force on their date: its first day, and its price of the line's product."""
        last_day = value_literal(self.stg.agg(F.max("transaction_date")).first()[0])  # of all rows: no line is later
        ids = ["source_row_id", "transaction_timestamp", "transaction_date", "transaction_type", "vendor_name", "customer_name", "remarks", *self.carry]
        forms = analytics.dated_forms(self.stg, self.rates, ids, last_day, passing)  # a form is shuffled once for all its lines
        lines = F.array(*[
            F.when(F.col(q) > 0, F.struct(F.lit(name).alias("product_name"), F.col(q).alias("quantity_kg"), F.col(r).alias("rate_rs")))
            for q, name, r in zip(config.QTY_COLUMNS, config.PRODUCT_NAMES, config.RATE_COLUMNS)])
        return forms.select(*ids, F.col("transaction_type").alias("side"), analytics.counterparty_of().alias("counterparty"), "effective_from", F.inline(lines)).where("quantity_kg IS NOT NULL")

    # --- X11 dimensions --------------------------------------------------------------------
    @cached_property
    def dim_counterparty(self) -> DataFrame:
        v = self.stg.select(F.lit("vendor").alias("counterparty_type"), norm_name(F.col("vendor_name")).alias("name")) \
            .unionByName(self.rates.where(F.col("side") == config.PURCHASE)
                         .select(F.lit("vendor").alias("counterparty_type"), norm_name(F.col("counterparty")).alias("name")))
        c = self.stg.select(F.lit("customer").alias("counterparty_type"), norm_name(F.col("customer_name")).alias("name")) \
            .unionByName(self.rates.where(F.col("side") == config.SALE)
                         .select(F.lit("customer").alias("counterparty_type"), norm_name(F.col("counterparty")).alias("name")))
        return v.unionByName(c).where(F.col("name").isNotNull()).distinct() \
            .withColumn("counterparty_key", F.md5(F.concat_ws("|", "counterparty_type", "name")))

    @cached_property
    def dim_date(self) -> DataFrame:
        b = self.typed.agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"))
        d = b.where(F.col("lo").isNotNull()).select(
            F.explode(F.sequence("lo", F.add_months("hi", 12), F.expr("interval 1 day"))).alias("date"))
        return d.select("date", F.year("date").alias("year"), F.month("date").alias("month"),
                        F.dayofmonth("date").alias("day"), F.dayofweek("date").alias("day_of_week"),
                        week_start("date").alias("week_start"), month_start("date").alias("month_start"),
                        fiscal_year_start("date").alias("fiscal_year_start"))

    # --- X12 / X13 facts ---------------------------------------------------------------------
    @cached_property
    def fact_inventory(self) -> DataFrame:
        return self.inventory_facts(self.rated_lines)

    def inventory_facts(self, lines: DataFrame) -> DataFrame:
        """Facts of valued lines, row by row."""
        code = analytics.pick_by_name("product_name", {n: F.lit(c) for n, c in PRODUCT_CODES.items()})
        movement = F.when(F.col("transaction_type") == config.PURCHASE, F.lit(INVENTORY_PURCHASE)) \
            .when(F.col("transaction_type") == config.SALE, F.lit(CUSTOMER_SALE))
        return lines.select(
            surrogate(F.col("source_row_id"), code).alias("movement_id"), "source_row_id",
            movement.alias("movement_type"), "transaction_date", code.alias("product_key"),
            F.when(F.col("transaction_type") == config.PURCHASE,
                   counterparty_key("vendor", F.col("vendor_name"))).alias("vendor_key"),
            F.when(F.col("transaction_type") == config.SALE,
                   counterparty_key("customer", F.col("customer_name"))).alias("customer_key"),
            "quantity_kg", "rate_rs", "line_value_rs", "rate_lookup_status",
            F.col("transaction_timestamp").alias("source_timestamp"), "remarks", *self.carry)

    @cached_property
    def fact_payment(self) -> DataFrame:
        return self.payment_facts(self.classified.where("event_payment"))

    def payment_facts(self, events: DataFrame) -> DataFrame:
        """Facts of payment events, row by row."""
        return events.select(
            surrogate(F.col("source_row_id"), F.lit("payment")).alias("payment_id"), "source_row_id",
            "payment_type", "transaction_date",
            F.when(F.col("transaction_type") == config.PURCHASE,
                   counterparty_key("vendor", F.col("vendor_name"))).alias("vendor_key"),
            F.when(F.col("transaction_type") == config.SALE,
                   counterparty_key("customer", F.col("customer_name"))).alias("customer_key"),
            F.col("payment_rs").alias("amount_rs"), F.col("payment_mode").alias("payment_mode_key"),
            F.col("transaction_timestamp").alias("source_timestamp"), "remarks", *self.carry)

    # --- X14 marts ----------------------------------------------------------------------------
    def daily_sales(self) -> DataFrame:
        f = self.fact_inventory.where(F.col("movement_type") == CUSTOMER_SALE)
        return f.groupBy("transaction_date", "product_key", "customer_key").agg(
            F.sum(F.when(F.col("rate_lookup_status") == config.MATCHED, F.col("line_value_rs"))
                  .otherwise(F.lit(0))).cast(MONEY).alias("gross_revenue"),
            F.sum("quantity_kg").cast(QTY).alias("sales_qty_kg"),
            F.count(F.lit(1)).alias("line_count"))

    def daily_purchases(self) -> DataFrame:
        f = self.fact_inventory.where(F.col("movement_type") == INVENTORY_PURCHASE)
        return f.groupBy("transaction_date", "product_key", "vendor_key").agg(
            F.sum(F.when(F.col("rate_lookup_status") == config.MATCHED, F.col("line_value_rs"))
                  .otherwise(F.lit(0))).cast(MONEY).alias("purchase_cost"),
            F.sum("quantity_kg").cast(QTY).alias("purchase_qty_kg"),
            F.count(F.lit(1)).alias("line_count"))

    def cash_flow(self) -> DataFrame:
        p = self.fact_payment
        cin = F.col("payment_type") == config.CUSTOMER_COLLECTION
        cout = F.col("payment_type") == config.VENDOR_PAYMENT
        cash = F.col("payment_mode_key") == "Cash"
        online = F.col("payment_mode_key") == "Online"
        out = p.groupBy("transaction_date").agg(
            cond_sum(cin & cash, F.col("amount_rs")).cast(MONEY).alias("cash_in"),
            cond_sum(cout & cash, F.col("amount_rs")).cast(MONEY).alias("cash_out"),
            cond_sum(cin & online, F.col("amount_rs")).cast(MONEY).alias("online_in"),
            cond_sum(cout & online, F.col("amount_rs")).cast(MONEY).alias("online_out"))
        return out.withColumn("net_cash_flow", (F.col("cash_in") + F.col("online_in")
                                                - F.col("cash_out") - F.col("online_out")).cast(MONEY))

    def _balances(self, key: str, movement: str, ptype: str, names: tuple[str, str, str]) -> DataFrame:
        total_f, total_p, bal = names
        f = self.fact_inventory.where((F.col("movement_type") == movement) & F.col(key).isNotNull()) \
            .groupBy(key).agg(F.sum(F.coalesce("line_value_rs", F.lit(0))).cast(MONEY).alias(total_f))
        p = self.fact_payment.where((F.col("payment_type") == ptype) & F.col(key).isNotNull()) \
            .groupBy(key).agg(F.sum("amount_rs").cast(MONEY).alias(total_p))
        j = f.join(p, key, "full")
        zero = F.lit(0).cast(MONEY)
        return j.select(key, F.coalesce(total_f, zero).alias(total_f), F.coalesce(total_p, zero).alias(total_p),
                        (F.coalesce(total_f, zero) - F.coalesce(total_p, zero)).cast(MONEY).alias(bal))

    def ar_balance(self) -> DataFrame:
        return self._balances("customer_key", CUSTOMER_SALE, config.CUSTOMER_COLLECTION,
                              ("total_sales", "total_collections", "ar_balance"))

    def ap_balance(self) -> DataFrame:
        return self._balances("vendor_key", INVENTORY_PURCHASE, config.VENDOR_PAYMENT,
                              ("total_purchases", "total_payments", "ap_balance"))

    def inventory_snapshot(self) -> DataFrame:
        """Per product and active day: purchased, sold and the running on-hand quantity.

        The running window is per product over daily aggregates, so its input
        is bounded by the calendar, whatever the line volume.
        """
        f = self.fact_inventory
        daily = f.groupBy("product_key", "transaction_date").agg(
            cond_sum(F.col("movement_type") == INVENTORY_PURCHASE, F.col("quantity_kg")).cast(QTY).alias("purchased_kg"),
            cond_sum(F.col("movement_type") == CUSTOMER_SALE, F.col("quantity_kg")).cast(QTY).alias("sold_kg"))
        w = Window.partitionBy("product_key").orderBy("transaction_date") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return daily.withColumn("on_hand_kg", F.sum(F.col("purchased_kg") - F.col("sold_kg")).over(w).cast(QTY))

    def inventory_valued(self) -> DataFrame:
        """Stock per product and active day with its value at the purchase rate in force that day.

        Running stock is summed in two levels by month; the rate is the newest vendor rate
        row not after the day (on equal dates the larger rate), carried forward.
        """
        f = self.fact_inventory
        daily = f.groupBy("product_key", "transaction_date").agg(
            cond_sum(F.col("movement_type") == INVENTORY_PURCHASE, F.col("quantity_kg")).cast(QTY).alias("purchased_kg"),
            cond_sum(F.col("movement_type") == CUSTOMER_SALE, F.col("quantity_kg")).cast(QTY).alias("sold_kg"))
        stock = running_sums(daily.where("transaction_date IS NOT NULL"), ["product_key"], "transaction_date", month_start("transaction_date"),
                             {"on_hand_kg": F.col("purchased_kg") - F.col("sold_kg")})
        code = analytics.pick_by_name("product_name", {n: F.lit(c) for n, c in PRODUCT_CODES.items()})
        dated = unpivot_columns(self.rates.where(F.col("side") == config.PURCHASE), ["effective_from"],
                                dict(zip(config.RATE_COLUMNS, config.PRODUCT_NAMES)), "product_name", "rate_rs")
        offered = dated.where(F.col("rate_rs").isNotNull()).groupBy(code.alias("product_key"), "effective_from").agg(F.max("rate_rs").alias("rate_rs"))
        priced = asof_join(stock, offered, ["product_key"], "transaction_date", "effective_from", how="left")
        return priced.select("product_key", "transaction_date", "purchased_kg", "sold_kg", F.col("on_hand_kg").cast(QTY).alias("on_hand_kg"), "rate_rs",
                             F.round(F.col("on_hand_kg") * F.col("rate_rs"), 2).cast(MONEY).alias("on_hand_value_rs"))

    def monthly_pnl(self) -> DataFrame:
        f = self.fact_inventory.where(F.col("rate_lookup_status") == config.MATCHED)
        m = f.groupBy(month_start("transaction_date").alias("month")).agg(
            cond_sum(F.col("movement_type") == CUSTOMER_SALE, F.col("line_value_rs")).cast(MONEY).alias("gross_revenue"),
            cond_sum(F.col("movement_type") == INVENTORY_PURCHASE, F.col("line_value_rs")).cast(MONEY).alias("purchase_cost"))
        profit = (F.col("gross_revenue") - F.col("purchase_cost")).cast(MONEY)
        return m.select("month", "gross_revenue", "purchase_cost", profit.alias("gross_profit"),
                        F.when(F.col("gross_revenue") > 0, profit.cast("double") / F.col("gross_revenue").cast("double")
                               * 100).alias("gross_margin_pct"))

    # --- X15 metric catalogue ---------------------------------------------------------------------
    def metrics_catalog(self) -> DataFrame:
        f = self.fact_inventory
        sale = F.col("movement_type") == CUSTOMER_SALE
        buy = F.col("movement_type") == INVENTORY_PURCHASE
        matched = F.col("rate_lookup_status") == config.MATCHED
        inv = f.agg(
            cond_sum(sale & matched, F.col("line_value_rs")).cast("double").alias("gross_revenue"),
            cond_sum(sale, F.col("quantity_kg")).cast("double").alias("sales_quantity_kg"),
            cond_sum(buy & matched, F.col("line_value_rs")).cast("double").alias("purchase_cost"),
            cond_sum(buy, F.col("quantity_kg")).cast("double").alias("purchase_quantity_kg"),
            F.count(F.lit(1)).cast("double").alias("inventory_movement_count"),
            (F.avg(matched.cast("double")) * 100).alias("rate_match_rate"),
            F.count_distinct("vendor_key").cast("double").alias("active_vendors"),
            F.count_distinct("customer_key").cast("double").alias("active_customers"),
        )
        p = self.fact_payment
        cin = F.col("payment_type") == config.CUSTOMER_COLLECTION
        cout = F.col("payment_type") == config.VENDOR_PAYMENT
        pay = p.agg(
            cond_sum(cin, F.col("amount_rs")).cast("double").alias("customer_collections"),
            cond_sum(cout, F.col("amount_rs")).cast("double").alias("vendor_payments"),
            F.count(F.lit(1)).cast("double").alias("payment_event_count"),
        )
        txn = self.stg.agg(F.count_distinct("source_row_id").cast("double").alias("transaction_count"))
        cash, online = F.col("payment_mode_key") == "Cash", F.col("payment_mode_key") == "Online"
        flows = p.agg(
            cond_sum(cin & cash, F.col("amount_rs")).cast("double").alias("cash_in"),
            cond_sum(cout & cash, F.col("amount_rs")).cast("double").alias("cash_out"),
            cond_sum(cin & online, F.col("amount_rs")).cast("double").alias("online_in"),
            cond_sum(cout & online, F.col("amount_rs")).cast("double").alias("online_out"))
        flows = flows.withColumn("net_cash_flow", F.col("cash_in") + F.col("online_in")
                                 - F.col("cash_out") - F.col("online_out"))
        total_ar = self.ar_balance().agg(F.sum("ar_balance").cast("double").alias("total_ar_outstanding"))
        total_ap = self.ap_balance().agg(F.sum("ap_balance").cast("double").alias("total_ap_outstanding"))
        # On-hand value: per product, on-hand kg x latest purchase rate (newest rate row, on equal dates
        # the larger rate), rounded to paise per product, then summed exactly.
        per_product = f.groupBy("product_key").agg(
            (cond_sum(buy, F.col("quantity_kg")) - cond_sum(sale, F.col("quantity_kg"))).alias("on_hand"))
        dated = unpivot_columns(self.rates.where(F.col("side") == config.PURCHASE), ["effective_from"],
                                dict(zip(config.RATE_COLUMNS, config.PRODUCT_NAMES)), "product_name", "rate_rs")
        code = analytics.pick_by_name("product_name", {n: F.lit(c) for n, c in PRODUCT_CODES.items()})
        latest = dated.where(F.col("rate_rs").isNotNull()).groupBy(code.alias("product_key")).agg(
            F.max(F.struct("effective_from", "rate_rs"))["rate_rs"].alias("latest_rate"))
        value = F.round(F.col("on_hand") * F.col("latest_rate"), 2)
        per_product = per_product.join(latest, "product_key", "left")
        on_hand_value = per_product.agg(F.sum(value.cast(MONEY)).cast("double").alias("inventory_on_hand_value_rs"))
        derived = {
            "avg_selling_price_per_kg": F.try_divide(F.col("gross_revenue"), F.col("sales_quantity_kg")),
            "avg_purchase_price_per_kg": F.try_divide(F.col("purchase_cost"), F.col("purchase_quantity_kg")),
            "gross_profit": F.col("gross_revenue") - F.col("purchase_cost"),
            "gross_margin_pct": F.when(F.col("gross_revenue") > 0, (F.col("gross_revenue") - F.col("purchase_cost"))
                                       / F.col("gross_revenue") * 100),
            "inventory_on_hand_qty_kg": F.col("purchase_quantity_kg") - F.col("sales_quantity_kg"),
        }
        inv_long = inv.select("*", *[e.alias(n) for n, e in derived.items()])
        revenue = inv.select("gross_revenue").scalar()
        pay_long = pay.select("*", F.when(revenue > 0, F.col("customer_collections") / revenue * 100)
                              .alias("collection_rate_pct"))
        parts = [
            inv_long.unpivot([], inv_long.columns, "metric", "value"),
            pay_long.unpivot([], pay_long.columns, "metric", "value"),
            txn.unpivot([], txn.columns, "metric", "value"),
            flows.unpivot([], flows.columns, "metric", "value"),
            total_ar.unpivot([], total_ar.columns, "metric", "value"),
            total_ap.unpivot([], total_ap.columns, "metric", "value"),
            on_hand_value.unpivot([], on_hand_value.columns, "metric", "value"),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
