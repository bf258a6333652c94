"""The warehouse across loads: presence history, soft delete, facts and quarantine kept up to date by changes.

Everything is keyed by ``source_row_id``:

* ``spans``: for each tab and row the stretches of loads in which it was seen, in one array, the
  last one open while it is.  A load writes them once, with what it did to each row.  The snapshot
  per load, the lifecycle columns and the quarantine's times are read off a row's array, without a shuffle.
* ``rows``: the cells of every log row ever seen (a row that is edited gets another id).
* ``typed``: the typed cells of those rows and the error rules they break, judged once, when a row
  is new.  Rows that break none have facts.
* ``errors``: the others of them.
* ``marks``: the loads in which a row left or came back.
* ``revalued``: the loads in which a counterparty's rates changed.
* ``fact_inventory`` and ``fact_payment``: valued lines and payments.  A load adds those of new
  rows, and values the lines anew of rows whose counterparty's rates changed.

All but ``spans`` only ever grow: a load adds what is new and neither reads nor writes what was
kept.  A reader leaves out valuations older than the counterparty's last change and meets the
marks by id; keys and fingerprints, which are hashes of a row's id, names or cells, are taken there
too and not kept.  What a load writes for itself alone is deleted when it is done.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.functions.expr import naive_ts
from ledgerflow.operators import buckets, cdc, skew
from ledgerflow.plans import analytics, rules, staging, store
from ledgerflow.plans.warehouse import LOG_FINGERPRINT, LOG_TAB, Warehouse, norm_name

KEY = ["source_row_id"]
VENDOR_TAB, CUSTOMER_TAB = "Vendor Rates", "Customer Rates"
LOG_CELLS = list(dict.fromkeys(LOG_FINGERPRINT.values()))
LIFECYCLE = "ingested_at timestamp_ntz, is_deleted boolean, deleted_at timestamp_ntz, deletion_reason string"
TABLES = {
    "rows": "source_row_id string, source_row_number long, " + ", ".join(f"{c} string" for c in LOG_CELLS),
    "spans": "sheet_tab string, source_row_id string, stretches array<struct<source_row_number:bigint,from_no:int,to_no:int>>, n long, changed boolean, new boolean, returned boolean, left boolean",
    "errors": "source_row_id string, rule_ids string, raw_json string",
    "typed": "source_row_id string, first_no int, transaction_timestamp timestamp_ntz, transaction_date date, transaction_type string, vendor_name string, customer_name string, "
             "payment_rs decimal(12,2), payment_mode string, " + ", ".join(f"{c} decimal(10,3)" for c in config.QTY_COLUMNS) + ", total_qty_kg decimal(14,3), remarks string, rule_ids string, raw_json string",
    "marks": "source_row_id string, left_no int, back_no int",
    "revalued": "side string, name string, renewed_no int",
    "fact_inventory": "source_row_id string, first_no int, derived_no int, transaction_timestamp timestamp_ntz, transaction_date date, transaction_type string, vendor_name string, "
                      "customer_name string, product_name string, quantity_kg decimal(10,3), rate_rs decimal(10,2), line_value_rs decimal(18,2), rate_lookup_status string, remarks string",
    "fact_payment": "source_row_id string, first_no int, derived_no int, transaction_timestamp timestamp_ntz, transaction_date date, transaction_type string, vendor_name string, "
                    "customer_name string, payment_type string, payment_rs decimal(12,2), payment_mode string, remarks string",
}
#: So many ids or names at most are sent to every task (about 100 MB).
FEW = 1_000_000
#: Bare 64-bit hashes take a fraction of that.
FEW_HASHES = 5 * FEW


def packed_id() -> list[Column]:
    """``source_row_id`` under ``sheet_tab`` as ``h``, the eight bytes of its hexadecimal digits, and ``k``, what follows them; both empty for no id.

    Ids begin alike and are long: rows are shuffled and sorted by eight bytes that differ.  An id of another form is ``k`` as it is.
    """
    start = F.length("sheet_tab") + len("sheet::")
    h, k = F.unhex(F.substr("source_row_id", start + 1, F.lit(16))), F.substr("source_row_id", start + 17)
    fits = (F.length(h) == 8) & (_id_of(h, k) == F.col("source_row_id"))
    return [F.when(fits, h).otherwise(F.lit(b"")).alias("h"), F.when(fits, k).otherwise(F.coalesce("source_row_id", F.lit(""))).alias("k")]


def unpacked_id() -> Column:
    """The id of ``packed_id``."""
    h, k = F.col("h"), F.col("k")
    return F.when(F.length(h) > 0, _id_of(h, k)).when(k != "", k)


def _id_of(h: Column, k: Column) -> Column:
    return F.concat(F.lit("sheet:"), F.col("sheet_tab"), F.lit(":"), F.lower(F.hex(h)), k)


def rate_rows(rates: DataFrame, name_col: str, tab: str, side: str) -> DataFrame:
    """All that a load reads of a rate tab: ids (copies of a row have one), side and name as in keys, a hash of the priced cells, and the typed cells."""
    cells = ["effective_from", name_col, *config.RATE_COLUMNS]
    rid = F.concat_ws(":", F.lit("sheet"), F.lit(tab), F.substring(cdc.fingerprint([*cells, "remarks"]), 1, 16))
    return rates.select(F.lit(tab).alias("sheet_tab"), rid.alias("source_row_id"), F.lit(side).alias("side"), norm_name(F.col(name_col)).alias("name"), F.xxhash64(*cells).alias("x"),
                        *staging.rate_cells(name_col, "counterparty"))


class LoadHistory:
    """State under ``root``; ``load`` takes one extract of the three tabs after another."""

    def __init__(self, spark: SparkSession, root: str, run_date: _dt.date = config.RUN_DATE, n_buckets: int = buckets.BUCKETS):
        """``n_buckets``: of the ids, by which ``load`` says how widely it wrote."""
        self.spark, self.root, self.run_date, self.n = spark, root, run_date, n_buckets
        self.loads: list[tuple[str, _dt.datetime]] = []
        self.tables = {name: buckets.Appended(spark, f"{root}/{name}", columns) for name, columns in TABLES.items()}

    def open(self, loads: list[tuple[str, _dt.datetime]]) -> "LoadHistory":
        """Go on from what is under ``root`` after ``loads`` (id, time)."""
        self.loads = list(loads)
        for table in self.tables.values():
            table.open()
        return self

    # --- small lookups by load number ---------------------------------------------------------
    def _of_load(self, no: Column, part: int) -> Column:
        values = [naive_ts(x[1]) if part else F.lit(x[0]) for x in self.loads]
        return F.try_element_at(F.array(*values), no.cast("int"))

    def load_id(self, no: Column) -> Column:
        return self._of_load(no, 0)

    def load_ts(self, no: Column) -> Column:
        return self._of_load(no, 1)

    # --- one load -------------------------------------------------------------------------------
    def load(self, load_id: str, load_ts: _dt.datetime, log: DataFrame, vendor_rates: DataFrame, customer_rates: DataFrame) -> dict[str, int]:
        """``log``: stripped cells and ``source_row_number``.  Returns how many buckets of ids each table's writes fell in."""
        self.loads.append((load_id, load_ts))
        no = len(self.loads)
        short = lambda df: df.withColumn("content_fingerprint", F.substring("content_fingerprint", 1, 16)) if "content_fingerprint" in df.columns else df  # noqa: E731 - ids need no more
        identified = cdc.with_source_row_id(log, "sheet", LOG_TAB, list(LOG_FINGERPRINT.values()), names=list(LOG_FINGERPRINT),
                                            stage=lambda name, build: self._stage(f"{name}-{no}", short(build())))
        rates = self._stage(f"rate-rows-{no}", rate_rows(vendor_rates, "vendor_name", VENDOR_TAB, config.PURCHASE).unionByName(
            rate_rows(customer_rates, "customer_name", CUSTOMER_TAB, config.SALE)))
        state, in_bucket = self._observe(no, identified.select(F.lit(LOG_TAB).alias("sheet_tab"), "source_row_id", "source_row_number").unionByName(
            rates.select("sheet_tab", "source_row_id", F.lit(None).cast("long").alias("source_row_number"))))
        written = {"spans": sum(r.changed for r in in_bucket)}
        names = self._changed_rates(no, rates)
        table = self.tables
        written["rows"] = sum(r.new for r in in_bucket)
        written["errors"], typed = 0, None
        older = table["typed"].read().where("rule_ids IS NULL")
        if written["rows"]:
            fresh = self._once(state, identified)
            if table["rows"].versions:  # else no row was ever kept: all are new
                new = state.where("new").select("source_row_id")
                # the rows that are not new are left out before the others are shuffled with all their cells
                likely = skew.small(new.select(F.xxhash64("source_row_id").alias("__h")), FEW_HASHES)
                fresh = fresh.withColumn("__h", F.xxhash64("source_row_id")).join(likely, "__h", "left_semi").drop("__h").join(new, "source_row_id", "left_semi")
            fresh = self._append("rows", fresh, no)
            typed = self._append("typed", rules.judged(self._warehouse(fresh, vendor_rates, customer_rates)).withColumn("first_no", F.lit(no)), no)
            errors = table["errors"].append(typed.where("rule_ids IS NOT NULL"), no)
            written["errors"] = len(buckets.touched(errors, KEY, self.n))
            typed = typed.where("rule_ids IS NULL")
        moved = {r.bucket for r in in_bucket if r.marked}
        if moved:
            table["marks"].append(state.where("left OR returned").select("source_row_id", F.when(F.col("left"), F.lit(no)).alias("left_no"), F.when(F.col("returned"), F.lit(no)).alias("back_no")), no)
        # lines of new rows, and of older rows whose counterparty's rates changed
        if table["fact_inventory"].versions:
            names = table["revalued"].append(names.withColumn("renewed_no", F.lit(no)), no)
        asked = older.join(skew.small(names.select("side", "name"), FEW), self._is_of(), "left_semi")
        wh = self._warehouse(None, vendor_rates, customer_rates)
        wh.carry = ("first_no",)
        wh.stg = asked if typed is None else typed if not table["typed"].versions[:-1] else asked.unionByName(typed)
        wh.rates = rates.where("effective_from IS NOT NULL AND counterparty IS NOT NULL").select("side", "counterparty", "effective_from", *config.RATE_COLUMNS)
        wh._stage = lambda name, build: self._stage(f"{name}-{no}", build()) if name == "dated_lines" else build()
        valued = self._append("fact_inventory", wh.rated_lines.withColumn("derived_no", F.lit(no)), no)
        written["fact_inventory"] = len(moved.union(buckets.touched(valued, KEY, self.n)))
        paid = set()
        if typed is not None:
            wh.stg = typed
            payments = table["fact_payment"].append(wh.classified.where("event_payment").withColumn("derived_no", F.lit(no)), no)
            paid.update(buckets.touched(payments, KEY, self.n))
        written["fact_payment"] = len(moved | paid)
        for name in (f"fingerprinted-{no}", f"copies-{no}", f"rate-rows-{no}", f"dated_lines-{no}", f"rates-{no - 1}"):
            buckets.drop(self.spark, f"{self.root}/stages/{name}")
        return written

    def _once(self, state: DataFrame, identified: DataFrame) -> DataFrame:
        """The rows that have an id, one of each; only ids that an extract repeats are looked at again."""
        repeated = skew.small(state.where("n > 1").select("source_row_id"))
        named = identified.where("source_row_id IS NOT NULL")
        return named.join(repeated, "source_row_id", "left_anti").unionByName(named.join(repeated, "source_row_id", "left_semi").dropDuplicates(KEY))

    def _append(self, name: str, df: DataFrame, no: int) -> DataFrame:
        began = time.monotonic()
        out = self.tables[name].append(df, no)
        store.free(self.spark, time.monotonic() - began)
        return out

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        path, began = f"{self.root}/stages/{name}", time.monotonic()
        df.write.option("compression", "zstd").parquet(path)
        store.free(self.spark, time.monotonic() - began)
        return self.spark.read.schema(df.schema).parquet(path)

    def _warehouse(self, identified: DataFrame | None, vendor_rates: DataFrame, customer_rates: DataFrame) -> Warehouse:
        """Second-stage model over rows that have their ids already."""
        cells = identified if identified is None else identified.select(*LOG_CELLS, "source_row_number")
        wh = Warehouse(cells, vendor_rates, customer_rates, self.run_date)
        wh.identified = identified
        return wh

    def _observe(self, no: int, seen: DataFrame) -> tuple[DataFrame, list]:
        """Close and open stretches of the rows that came, left or moved, and write them all in one pass.

        Every row is shuffled once, by its id.  Returns the log's rows that are new, returned, left or
        repeated (``n``), and per bucket whether it changed, has new log rows, or such that left or returned.
        """
        table = self.tables["spans"]
        key = [*packed_id(), "sheet_tab"]
        now = seen.select(*key, "source_row_number").groupBy("h", "k", "sheet_tab").agg(F.min("source_row_number").alias("at"), F.count("*").alias("n"))
        if table.versions:
            both = now.join(table.newest().select(*key, F.col("stretches").alias("was")), ["h", "k", "sheet_tab"], "full")
        else:
            both = now.withColumn("was", F.lit(None).cast(table.newest().schema["stretches"].dataType))
        here, known = F.col("n").isNotNull(), F.col("was").isNotNull()
        id_ = unpacked_id()
        last = F.try_element_at("was", F.lit(-1))
        is_open = known & last["to_no"].isNull()
        stays = here & is_open & last["source_row_number"].eqNullSafe(F.col("at")) & id_.isNotNull()
        stretch = lambda at, start, end: F.array(F.struct(at.alias("source_row_number"), start.cast("int").alias("from_no"), end.cast("int").alias("to_no")))
        shut = F.concat(F.slice("was", F.lit(1), F.size("was") - 1), stretch(last["source_row_number"], last["from_no"], F.lit(no - 1)))
        begun = stretch(F.col("at"), F.lit(no), F.lit(None))
        stretches = (F.when(~known, begun).when(stays | (~here & ~is_open), F.col("was")).when(~here, shut)
                     .when(is_open, F.concat(shut, begun)).otherwise(F.concat("was", begun)))
        found = both.select("sheet_tab", id_.alias("source_row_id"), stretches.alias("stretches"), "n", (~stays & (here | is_open)).alias("changed"),
                            (~known).alias("new"), (here & known & ~is_open).alias("returned"), (~here & is_open).alias("left"))
        found = buckets.with_bucket(self._append("spans", found, no), KEY, self.n)
        mine = (F.col("sheet_tab") == LOG_TAB) & F.col("source_row_id").isNotNull()
        in_bucket = found.groupBy(buckets.BUCKET).agg(F.bool_or("changed").alias("changed"), F.bool_or(mine & F.col("new")).alias("new"),
                                                      F.bool_or(mine & (F.col("left") | F.col("returned"))).alias("marked")).collect()
        return found.where(mine), in_bucket

    def _changed_rates(self, no: int, rates: DataFrame) -> DataFrame:
        """(side, name) of the counterparties whose rate rows (``rate_rows``) are not those of the load before."""
        now = self._stage(f"rates-{no}", rates.groupBy("side", "name").agg(
            F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.sum(F.xxhash64(F.lit(1), "x").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s")))
        value = F.struct("n", "x", "s")
        if no == 1:
            return now.select("side", "name")
        before = self.spark.read.schema(now.schema).parquet(f"{self.root}/stages/rates-{no - 1}")
        j = before.select("side", "name", value.alias("p")).join(now.select("side", "name", value.alias("c")), ["side", "name"], "full")
        return j.where(~F.col("p").eqNullSafe(F.col("c"))).select("side", "name")

    # --- reads --------------------------------------------------------------------------------
    @staticmethod
    def _stretches(spans: DataFrame) -> DataFrame:
        """A row per stretch, with the first load of its row's next one and that of its row."""
        each = spans.select("*", F.posexplode("stretches").alias("pos", "s"))
        return each.select(*[c for c in spans.columns if c not in ("stretches", "n", "changed", "new", "returned", "left")], "s.*", F.try_element_at("stretches", F.col("pos") + 2)["from_no"].alias("next_no"),
                           F.element_at("stretches", 1)["from_no"].alias("first_no"))

    def snapshots(self) -> DataFrame:
        """The documented snapshot: one row per load, tab and row known by then.

        A narrow explode of the spans over the loads up to the row's next span.
        """
        n = len(self.loads)
        s = self._stretches(self.tables["spans"].newest()).withColumn("to_no", F.coalesce("to_no", F.lit(n)))
        e = s.select("*", F.explode(F.sequence("from_no", F.coalesce(F.col("next_no") - 1, F.lit(n)))).alias("no"))
        return e.select(self.load_id(F.col("no")).alias("load_id"), "sheet_tab", "source_row_id", "source_row_number", self.load_ts(F.col("first_no")).alias("first_seen_at"),
                        self.load_ts(F.least("no", "to_no")).alias("last_seen_at"), (F.col("no") <= F.col("to_no")).alias("is_present"))

    def staging(self) -> DataFrame:
        """Every log row ever seen with its lifecycle columns, read off its stretches and joined to the cells by id."""
        n = len(self.loads)
        newest = F.element_at("stretches", -1)
        last = self.tables["spans"].newest().where(F.col("sheet_tab") == LOG_TAB).select(
            "source_row_id", F.coalesce(newest["to_no"], F.lit(n)).alias("last_no"), newest["source_row_number"].alias("source_row_number"), F.element_at("stretches", 1)["from_no"].alias("first_no"))
        dead = F.col("last_no") < n
        life = last.select("source_row_id", "source_row_number", self.load_ts(F.col("first_no")).alias("ingested_at"), dead.alias("is_deleted"),
                           F.when(dead, self.load_ts(F.col("last_no") + 1)).alias("deleted_at"), F.when(dead, F.lit("source_removed")).alias("deletion_reason"),
                           F.when(dead, self.load_id(F.col("last_no") + 1)).alias("deleted_by_load_id"), self.load_id(F.col("last_no")).alias("last_seen_load_id"),
                           self.load_ts(F.col("last_no")).alias("last_seen_at"))
        rows = self.tables["rows"].read().drop("source_row_number").withColumn("content_fingerprint", cdc.fingerprint(list(LOG_FINGERPRINT.values()), list(LOG_FINGERPRINT)))
        return rows.join(life, "source_row_id")

    def departures(self) -> DataFrame:
        """(load_id, sheet_tab, source_row_id): rows of the load before that the load no longer holds, whether they came back later or not."""
        ended = self._stretches(self.tables["spans"].newest()).where(F.col("to_no") < len(self.loads)).withColumn("no", F.col("to_no") + 1)
        going_on = F.col("next_no").eqNullSafe(F.col("no")) & F.col("source_row_id").isNotNull()  # a row that only moved
        return ended.where(~going_on).select(self.load_id(F.col("no")).alias("load_id"), "sheet_tab", "source_row_id")

    @staticmethod
    def _is_of() -> list[Column]:
        """A typed row or line is of the counterparty (side, name)."""
        return [F.col("transaction_type") == F.col("side"), norm_name(analytics.counterparty_of()) == F.col("name")]

    def facts(self, name: str) -> DataFrame:
        """Facts with their lifecycle columns: the newest valuation of each row, deleted if the row left after it came (back)."""
        newest = self.tables[name].read()
        if name == "fact_inventory":  # payments have no rates
            renewed = self.tables["revalued"].read().groupBy("side", "name").agg(F.max("renewed_no").alias("renewed_no"))
            newest = newest.join(skew.small(renewed, FEW), [*self._is_of(), F.col("derived_no") < F.col("renewed_no")], "left_anti")
        marks = self.tables["marks"].read().groupBy("source_row_id").agg(F.max("left_no").alias("left_no"), F.max("back_no").alias("back_no"))
        newest = newest.join(skew.small(marks, FEW), "source_row_id", "left")
        gone = F.coalesce(F.col("left_no") > F.coalesce("back_no", F.lit(0)), F.lit(False))
        life = {"ingested_at": self.load_ts(F.col("first_no")), "is_deleted": gone, "deleted_at": F.when(gone, self.load_ts(F.col("left_no"))),
                "deletion_reason": F.when(gone, F.lit("source_removed"))}
        wh = self._warehouse(None, None, None)
        wh.carry = tuple(life)
        return (wh.inventory_facts if name == "fact_inventory" else wh.payment_facts)(newest.withColumns(life))

    def quarantine(self, notes: DataFrame | None = None) -> DataFrame:
        """The seven documented columns: an entry per stretch of loads in which a row with errors was present.

        An entry is resolved by the load in which the row is gone (corrected rows have
        another id) and another one is opened if it comes back.  ``notes``: (source_row_id,
        resolution_notes) written by hand.
        """
        n = len(self.loads)
        bad = self._stretches(self.tables["spans"].newest().join(self.tables["errors"].read(), "source_row_id"))
        by_id = Window.partitionBy("source_row_id").orderBy("from_no")
        bad = bad.withColumn("to_no", F.coalesce("to_no", F.lit(n)))
        opens = F.coalesce(F.lag("to_no").over(by_id) < F.col("from_no") - 1, F.lit(True))  # a row that only moved goes on
        episodes = bad.withColumn("episode", F.sum(opens.cast("int")).over(by_id)).groupBy("source_row_id", "rule_ids", "raw_json", "episode").agg(
            F.min("from_no").alias("from_no"), F.max("to_no").alias("to_no"))
        episodes = episodes.withColumn("resolution_notes", F.lit(None).cast("string")) if notes is None else episodes.join(notes, "source_row_id", "left")
        shut = F.col("to_no") < n
        return episodes.select(F.sha2(F.concat_ws("|", "source_row_id", self.load_id(F.col("from_no"))), 256).alias("quarantine_id"), "source_row_id",
                               F.col("raw_json").alias("raw_row_json"), "rule_ids", self.load_ts(F.col("from_no")).alias("quarantined_at"),
                               F.when(shut, self.load_ts(F.col("to_no") + 1)).alias("resolved_at"),
                               F.when(shut, F.coalesce("resolution_notes", F.lit("row left the source"))).alias("resolution_notes"))

    def active_warehouse(self, vendor_rates: DataFrame, customer_rates: DataFrame) -> Warehouse:
        """The second-stage model whose staging and facts are the active rows: marts and metrics over it leave deleted rows out."""
        wh = self._warehouse(cdc.active(self.staging()), vendor_rates, customer_rates)
        wh.fact_inventory = cdc.active(self.facts("fact_inventory"))
        wh.fact_payment = cdc.active(self.facts("fact_payment"))
        return wh

    def orphans(self) -> DataFrame:
        """(rule_id, severity, source_row_id): deleted facts whose row is active in staging, active facts whose row is not."""
        alive = self.staging().select("source_row_id", "is_deleted")
        facts = self.facts("fact_inventory").select("source_row_id", "is_deleted").unionByName(self.facts("fact_payment").select("source_row_id", "is_deleted"))
        return orphan_facts(facts, alive)


def orphan_facts(facts: DataFrame, staging: DataFrame) -> DataFrame:
    """Facts and staging (source_row_id, is_deleted) that disagree, one row per fact."""
    j = facts.withColumnRenamed("is_deleted", "fact_deleted").join(staging.withColumnRenamed("is_deleted", "row_deleted"), "source_row_id", "left")
    dead = F.coalesce("row_deleted", F.lit(True))
    return j.select("source_row_id", F.explode(rules.broken_rules([
        ("tgt_orphan_deleted_fact", "warning", F.col("fact_deleted") & ~dead),
        ("tgt_deleted_row_in_marts", "error", ~F.col("fact_deleted") & dead),
    ])).alias("v")).select("v.rule_id", "v.severity", "source_row_id")
