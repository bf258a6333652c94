"""Sheet-tab exports -> all-string raw tables.

A tab is read as an export file (CSV with a header row, JSON lines or
parquet).  Every value stays a string; no schema inference.  The header row
is mapped to snake_case names through a fixed column map; an unknown
non-blank header (of a CSV file, or in any line of a JSON export) aborts the
load before a row is written, a missing header does not.  Cells are stripped of all Unicode whitespace, short rows are padded
with ``''`` and rows whose cells are all blank are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerflow.functions.expr import has_text, strip_all_whitespace
from ledgerflow.operators import buckets
from ledgerflow.sources import csv_blocks


class UnknownHeaderError(ValueError):
    pass


def check_headers(headers: list[str], column_map: Mapping[str, str], tab_name: str = "") -> dict[str, str]:
    """Return {header: target} for known headers; raise on unknown non-blank headers."""
    stripped = [h.strip() for h in headers]
    unknown = [h for h in stripped if h and h not in column_map]
    if unknown:
        raise UnknownHeaderError(f"Unrecognized columns in '{tab_name}': {', '.join(unknown)}")
    return {orig: column_map[h] for orig, h in zip(headers, stripped) if h in column_map}


def read_tab_export(spark: SparkSession, path: str, column_map: Mapping[str, str],
                    fmt: str = "csv", tab_name: str = "", strict: bool = True) -> DataFrame:
    """Scan a tab export as strings and apply the header contract (S1-S4).

    With ``strict`` off, unknown headers are left out instead (``header_findings`` reports them).
    """
    if fmt == "csv":
        df = _read_csv(spark, path, column_map, tab_name, strict)
    elif fmt == "json":
        df = _read_json(spark, path, column_map, tab_name, strict)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported tab export format: {fmt}")
    if not strict:
        df = df.select([F.col(f"`{h}`") for h in df.columns if h.strip() in column_map])
    mapping = check_headers(df.columns, column_map, tab_name)
    by_target: dict[str, list] = {}
    for h, t in mapping.items():  # a header may occur with and without blanks around it
        by_target.setdefault(t, []).append(F.col(f"`{h}`").cast("string"))
    return conform(df.select([F.coalesce(*cells).alias(t) for t, cells in by_target.items()]),
                   list(dict.fromkeys(column_map.values())))


def _read_csv(spark: SparkSession, path: str, column_map: Mapping[str, str], tab_name: str, strict: bool = True) -> DataFrame:
    """Cells may hold line breaks and doubled quotes; files are split all the same (``csv_blocks``).

    Every column is a string, ragged rows come back as NULL cells.  The first
    header is read on its own; a file whose header differs stops the load.
    """
    head = spark.read.option("header", False).option("multiLine", True).option("escape", '"').csv(path).first()
    names = [(h or "").strip() for h in head] if head else []
    if strict:
        check_headers(names, column_map, tab_name)
    if not names:
        return spark.createDataFrame([], StructType([]))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    # made by a generator: filters on cells would else be pushed below it, each cell with a parse of its own
    parsed = F.from_csv("record", schema, {"escape": '"', "mode": "PERMISSIVE"})
    cells = csv_blocks.read_records(spark, path).select("file", "first", F.inline(F.array(parsed)))
    same = F.lit(True)
    for i, h in enumerate(names):
        same &= F.trim(F.coalesce(F.col(f"c{i}"), F.lit(""))) == F.lit(h)
    wrong = F.raise_error(F.concat(F.lit(f"the header of a file of '{tab_name}' differs from the first one: "), F.col("file")))
    rows = cells.where(F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(F.lit(True)))
    # a column without a header is not part of the tab
    return rows.select([F.col(f"c{i}").alias(h) for i, h in enumerate(names) if h])


def _read_json(spark: SparkSession, path: str, column_map: Mapping[str, str], tab_name: str, strict: bool = True) -> DataFrame:
    """JSON lines; the keys of every line are gathered by one aggregate, an unknown one stops the load."""
    key = F.explode(F.json_object_keys("value")).alias("key")
    keys = spark.read.text(path).select(key).distinct().withColumn("known", F.trim("key").isin(list(column_map)))
    if strict:
        wrong = [r.key for r in keys.where(~F.col("known") & (F.trim("key") != "")).orderBy("key").limit(20).collect()]
        check_headers(wrong, column_map, tab_name)
    found = [r.key for r in keys.where("known").orderBy("key").collect()]
    return spark.read.schema(StructType([StructField(h, StringType()) for h in found])).json(path)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pad missing columns and NULL cells with '' and keep the contract order."""
    present = set(df.columns)
    return df.select([
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in present else F.lit("")).alias(c)
        for c in columns
    ])


def _stripped(df: DataFrame) -> tuple[DataFrame, Column]:
    cells = [c for c in df.columns if c != "source_row_number"]
    out = df.select([strip_all_whitespace(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in cells else F.col(c) for c in df.columns])
    return out, ~has_text(cells)


def clean_cells(df: DataFrame) -> DataFrame:
    """Strip every cell of surrounding whitespace and drop all-blank rows (S5, S6)."""
    filled = df.where(has_text(c for c in df.columns if c != "source_row_number"))  # a filter over stripped cells would strip them twice
    return _stripped(filled)[0]


#: Columns by whose hash the rows of a raw table are kept in buckets: what names a row while its other cells are edited.
ROW_KEYS = {"transaction_log": ["timestamp"], "vendor_rates": ["effective_from", "vendor_name"], "customer_rates": ["effective_from", "customer_name"]}


def load_tab(df: DataFrame, tab: str, path: str, only: Sequence[int] | None = None) -> dict[str, int]:
    """Write a tab's rows in one pass, blank rows beside the others (``rejected=true``); returns ``rows`` and ``blank_rows``.

    ``only``: the buckets to replace.  The counts are observed while the rows are
    written, so neither needs a second scan.
    """
    stripped, blank = _stripped(df)
    rows = buckets.with_bucket(stripped.withColumn("rejected", blank), ROW_KEYS[tab])
    if only is not None:
        rows = rows.where(F.col(buckets.BUCKET).isin([int(b) for b in only]))
    seen = Observation(f"load-{tab}")
    rows = rows.observe(seen, F.count_if(~F.col("rejected")).alias("rows"), F.count_if("rejected").alias("blank_rows"))
    rows.hint("rebalance", buckets.BUCKET, "rejected").write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if only is None else "dynamic").partitionBy("rejected", buckets.BUCKET).parquet(path)
    try:
        return {k: v or 0 for k, v in seen.get.items()}
    except Py4JJavaError:  # a relation known to be empty is planned away, and its metrics with it
        return {"rows": 0, "blank_rows": 0}


def loaded(spark: SparkSession, path: str, columns: Sequence[str], rejected: bool = False, live: Sequence[int] | None = None) -> DataFrame:
    """What ``load_tab`` wrote: the rows, or the rejected ones; ``live``: its non-empty buckets."""
    cells = ", ".join(f"{c} {'long' if c == 'source_row_number' else 'string'}" for c in columns)
    df = spark.read.schema(f"{cells}, rejected boolean, bucket int").parquet(path).where(F.col("rejected") == rejected)
    df = df if live is None else df.where(F.col(buckets.BUCKET).isin([int(b) for b in live]))
    return df.select(*columns)


def header_findings(spark: SparkSession, found: Sequence[str], column_map: Mapping[str, str], tab: str) -> DataFrame:
    """(rule_id, severity, sheet_tab, detail): headers of the contract that are missing, and those that it does not know."""
    stripped = [h.strip() for h in found]
    rows = [("ingest_schema_column_missing", "error", tab, h) for h in column_map if h not in stripped]
    rows += [("ingest_schema_extra_column", "warning", tab, h) for h in stripped if h and h not in column_map]
    return spark.createDataFrame(rows, "rule_id string, severity string, sheet_tab string, detail string")


def export_headers(spark: SparkSession, path: str, fmt: str) -> list[str]:
    """The headers of an export: the first record of a CSV file, the keys of all JSON lines, the columns of a parquet file."""
    if fmt == "csv":
        head = spark.read.option("header", False).option("multiLine", True).option("escape", '"').csv(path).first()
        return [h or "" for h in head] if head else []
    if fmt == "json":
        return sorted({r.key.strip() for r in spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("key")).distinct().collect()})
    return spark.read.parquet(path).columns


def ingest_findings(spark: SparkSession, tab: str, metrics: Mapping[str, int], rejected: DataFrame) -> DataFrame:
    """(rule_id, severity, sheet_tab, detail): one row per rejected blank row, one if the sheet has no other row."""
    blank = rejected.select(F.lit("ingest_row_empty").alias("rule_id"), F.lit("warning").alias("severity"), F.lit(tab).alias("sheet_tab"),
                            (F.col("source_row_number").cast("string") if "source_row_number" in rejected.columns else F.lit(None).cast("string")).alias("detail"))
    if metrics["rows"]:
        return blank
    return blank.unionByName(spark.createDataFrame([("ingest_empty_sheet", "error", tab, None)], blank.schema))


def write_raw(tabs: Mapping[str, DataFrame], root: str) -> None:
    """Full replace of each raw table (S7); parquet under ``root/raw/<tab>``."""
    for name, df in tabs.items():
        df.write.mode("overwrite").parquet(f"{root}/raw/{name}")
