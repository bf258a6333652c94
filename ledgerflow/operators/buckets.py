"""Tables kept in hash buckets, of which a new load rewrites only those that differ.

A row belongs to the bucket of its key's hash.  A bucket's digest is its row count, the
sum and the exclusive or of two hashes of its rows: it does not depend on row order, and
an edit in place, an added, a lost or a repeated row changes it.  Digests are one
aggregation with partial combine and as many rows as there are buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
BUCKET = "bucket"
DIGESTS = "bucket int, n long, hash_sum decimal(38,0), hash_xor long"


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(key, buckets))


def dealt(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows with those of a bucket together, so that what follows row by row need not be shuffled for a write."""
    return with_bucket(df, key, buckets).hint("rebalance", BUCKET)


def digests(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``DIGESTS`` of the non-empty buckets; NULL and blank cells differ."""
    cells = [c for c in (columns or df.columns) if c != BUCKET]
    marked = [x for c in cells for x in (F.col(c), F.col(c).isNull())]
    rows = df.select(bucket_of(key, buckets).alias(BUCKET), F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit(1), *marked).alias("b"))
    return rows.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"), F.bit_xor("b").alias("hash_xor"))


def changed(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(bucket, previous_rows, current_rows) of the buckets that differ; rows of an absent bucket count 0."""
    value = F.struct("n", "hash_sum", "hash_xor")
    p = previous.select(BUCKET, value.alias("p"))
    c = current.select(BUCKET, value.alias("c"))
    zero = F.lit(0).cast("long")
    return p.join(c, BUCKET, "full").where(~F.col("p").eqNullSafe(F.col("c"))).select(
        BUCKET, F.coalesce("p.n", zero).alias("previous_rows"), F.coalesce("c.n", zero).alias("current_rows"))


def write(df: DataFrame, path: str, only: Sequence[int] | None = None) -> None:
    """Write a table with a ``bucket`` column; ``only``: replace these buckets, leave the others as they are.

    A replaced bucket that has no rows any more keeps its old files; ``read`` leaves it out.
    """
    if only is not None:
        if not len(only):
            return
        df = df.where(F.col(BUCKET).isin([int(b) for b in only]))
    df.hint("rebalance", BUCKET).write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if only is None else "dynamic").partitionBy(BUCKET).parquet(path)


def read(spark: SparkSession, path: str, live: Sequence[int] | None = None) -> DataFrame:
    """The table; ``live``: its non-empty buckets."""
    df = spark.read.parquet(path)
    return df if live is None else df.where(F.col(BUCKET).isin([int(b) for b in live]))


class Versioned:
    """A bucketed table of which every change writes new versions of some buckets; nothing is overwritten.

    ``root/data/version=n/bucket=b`` holds a bucket as of version n; ``root/manifest/version=n``
    names each bucket's newest version and is written last, so a job that fails half way
    leaves the table as it was.  Reads are pruned to the newest version of each bucket.
    """

    def __init__(self, spark: SparkSession, root: str, columns: str, buckets: int = BUCKETS):
        self.spark, self.root, self.columns, self.buckets = spark, root, columns, buckets
        self.latest: list[int] = [0] * buckets
        self.version = 0

    def open(self) -> "Versioned":
        """Go on from the manifest on disk."""
        rows = self.spark.read.schema("bucket int, newest int, version int").parquet(f"{self.root}/manifest")
        self.version = rows.agg(F.max("version")).first()[0]
        for r in rows.where(F.col("version") == self.version).collect():
            self.latest[r.bucket] = r.newest
        return self

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The table, with its ``bucket`` column; ``only``: these buckets."""
        if not any(self.latest):
            return self.spark.createDataFrame([], f"{self.columns}, {BUCKET} int")
        df = self.spark.read.schema(f"{self.columns}, version int, {BUCKET} int").parquet(f"{self.root}/data")
        newest = F.element_at(F.array(*[F.lit(v) for v in self.latest]), F.col(BUCKET) + 1)
        df = df.where(F.col("version") == newest)
        if only is not None:
            df = df.where(F.col(BUCKET).isin([int(b) for b in only]))
        return df.drop("version")

    def write(self, df: DataFrame, only: Sequence[int] | None = None, is_dealt: bool = False) -> None:
        """Replace the buckets ``only`` (all of them if not given) by the rows of ``df``, which has a ``bucket`` column.

        ``is_dealt``: the rows of a bucket lie together already (``dealt``).
        """
        if only is not None and not len(only):
            return
        names = [c.split()[0] for c in self.columns.split(", ")]
        self.version += 1
        rows = df.select(*names, F.col(BUCKET).cast("int").alias(BUCKET))
        rows = rows if is_dealt else rows.hint("rebalance", BUCKET)
        rows.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.root}/data/version={self.version}")
        for b in range(self.buckets) if only is None else only:
            self.latest[int(b)] = self.version
        rows = [(b, v) for b, v in enumerate(self.latest)]
        self.spark.createDataFrame(rows, "bucket int, newest int").coalesce(1).write.parquet(f"{self.root}/manifest/version={self.version}")


class Appended:
    """A table to which loads only add rows: ``root/data/version=n`` holds those of the n-th, ``root/manifest`` names the finished ones.

    What is there is neither read nor written again, and rows are written where they lie.
    """

    def __init__(self, spark: SparkSession, root: str, columns: str):
        self.spark, self.root, self.columns = spark, root, columns
        self.versions: list[int] = []

    def open(self) -> "Appended":
        """Go on from the manifest on disk; a table without one is empty."""
        try:
            rows = self.spark.read.schema("version int").parquet(f"{self.root}/manifest")
        except AnalysisException:
            return self
        self.versions = sorted(r.version for r in rows.where(F.col("version").isNotNull()).collect())
        return self

    def read(self, versions: Sequence[int] | None = None) -> DataFrame:
        """The rows of all finished versions, or of those of them that are named."""
        found = [v for v in self.versions if versions is None or v in versions]
        if not found:
            return self.spark.createDataFrame([], self.columns)
        return self.spark.read.schema(self.columns).parquet(*[f"{self.root}/data/version={v}" for v in found])

    def newest(self) -> DataFrame:
        """The rows of the last version, for a table that is written whole."""
        return self.read(self.versions[-1:])

    def append(self, df: DataFrame, version: int) -> DataFrame:
        """Write the rows as a new version, which is returned."""
        df.select(*[c.split()[0] for c in self.columns.split(", ")]).write.option("compression", "zstd").parquet(f"{self.root}/data/version={version}")
        self.spark.range(1).select(F.lit(version).alias("v")).coalesce(1).write.parquet(f"{self.root}/manifest/version={version}")
        self.versions.append(version)
        return self.read([version])


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote and nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def touched(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """The buckets of the rows' keys: at most ``buckets`` numbers."""
    return sorted(r.b for r in df.select(bucket_of(key, buckets).alias("b")).distinct().collect())
