"""Operator 7: mixing sources to target weights.  DataFrame and SQL functions only.

Temperature mixing: with token shares p, source weights are p^x / sum(p^x).
The exponent x in [0, 1] is bisected: the largest that reaches the target
entropy, but not below the smallest that keeps every source within
``max_repeats`` passes over its own tokens.  Sources need weight_i * budget
tokens; without a given budget it is the smallest one that uses every document
at least once, so nothing is dropped.

Realisation: a source's documents lie in a pseudo-random permutation made of
blocks (documents are dealt to blocks by a hash, blocks and the documents in
them are ordered by hashes).  A source gives whole passes plus the prefix of
its permutation that fills the remaining tokens; a prefix is found from block
sums and one block's documents, never by ordering a whole source.  The prefix
ends at one (block, document) key per source, so each document decides its own
copies by comparing keys: the texts are not shuffled.

Cases: a null source is a source of its own; null or empty text has no tokens
and its copies follow its place in the permutation.  If no source has tokens every
document has one copy.  Repeated ids lie at the same place.  Null ids are
allowed.  Columns of the input are kept untouched, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import core

WORD = r"[^\x20\x09-\x0D]+"
#: How far from the natural entropy (0) to the uniform one (1); passes over a source at most; seed of the permutation.
FLATTEN, MAX_REPEATS, SEED = 0.5, 4.0, "mix-1"
#: Documents of a permutation block on average.
BLOCK_DOCS = 4096
STEPS = 60


def _hash_key(*parts) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *parts).cast("binary"))


def _number(key: F.Column) -> F.Column:
    """A non-negative integer from the first eight hex digits."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def keyed(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(id, source, tokens, doc_key) of every document."""
    return docs.select(
        F.col(key).alias("id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        _hash_key(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("doc_key"),
    )


def _bisect(low: str, high: str, too_high: str) -> str:
    """SQL: halve [low, high] ``STEPS`` times, going below the middle ``x`` where ``too_high`` holds; a struct (lo, hi)."""
    return f"""aggregate(sequence(1, {STEPS}), named_struct('lo', {low}, 'hi', {high}),
        (s, i) -> transform(array((s.lo + s.hi) / 2), x -> if({too_high}, named_struct('lo', s.lo, 'hi', x), named_struct('lo', x, 'hi', s.hi)))[0])"""


#: SQL: entropy of the weights p^x; ``p`` is the array of distinct positive shares, each (v, number n of sources that have it).
_ENTROPY = "(aggregate(p, 0D, (a, s) -> a + s.n * pow(s.v, x), z -> ln(z)) - x * aggregate(p, 0D, (a, s) -> a + s.n * pow(s.v, x) * ln(s.v)) / aggregate(p, 0D, (a, s) -> a + s.n * pow(s.v, x)))"


def totals(sources: DataFrame) -> DataFrame:
    """One row: all tokens, and the array t of (v, n): n sources have v > 0 tokens each.

    Sources of equal tokens are one entry, so for N tokens the array has at most
    sqrt(2 N) entries (that many different totals sum to N) however many sources there are.
    """
    same = sources.where("tokens > 0").groupBy(F.col("tokens").alias("v")).agg(F.count("*").alias("n"))
    return same.agg(F.sum(F.col("v") * F.col("n")).alias("total"), F.array_sort(F.collect_list(F.struct("v", "n"))).alias("t"))


def exponent(sources: DataFrame, flatten: float, max_repeats: float) -> DataFrame:
    """One row: x, the sum of p^x, the largest share.  ``sources``: (source, tokens), one row per source."""
    row = totals(sources)
    row = row.select("total", F.expr("transform(t, s -> named_struct('v', s.v / total, 'n', s.n))").alias("p")).where("total > 0")
    row = row.withColumn("spread", F.expr("array_max(p).v / array_min(p).v"))
    row = row.withColumn("target", F.expr(f"transform(array(1D), x -> {_ENTROPY})[0] * {1 - flatten} + ln(aggregate(p, 0L, (a, s) -> a + s.n)) * {flatten}"))
    # entropy falls as x rises: above the wanted x it is too low
    row = row.withColumn("reach", F.expr(_bisect("0D", "1D", f"{_ENTROPY} < target") + ".lo"))
    # passes of the rarest source fall as x rises: below the wanted x they are too many
    row = row.withColumn("least", F.expr(_bisect("0D", "1D", f"pow(spread, 1 - x) <= {max_repeats}") + ".hi"))
    row = row.withColumn("x", F.expr(f"if(spread <= {max_repeats}, reach, greatest(reach, least))"))
    return row.select("x", "total", F.expr("aggregate(p, 0D, (a, s) -> a + s.n * pow(s.v, x))").alias("norm"), F.expr("array_max(p).v").alias("top"))


def plan(rows: DataFrame, flatten: float = FLATTEN, max_repeats: float = MAX_REPEATS, budget: float | None = None) -> DataFrame:
    """One row per source: share, weight, repeats (exact), full passes, number of blocks and the keys that end the prefix.

    ``rows`` is ``keyed`` output; the plan is written, its size is one row per source.
    """
    sources = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    found = exponent(sources, flatten, max_repeats).first()
    x, total, norm, top = found if found else (1.0, 1, 1.0, 1.0)
    share = F.col("tokens") / F.lit(total)
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(x)) / F.lit(norm)).otherwise(0.0)
    spend = F.lit(float(budget)) if budget is not None else F.pow(F.lit(top), F.lit(1 - x)) * F.lit(norm) * F.lit(total)
    solved = sources.select(
        "source", "tokens", share.alias("share"), weight.alias("weight"),
        F.when(F.col("tokens") > 0, F.round(weight * spend / F.col("tokens"), 9)).otherwise(1.0).alias("repeats"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS)).cast("long").alias("blocks"),
    ).withColumn("full", F.floor("repeats")).withColumn("rest", F.round((F.col("repeats") - F.col("full")) * F.col("tokens")))
    solved = core.write_stage(solved, "mix-weights")

    placed = rows.join(solved.select("source", "blocks", "rest"), rows.source.eqNullSafe(solved.source)).select(
        rows.source, "tokens", "doc_key", "rest", _block_key("blocks").alias("block_key"))
    blocks = placed.groupBy("source", "block_key", "rest").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("source").orderBy("block_key")
    blocks = blocks.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens"))
    last = blocks.where("before < rest").groupBy("source").agg(F.max(F.struct("block_key", "before")).alias("cut")).select("source", "cut.*")
    inside = placed.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source and p.block_key = l.block_key")).select("p.*", "l.before")
    order = Window.partitionBy("source", "block_key").orderBy("doc_key")
    inside = inside.withColumn("before", F.col("before") + F.sum("tokens").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens"))
    cut = inside.where("before < rest").groupBy("source").agg(F.max(F.struct("block_key", "doc_key")).alias("cut"))
    ended = solved.alias("s").join(cut.alias("c"), F.expr("s.source <=> c.source"), "left").select("s.*", "c.cut")
    return core.write_stage(ended, "mix-plan")


def _block_key(blocks: str) -> F.Column:
    return _hash_key(F.lit("block"), F.pmod(_number(F.col("doc_key")), F.col(blocks)).cast("string"))


def copies(keys: DataFrame, planned: DataFrame) -> DataFrame:
    """``keys`` with the source's plan and the copies of each document; the join broadcasts the plan when its files are small."""
    joined = keys.alias("k").join(planned.alias("s"), F.expr("k.source <=> s.source"))
    taken = F.coalesce(F.struct(_block_key("blocks").alias("block_key"), F.col("doc_key")) <= F.col("cut"), F.lit(False))
    return joined.select("k.*", "share", "weight", "repeats", _block_key("blocks").alias("block_key"), (F.col("full") + taken.cast("int")).cast("int").alias("copies"))


def ordered(chosen: DataFrame) -> DataFrame:
    """``copies`` output with ``position``: the documents before this one in a pass over its source.

    A pass permutes the source: blocks by their hashed keys, documents inside a block by
    theirs; copy 1, 2, ... of a document stands at this position of pass 1, 2, ....  Rows
    of one id share a position and are counted before they are shuffled; counts are summed
    within a block, and only blocks (one row each) in the order of a source.
    """
    places = chosen.groupBy("source", "block_key", "doc_key").agg(F.count("*").alias("docs"))
    running = lambda by, order: F.sum("docs").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("docs")
    blocks = places.groupBy("source", "block_key").agg(F.sum("docs").alias("docs"))
    starts = blocks.select("source", "block_key", running(["source"], "block_key").alias("start"))
    within = places.select("source", "block_key", "doc_key", running(["source", "block_key"], "doc_key").alias("place"))
    placed = within.alias("w").join(starts.alias("b"), F.expr("w.source <=> b.source and w.block_key = b.block_key")).select(
        "w.source", "w.doc_key", (F.col("start") + F.col("place")).alias("position"))
    return chosen.alias("r").join(placed.alias("p"), F.expr("r.source <=> p.source and r.doc_key = p.doc_key")).select("r.*", "position")


def mix(docs: DataFrame, flatten: float = FLATTEN, max_repeats: float = MAX_REPEATS, budget: float | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents, each row as often as its copies."""
    rows = core.write_stage(keyed(docs, key, source, text), "mix-rows")
    planned = plan(rows, flatten, max_repeats, budget)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(source).alias("source"),
                        _hash_key(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("doc_key"))
    out = copies(whole, planned).where("copies > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its source's share and weight, its copies in the mixture, its block and its position in each pass over the source."""
    rows = core.write_stage(keyed(core.read(spark, sf_dir, "documents"), "doc_id", "source", "text"), "mix-rows")
    out = ordered(copies(rows, plan(rows)))
    return out.select(F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), F.round("share", 9).alias("share"), F.round("weight", 9).alias("weight"), F.round("repeats", 6).alias("repeats"), "copies", "block_key", "position")


def _sql(documents: str = "documents", docs_only: bool = False) -> str:
    """DuckDB: the same mixture, the exponent bisected by a recursive query, the prefix by a running sum over each source."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS doc_key
  FROM {documents}
), s AS (
  SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, greatest(1, CAST(ceil(count(*) / {BLOCK_DOCS}.0) AS BIGINT)) AS blocks FROM d GROUP BY source
), p AS (
  SELECT source, tokens / (SELECT sum(tokens) FROM s) AS p FROM s WHERE tokens > 0
), goal AS (
  SELECT {1 - FLATTEN} * -sum(p * ln(p)) + {FLATTEN} * ln(count(*)) AS target, max(p) / min(p) AS spread, max(p) AS top FROM p
), halve(i, a, b, c, e) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN low THEN a ELSE (a + b) / 2 END, CASE WHEN low THEN (a + b) / 2 ELSE b END,
         CASE WHEN few THEN c ELSE (c + e) / 2 END, CASE WHEN few THEN (c + e) / 2 ELSE e END
  FROM (
    SELECT i, a, b, c, e,
      (SELECT ln(sum(pow(p, (a + b) / 2))) - (a + b) / 2 * sum(pow(p, (a + b) / 2) * ln(p)) / sum(pow(p, (a + b) / 2)) FROM p) < (SELECT target FROM goal) AS low,
      pow((SELECT spread FROM goal), 1 - (c + e) / 2) <= {MAX_REPEATS} AS few
    FROM halve WHERE i < {STEPS}
  )
), found AS (
  SELECT CASE WHEN spread <= {MAX_REPEATS} THEN a ELSE greatest(a, e) END AS x FROM halve, goal WHERE i = {STEPS}
), w AS (
  SELECT s.source, s.tokens, s.blocks, coalesce(p, 0) AS share,
         coalesce(pow(p, x) / (SELECT sum(pow(p, x)) FROM p), 0) AS weight,
         CASE WHEN s.tokens > 0 THEN round(pow((SELECT top FROM goal) / p, 1 - x), 9) ELSE 1 END AS repeats
  FROM s LEFT JOIN p ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN found
), r AS (
  SELECT d.doc_id, d.source, d.tokens, w.share, w.weight, w.repeats, round((w.repeats - floor(w.repeats)) * w.tokens) AS rest,
         md5('{SEED}|block|' || CAST(CAST('0x' || substr(doc_key, 1, 8) AS BIGINT) % w.blocks AS VARCHAR)) AS block_key, doc_key
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, source, tokens AS n_tokens, round(share, 9) AS share, round(weight, 9) AS weight, round(repeats, 6) AS repeats,
       CAST(floor(repeats) + CASE WHEN sum(tokens) OVER (PARTITION BY source ORDER BY block_key, doc_key) - tokens < rest THEN 1 ELSE 0 END AS INTEGER) AS copies,
       block_key, rank() OVER (PARTITION BY source ORDER BY block_key, doc_key) - 1 AS position
FROM r
"""


SQL = _sql()
