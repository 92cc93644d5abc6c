"""Mixing sources to target weights: whole copies plus one hash-seeded Bernoulli copy.

Words are summed per source (partial sums before the shuffle, so a source with a third of all rows
sends one number per task). Sources in code point order, NULL last, take the weights in turn and
share ``share`` times all words; a target stops at ``most`` times its source's words and the excess
goes to the others by weight. That level is found in one pass over the per-source table: with
sources ordered by cap / weight, it is the largest (budget - caps before) / (weights - weights
before). A document is emitted floor(target / source words) times, and once more if a uniform
number made from the MD5 of the seed and its id is below the fraction.

Everything is DataFrame functions. One row per source passes through one window task, and the
per-source table is broadcast when it has at most ``BROADCAST_SOURCES`` rows; above it the join is
salted, since one source may hold a third of all rows.

Edge cases. NULL or empty text: size 0, copied like the rest of its source. NULL source: a source
of its own, last in order. A source without a word, or an empty table: target 0, nothing taken.
Equal ids draw the same number (NULL ids draw by their text), so repeated rows are copied alike and
re-runs agree. Output columns replace input columns of the same name; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, col, fresh, stash

BROADCAST_SOURCES = 100_000
_SALTS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(ident: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    who = F.coalesce(ident.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), who).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``sizes(source, size)`` -> ``(source, source_size, target)``, one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")
    per = per.withColumn("turn", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    per = per.withColumn("cap", F.col("source_size") * F.lit(most))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "turn")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level)
    top = F.max("level").over(whole)
    return per.select("source", "source_size", F.least(F.col("cap"), top * F.col("weight")).alias("target"))


def with_targets(docs: DataFrame, targets: DataFrame, source: Column, ident: Column) -> DataFrame:
    """``docs`` with the columns of its source's row of ``targets`` (a written table)."""
    side = targets.select(F.col("source").alias("__source"), "source_size", "target")
    if targets.count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(side), source.eqNullSafe(F.col("__source"))).drop("__source")
    salt = fresh(docs, "salt")
    side = side.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return (docs.withColumn(salt, F.pmod(F.xxhash64(ident), F.lit(_SALTS)).cast("int"))
            .join(side, source.eqNullSafe(F.col("__source")) & (F.col(salt) == F.col("__at")))
            .drop("__source", "__at", salt))


def copies(source_size: Column, target: Column, draw: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def plan(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", **shares) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies, taken``."""
    sized = stash(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"),
                              word_count(col(text_col)).alias("size"),
                              uniform(col(id_col), col(text_col), seed).alias("draw")), "sizes")
    targets = stash(source_targets(sized, **shares), "targets")
    out = with_targets(sized, targets, F.col("source"), F.col("doc_id"))
    out = out.withColumn("copies", copies(F.col("source_size"), F.col("target"), F.col("draw")))
    return out.select("doc_id", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **shares) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as its source's rate says, columns unchanged."""
    sizes = docs.select(col(source_col).alias("source"), word_count(col(text_col)).alias("size"))
    targets = stash(source_targets(sizes, **shares), "targets")
    keep = [col(c) for c in docs.columns]
    inner = docs.select(F.struct(*keep).alias("row"), uniform(col(id_col), col(text_col), seed).alias("draw"))
    both = with_targets(inner, targets, F.col("row").getField(source_col), F.col("row").getField(id_col))
    times = copies(F.col("source_size"), F.col("target"), F.col("draw")).cast("int")
    return both.select("row", F.explode(F.array_repeat(F.lit(True), times))).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])


def oracle(seed: int = 42) -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 13))::BIGINT
      / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn
  FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(turn - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS level FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT max(level) FROM l) * weight) AS target FROM l),
r AS (
  SELECT doc_id, size, source_size, target, draw,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r"""
