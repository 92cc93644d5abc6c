"""Hilbert-curve sharding: documents are ordered along a curve through four metadata dimensions and
the order is cut into runs, so that a file holds a small box of each dimension and can be skipped by
a filter on any of them.

Each dimension is quantised to ``LEVELS`` levels: source and language by the share of rows that sort
before their value (NULL last; a frequent value takes several levels' worth and the rest keep
theirs), text size by the power of two, id by equal widths between the least and the largest. The
65,536 cells of that grid are ordered by their Hilbert index, and the rows of a cell by a hash of
the id. Runs of the order are cut so that shard sizes in rows are at most one apart (law ``rows``).

The global position needs no global sort: rows are counted per cell, a cell with more than
``GROUP_ROWS`` rows is cut by hash into sub-groups, the counts are summed up in curve order (one
row per sub-group), and a window numbers the rows of each sub-group. So a hot source, a hot cell or
a large group of copies is spread, and a task holds about ``GROUP_ROWS`` rows of one group.

Edge cases. NULL text: size 16, CRC 0. NULL source, language: last level of their order; NULL id:
level 0, ordered last in its sub-group. Repeated rows get positions of their own. Fewer rows than
shards: the last shards are empty. Empty table: no rows. Columns named ``size``, ``text_crc32``,
``shard`` or ``slot`` in the input are replaced; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, stash

BITS = 4
LEVELS = 1 << BITS
GROUP_ROWS = 10_000
BROADCAST_PAIRS = 100_000


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index of a grid point on the Hilbert curve (Skilling's transform), for any number of axes.

    The walk over bits and axes is one fold that carries the axes as an array, so the expression
    stays small; it is meant for a table of distinct cells."""
    n = len(axes)
    x0 = F.array(*[a.cast("long") for a in axes])

    def put(x: Column, at: Column, value: Column) -> Column:
        return F.transform(x, lambda v, i: F.when(i == at, value).otherwise(v))

    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        q, i = s.getField("q"), s.getField("i")
        p = q - F.lit(1)
        first, here = x.getItem(0), F.element_at(x, i + 1)
        t = first.bitwiseXOR(here).bitwiseAND(p)
        flipped = put(x, F.lit(0), first.bitwiseXOR(p))
        swapped = put(put(x, F.lit(0), first.bitwiseXOR(t)), i, here.bitwiseXOR(t))
        swapped = F.when(i == 0, x).otherwise(swapped)
        return F.when(here.bitwiseAND(q) != 0, flipped).otherwise(swapped)

    x = F.aggregate(steps, x0, undo)
    gray = F.aggregate(F.array(*[F.lit(i) for i in range(1, n)]), x,
                       lambda a, i: put(a, i, F.element_at(a, i + 1).bitwiseXOR(F.element_at(a, i))))

    def twist(a: Column) -> Column:
        last = F.element_at(a, n)
        t = F.lit(0).cast("long")
        for b in range(bits - 1, 0, -1):
            t = t.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        return F.transform(a, lambda v: v.bitwiseXOR(t))

    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i + 1).alias("i"))
                       for b in range(bits - 1, -1, -1) for i in range(n)])

    def interleave(a: Column) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda h, p: h * 2 + F.call_function(
            "shiftright", F.element_at(a, p.getField("i")), p.getField("b")).bitwiseAND(F.lit(1)))

    # The axes are bound as the element of a one-element array, so that no step is written out twice.
    return F.transform(F.transform(F.array(gray), twist), interleave).getItem(0)


def _depth_levels(counts: DataFrame, name: str, total: int, out: str) -> DataFrame:
    """Level of each value: the share of rows whose value sorts before it."""
    per = counts.groupBy(name).agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.col(name).asc_nulls_last())
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.select(name, F.floor(before * LEVELS / F.lit(max(total, 1))).cast("int").alias(out))


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``size, text_crc32, shard, slot``."""
    made = ("size", "text_crc32", "shard", "slot")
    rest = [c for c in docs.columns if c.lower() not in made]
    text = col(text_col)
    rows = docs.select(
        F.struct(*[col(c) for c in rest]).alias("row"), col(id_col).cast("long").alias("id"),
        col(source_col).alias("source"), col(lang_col).alias("lang"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    total, low, high = rows.agg(F.count("*"), F.min("id"), F.max("id")).first()
    low, high = low or 0, high or 0
    step = max(1, (high - low) // LEVELS + 1)

    pairs = stash(rows.groupBy("source", "lang").agg(F.count("*").alias("n")), "pairs")
    levels = (pairs.alias("p")
              .join(_depth_levels(pairs, "source", total, "s").alias("s"), F.expr("p.source <=> s.source"))
              .join(_depth_levels(pairs, "lang", total, "l").alias("l"), F.expr("p.lang <=> l.lang"))
              .select(F.col("p.source").alias("source_"), F.col("p.lang").alias("lang_"), "s", "l"))
    if pairs.count() <= BROADCAST_PAIRS:
        levels = F.broadcast(levels)
    size_level = F.least(F.greatest(F.floor(F.log2("size")) - 4, F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    wide = "CAST({} AS DECIMAL(20, 0))"  # the difference of two ids can be past a bigint
    id_level = F.coalesce(F.expr(f"({wide.format('id')} - {wide.format(low)}) div {wide.format(step)}"), F.lit(0)).cast("int")
    gridded = rows.join(levels, F.expr("source <=> source_ AND lang <=> lang_")).withColumn(
        "cell", ((F.col("s") * LEVELS + F.col("l")) * LEVELS + size_level) * LEVELS + id_level)

    axes = [F.shiftright("cell", BITS * k).bitwiseAND(F.lit(LEVELS - 1)) for k in (3, 2, 1, 0)]
    cells = stash(gridded.groupBy("cell").agg(F.count("*").alias("n"))
                  .select(F.col("cell").alias("cell_"), hilbert_index(axes).alias("h"),
                          F.ceil(F.col("n") / GROUP_ROWS).alias("parts")), "cells")  # 65,536 rows at most
    key = F.md5(F.concat(F.lit("2:"), F.coalesce("id", F.col("text_crc32")).cast("string")).cast("binary"))
    draw = F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), 1)  # 31 bits
    placed = gridded.join(F.broadcast(cells), F.col("cell") == F.col("cell_")).withColumn("draw", draw).withColumn(
        "sub", F.floor(F.col("draw") * F.col("parts") / F.lit(float(1 << 31))))

    groups = placed.groupBy("h", "sub").agg(F.count("*").alias("n"))
    upto = Window.orderBy("h", "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = stash(groups.select(F.col("h").alias("h_"), F.col("sub").alias("sub_"),
                                 F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start")), "starts")
    within = Window.partitionBy("h", "sub").orderBy("draw", F.col("id").asc_nulls_last(), "text_crc32", "size",
                                                    F.xxhash64("row"))
    ranked = (placed.join(starts, (F.col("h") == F.col("h_")) & (F.col("sub") == F.col("sub_")))
              .withColumn("rank", F.col("start") + F.row_number().over(within) - 1))
    at = F.expr(f"(rank * {shards}L) div {max(total, 1)}L")
    ranked = ranked.withColumn("shard", at.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {total}L + {shards - 1}L) div {shards}L")
    return ranked.select(*[F.col("row").getField(c).alias(c) for c in rest], "size", "text_crc32", "shard",
                         (F.col("rank") - first).cast("long").alias("slot"))


def _hilbert_sql(axes: int = 4, bits: int = BITS) -> str:
    """CTEs from ``cells(cell)`` to ``curve(cell, h)``: one step of the transform in each."""
    names = [f"x{i}" for i in range(axes)]
    mask = LEVELS - 1
    first = ", ".join(f"(cell >> {bits * (axes - 1 - i)}) & {mask} AS x{i}" for i in range(axes))
    steps, last = [f"c0 AS (SELECT cell, {first} FROM cells)"], "c0"

    def step(changed: dict[str, str]) -> None:
        nonlocal last
        name = f"c{len(steps)}"
        cols = ", ".join(f"{changed[x]} AS {x}" if x in changed else x for x in names)
        steps.append(f"{name} AS (SELECT cell, {cols} FROM {last})")
        last = name

    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(axes):
            t = f"(xor(x0, x{i}) & {p})"
            step({"x0": f"CASE WHEN x{i} & {q} != 0 THEN xor(x0, {p}) ELSE xor(x0, {t}) END"}
                 | ({f"x{i}": f"CASE WHEN x{i} & {q} != 0 THEN x{i} ELSE xor(x{i}, {t}) END"} if i else {}))
    for i in range(1, axes):
        step({f"x{i}": f"xor(x{i}, x{i - 1})"})
    turn = "0"
    for b in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN x{axes - 1} & {1 << b} != 0 THEN {(1 << b) - 1} ELSE 0 END)"
    step({x: f"xor({x}, {turn})" for x in names})
    h = " + ".join(f"(((x{i} >> {b}) & 1) << {b * axes + axes - 1 - i})" for b in range(bits) for i in range(axes))
    return ",\n".join([*steps, f"curve AS (SELECT cell, {h} AS h FROM {last})"])


def oracle(shards: int = 40) -> str:
    """The same order by one global window, with CRC-32 by its table; for tables whose ids are not NULL."""
    level = lambda c, n: (f"{n} AS (SELECT {c}, (coalesce(sum(n) OVER (ORDER BY {c} NULLS LAST ROWS BETWEEN UNBOUNDED "  # noqa: E731
                          f"PRECEDING AND 1 PRECEDING), 0) * {LEVELS} // (SELECT count(*) FROM d))::BIGINT AS level "
                          f"FROM (SELECT {c}, count(*) AS n FROM d GROUP BY 1))")
    return f"""
WITH t AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc FROM range(256) r(n)),
d AS (
  SELECT doc_id, source, lang, octet_length(encode(coalesce(text, ''))) + 16 AS size, encode(coalesce(text, '')) AS b
  FROM documents),
e AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, size - 15), lambda i:
      ('0x' || hex(b[i : i]))::BIGINT)), lambda c, x: xor(c >> 8, t.crc[(xor(c, x) & 255) + 1])), 4294967295) AS crc
  FROM d, t),
{level("source", "sl")},
{level("lang", "ll")},
w AS (SELECT min(doc_id) AS low, greatest(1, (max(doc_id) - min(doc_id)) // {LEVELS} + 1) AS step FROM d),
f AS (
  SELECT doc_id, size, crc, ((sl.level * {LEVELS} + ll.level) * {LEVELS}
      + least(greatest(floor(log2(size))::BIGINT - 4, 0), {LEVELS - 1})) * {LEVELS} + (doc_id - w.low) // w.step AS cell,
    ('0x' || substr(md5('2:' || doc_id), 1, 8))::BIGINT >> 1 AS draw
  FROM e, w, sl, ll WHERE e.source IS NOT DISTINCT FROM sl.source AND e.lang IS NOT DISTINCT FROM ll.lang),
cells AS (SELECT DISTINCT cell FROM f),
{_hilbert_sql()},
g AS (SELECT *, row_number() OVER (ORDER BY h, draw, doc_id) - 1 AS rank, count(*) OVER () AS total FROM f JOIN curve USING (cell)),
s AS (SELECT *, rank * {shards} // total AS shard FROM g)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (rank - (shard * total + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s"""
