"""Helpers shared by the text operators: written intermediates, hashing of ids, text in tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tiertrip.session import run_path

#: The word pattern of every operator that counts words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared working folder and read it back.

    Cuts lineage: a lost executor costs at most the tasks of one step, and Python work above
    the written table never runs twice. The folder is new for each call; ``tiertrip.session.clear_run``
    removes all of a run.
    """
    spark = df.sparkSession
    path = run_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its plain name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_remainder(ident: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def hash_share(key: Column, limit: int, rows: int, seed: int) -> Column:
    """True for about ``limit`` of ``rows`` rows, chosen by a hash of ``key``; for all of them when they
    fit. It depends on the key, the seed and the two counts, so every re-run takes the same rows."""
    if rows <= limit:
        return F.lit(True)
    share = int(limit / rows * (1 << 32))
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 32)) < F.lit(share)


def within(rows: list, most: int) -> list[int]:
    """Ids of ``rows`` (id, label, size) in their order, passing over each that would make more than ``most`` in
    all; the first of each label always."""
    total, seen, out = 0, set(), []
    for i, y, n in rows:
        if total + n <= most or y not in seen:
            out.append(i)
            total += n
        seen.add(y)
    return out
