"""Fixtures of odd rows and brute-force versions that the operator tests share."""

import os
import random
import re

import duckdb

from tests.conftest import SF001, SF01

WORD = re.compile("[^\x20\x09-\x0D]+")
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, shard string, "
              "size string, `row` string, `a.b` string, found string, fp string, copies string, h string")


def prose(seed, n=120):
    rng = random.Random(seed)
    vocab = ["the", "river", "stone", "walks", "under", "bright", "evening", "paper", "garden", "slowly", "window",
             "carries", "letters", "toward", "mountain", "quiet", "market", "and", "with", "people"]
    return " ".join(rng.choice(vocab) for _ in range(n)) + "."


def odd_rows():
    """NULLs in every column, empty and blank texts, repeated rows, one id with two texts, long texts."""
    more = ("x",) * 9
    long_run = "7" * 60_000 + "a" * 60_000 + "@" * 50
    return [
        (None, None, None, None, None, *[None] * 9), (1, None, "en", "s1", 0, *more), (2, "", "en", "s1", 0, *more),
        (3, " \n\t \n", "en", None, 4, *more), (4, "hello", None, "s2", 5, *more), (4, "hello", None, "s2", 5, *more),
        (5, prose(1), "en", "s2", 1, *more), (6, prose(1), "en", "s2", 1, *more), (6, prose(1), "en", "s2", 1, *more),
        (7, prose(2), "en", "s3", 1, *more), (7, prose(3), "de", "s3", 1, *more),
        (8, long_run, "de", "s3", 1, *more), (9, prose(4, 20_000), "de", "s1", 1, *more),
        (None, prose(5), "en", None, 1, *more), (None, prose(5), "en", None, 1, *more),
        (10, "\x00\x1f \U0001f600 1234567890 é" + " x" * 30, "fr", "\U0001f600", 1, *more),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def duck(sf_dir=SF001):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def table(sf_dir, sql):
    return duck(sf_dir).sql(sql).fetchall()


__all__ = ["SF001", "SF01", "WORD", "duck", "empty_docs", "odd_docs", "odd_rows", "prose", "table"]
