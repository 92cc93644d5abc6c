"""Parquet and JSON sinks.

Partitioned writes go through a ``REBALANCE`` on the partition column: AQE sizes the output
tasks and splits a hot partition value (a day or a rejection reason holding a third of the rows)
over several tasks instead of sending it to one, while keeping files per value bounded.

Every writer returns the number of rows it wrote. The count is an ``Observation`` placed after
any shuffle, so it is taken in the result stage, whose accumulator updates Spark applies exactly
once even when tasks or map stages are re-run after an executor loss. (Metrics observed *before*
a shuffle live in a map stage and can be counted twice when that stage is recomputed; callers
that use such metrics compare them with these exact counts.)
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiertrip.sinks.publish import publish


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics that are filled by whatever action runs ``df`` (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    return observed(df, name, rows=F.count(F.lit(1)))


#: Partitions that one write can count apart; beyond them only the total is known.
COUNTED_PARTITIONS = 20_000
_NO_DATE = -(1 << 31)
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def partition_key(df: DataFrame, column: str, kind: str) -> Column:
    """A partition value as a number: the day of a date, a 32-bit hash of anything else (two values of one
    hash are counted together)."""
    value = F.col(f"`{column}`").cast(kind)
    return F.coalesce(F.unix_date(value), F.lit(_NO_DATE)) if kind == "date" else F.hash(value)


def write_counted(df: DataFrame, path: str, column: str, dynamic: bool = False,
                  rebalance: bool = True) -> tuple[int, dict[int, int] | None]:
    """:func:`write_partitioned`, returning the rows written in all and for each partition by its
    :func:`partition_key` (None beyond 20,000 partitions). Both ride along the write: a histogram with a
    bin for each value is their exact count, taken after the shuffle."""
    key = partition_key(df, column, df.schema[column].dataType.simpleString())
    out = df.hint("rebalance", column) if rebalance else df
    out, obs = observed(out, f"write_{column}", rows=F.count(F.lit(1)),
                        parts=F.histogram_numeric(key.cast("double"), F.lit(COUNTED_PARTITIONS)))
    publish(df.sparkSession, path, lambda to: out.write.partitionBy(column).parquet(to), partitions=dynamic)
    found = obs.get
    bins = found["parts"] or []
    if len(bins) >= COUNTED_PARTITIONS:
        return int(found["rows"]), None
    return int(found["rows"]), {int(b["x"]): int(b["y"]) for b in bins}


#: Partitions that a task of an unshuffled write by month or table has open at once.
OPEN_FILES = 16


@contextmanager
def files_open(spark: SparkSession, n: int = OPEN_FILES) -> Iterator[None]:
    """Within it a partitioned write keeps a file open for each partition of a task, up to ``n`` of them, in
    place of sorting all the task's rows by partition (which takes the memory of the rows, or spills them).
    Rows of further partitions are sorted as before. The session's own setting is put back."""
    before = spark.conf.get(_OPEN, None)
    spark.conf.set(_OPEN, str(n))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN) if before is None else spark.conf.set(_OPEN, before)


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite",
                      dynamic: bool = False, rebalance: bool = True, few: bool = False) -> int:
    """SNK-1 / SNK-3: Hive-style partitioned Parquet. ``dynamic`` replaces only the partitions present. Both are
    staged and moved in (:mod:`tiertrip.sinks.publish`); mode ``append`` adds files in place. ``few`` says that
    the column has few values, so that no task has to sort (:func:`files_open`)."""
    out = df.hint("rebalance", column) if rebalance else df
    out, obs = _counted(out, f"write_{column}")

    def save(to: str) -> None:
        with files_open(df.sparkSession) if few else nullcontext():
            out.write.mode("append").partitionBy(column).parquet(to)

    if mode == "overwrite":
        publish(df.sparkSession, path, save, partitions=dynamic)
    else:
        save(path)
    return int(obs.get["rows"])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False) -> int:
    """SNK-2: unpartitioned Parquet, staged and moved in. ``rebalance`` lets AQE merge small output tasks into few files."""
    out, obs = _counted(df.hint("rebalance") if rebalance else df, "write_table")
    save = lambda to: out.write.mode("append").parquet(to)
    if mode == "overwrite":
        publish(df.sparkSession, path, save)
    else:
        save(path)
    return int(obs.get["rows"])


def json_document(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in column ``json``. NULL fields are written as ``null``, not left
    out, so every record has the same keys."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def write_json_document(df: DataFrame, path: str) -> int:
    """SNK-4: a one-row frame written as one JSON document."""
    out, obs = _counted(json_document(df).coalesce(1), "write_json")
    publish(df.sparkSession, path, lambda to: out.write.text(to))
    return int(obs.get["rows"])
