"""Incremental pick-up of newly landed monthly files (the scheduled monthly ingest, re-aimed).

A Structured Streaming file source over the landing folder with ``trigger(availableNow=True)``: each
run takes every file that arrived since the last run (tracked in the checkpoint) and stops, so an
external monthly timer becomes a batch-sized streaming run. The stream itself carries only file names
(no content is read by it); ``foreachBatch`` lands the batch's deliveries with the batch reader, so
columns that only some months have are kept and their types resolved. A month that is delivered again
replaces its partition. Each landed batch leaves a record by its id below the checkpoint, so a batch
that Spark replays changes nothing. Stateless: no watermark or state store is needed.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiertrip.session import list_path, make_dir, read_text, write_text
from tiertrip.sinks.landing import land_months, pickup_months
from tiertrip.sources.months import MONTH_PATTERN

FILES_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _record(checkpoint_dir: str, batch_id: int) -> str:
    return f"{checkpoint_dir.rstrip('/')}/landed/{batch_id}.json"


def deliveries(files: list[str]) -> dict[str, list[str]]:
    """Delivery -> its files: a delivery is a monthly file or folder (the path up to and with the part that is
    named by month); files without a month in their path are deliveries of their own."""
    out: dict[str, list[str]] = {}
    for f in files:
        m = re.search(rf"^.*?/[^/]*{MONTH_PATTERN}", f)
        out.setdefault(m[0] if m else f, []).append(f)
    return out


def land_batch(spark: SparkSession, names: DataFrame, batch_id: int, bronze_dir: str, checkpoint_dir: str) -> int:
    """Land one micro-batch of file names; returns the rows it landed.

    A delivery named by month is landed whole (all files now in it, so a folder that is still filling up is
    completed by its next batch) and replaces that month; of several deliveries of one month the
    newest counts. Files that are not named by month add rows to the months of their pickups, each
    file once. The list of names is bounded by the files of one batch."""
    done = read_text(spark, _record(checkpoint_dir, batch_id))
    if done is not None:
        return 0  # replayed after its record was written
    seen = {r["path"]: r["modificationTime"] for r in names.select("path", "modificationTime").collect()}
    newest: dict[str, tuple] = {}
    loose = []
    for place, files in deliveries(sorted(seen)).items():
        month = re.search(MONTH_PATTERN, place)
        if month:
            newest[month[1]] = max(newest.get(month[1], (seen[files[0]], place)), (max(seen[f] for f in files), place))
        else:
            loose += files
    rows = land_months(spark, [place for _, place in newest.values()], bronze_dir) if newest else 0
    if loose:
        rows += pickup_months(spark, loose, bronze_dir, f"batch{batch_id}")
    make_dir(spark, f"{checkpoint_dir.rstrip('/')}/landed")
    write_text(spark, _record(checkpoint_dir, batch_id),
               json.dumps({"batch": batch_id, "rows": rows, "months": sorted(newest), "files": sorted(seen)}))
    return rows


def start_landing_stream(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an availableNow run that lands new files into bronze by ``source_month``."""
    reader = spark.readStream.format("binaryFile").schema(FILES_SCHEMA).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    names = reader.load(landing_dir).select("path", "modificationTime")  # the content is pruned

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(spark, batch, batch_id, bronze_dir, checkpoint_dir)

    return (names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def landed_batches(spark: SparkSession, checkpoint_dir: str) -> list[dict]:
    """The records of all landed batches, oldest first."""
    found = [p for p, _, _ in list_path(spark, f"{checkpoint_dir.rstrip('/')}/landed") if p.endswith(".json")]
    return sorted((json.loads(read_text(spark, p)) for p in found), key=lambda r: r["batch"])


def run_landing_once(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                     max_files_per_trigger: int | None = None) -> int:
    """Run one availableNow pass to completion; returns the rows that this run's own batches landed,
    from their records (other writers to bronze do not count)."""
    before = {r["batch"] for r in landed_batches(spark, checkpoint_dir)}
    start_landing_stream(spark, landing_dir, bronze_dir, checkpoint_dir, max_files_per_trigger).awaitTermination()
    return sum(r["rows"] for r in landed_batches(spark, checkpoint_dir) if r["batch"] not in before)
