"""Facts from Parquet footers: row counts and column types of every file, without reading a row.

One Spark job opens the footers, spread over the executors. Column types are those Spark would read:
from the schema that Spark's writer leaves in the footer, or else from the Parquet types. Where the
files lie in a store that tasks cannot open themselves, Spark's reader answers instead: one schema
for each folder, and a count by file name (which decodes no column).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiertrip.session import arrow_files, list_path

SCHEMA = "file string, folder string, bytes long, rows long, columns array<struct<name: string, type: string>>"
#: Footers opened by one task.
FILES_PER_TASK = 64


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(file, its folder, bytes) of the Parquet data files at or below ``path``, from a listing. Names that
    begin with ``_`` or ``.`` are not data, at any level below ``path``."""
    base, found = path.rstrip("/"), []
    for file, size, _ in list_path(spark, base, recursive=True):
        tail = file[file.find(base) + len(base):] if base in file else file.rsplit("/", 1)[-1]
        if not any(part.startswith(("_", ".")) for part in tail.split("/") if part):
            found.append((file, file.rsplit("/", 1)[0], size))
    return found


def _spark_type(field, physical: str) -> str:
    from pyspark.sql.pandas.types import from_arrow_type
    if physical == "INT96":  # written as instants
        return "timestamp"
    return from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()


def file_facts(path: str) -> tuple[int, list[dict[str, str]]]:
    """(rows, columns) of one file, from its footer."""
    import pyarrow.parquet as pq
    files, inner = arrow_files(path)
    with files.open_input_file(inner) as f:
        meta = pq.ParquetFile(f).metadata
    own = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if own:
        fields = T.StructType.fromJson(json.loads(own)).fields
        return meta.num_rows, [{"name": c.name, "type": c.dataType.simpleString()} for c in fields]
    leaves = {meta.schema.column(i).path.split(".")[0]: meta.schema.column(i).physical_type for i in range(meta.num_columns)}
    return meta.num_rows, [{"name": c.name, "type": _spark_type(c, leaves.get(c.name, ""))} for c in meta.schema.to_arrow_schema()]


def reachable(files: list[tuple[str, str, int]]) -> bool:
    """True when tasks can open these files themselves."""
    import pyarrow as pa
    try:
        for file, _, _ in files[:1]:
            arrow_files(file)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def footers(spark: SparkSession, files: list[tuple[str, str, int]]) -> DataFrame:
    """``file, folder, bytes, rows, columns`` of the given data files (:func:`data_files`)."""
    if not reachable(files):
        return _by_reader(spark, files)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            facts = [file_facts(f) for f in b.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([n for n, _ in facts], pa.int64()),
                 pa.array([c for _, c in facts], pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])))],
                names=["file", "folder", "bytes", "rows", "columns"])

    listed = spark.createDataFrame(files, "file string, folder string, bytes long")
    return listed.repartition(max(1, -(-len(files) // FILES_PER_TASK))).mapInArrow(run, SCHEMA)


def _by_reader(spark: SparkSession, files: list[tuple[str, str, int]]) -> DataFrame:
    folders: dict[str, list[str]] = {}
    for file, folder, _ in files:
        folders.setdefault(folder, []).append(file)
    columns = {d: [{"name": f.name, "type": f.dataType.simpleString()} for f in spark.read.parquet(names[0]).schema.fields]
               for d, names in folders.items()}
    counted = {}
    if files:
        empty = spark.read.schema(T.StructType([])).parquet(*[f for f, _, _ in files])
        name = F.col("_metadata.file_path").alias("file")
        counted = {r["file"]: r["n"] for r in empty.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(f, d, n, int(counted.get(f, 0)), columns[d]) for f, d, n in files]
    return spark.createDataFrame(rows, SCHEMA)


_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def widest(kinds: list[str]) -> str:
    """The one type that holds every value of the given types: the widest integer, ``double`` where any is
    a float beside other numbers, the decimal with room for both, a timestamp for dates beside
    timestamps, else text."""
    kinds = sorted(set(kinds) - {"void"})
    if len(kinds) < 2:
        return kinds[0] if kinds else "string"
    decimals = [tuple(map(int, k[8:-1].split(","))) for k in kinds if k.startswith("decimal(")]
    rest = [k for k in kinds if not k.startswith("decimal(")]
    if all(k in _WHOLE for k in rest):
        if not decimals:
            return max(rest, key=_WHOLE.index)
        whole = max([p - s for p, s in decimals] + [(3, 5, 10, 19)[_WHOLE.index(k)] for k in rest])
        scale = max(s for _, s in decimals)
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "string"
    if all(k in [*_WHOLE, "float", "double"] for k in rest):
        return "double"
    if set(kinds) <= {"date", "timestamp"} or set(kinds) <= {"date", "timestamp_ntz"}:
        return kinds[-1]
    return "string"
