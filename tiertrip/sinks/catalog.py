"""Register written layers as catalog tables so SQL users query them by name."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tiertrip.session import list_path

#: Partitions added or dropped by one statement.
BATCH = 200
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(spark: SparkSession, database: str, table: str, path: str, partitioned: bool = False,
                   csv_schema: str | None = None) -> str:
    """SNK-9: external table over ``path``: Parquet, or CSV with a header under ``csv_schema`` (DDL).

    A table that is there already at this place with these columns stays: only partitions that are new
    on storage are added, those that are gone are dropped, and new columns follow the old ones, so
    queries find the table at any time. A table at another place, or whose columns changed their type, is
    made anew under another name first and takes the old one's place (its files stay)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    full = f"{_ident(database)}.{_ident(table)}"
    if not spark.catalog.tableExists(full):
        _create(spark, full, path, partitioned, csv_schema)
    elif not _keep(spark, full, path, partitioned, csv_schema):
        other = f"{_ident(database)}.{_ident(table + '__next')}"
        spark.sql(f"DROP TABLE IF EXISTS {other}")
        _create(spark, other, path, partitioned, csv_schema)
        spark.sql(f"DROP TABLE {full}")
        spark.sql(f"ALTER TABLE {other} RENAME TO {full}")
    spark.catalog.refreshTable(full)
    return f"{database}.{table}"


def _create(spark: SparkSession, full: str, path: str, partitioned: bool, csv_schema: str | None) -> None:
    if csv_schema:
        spark.sql(f"CREATE TABLE {full} ({csv_schema}) USING csv OPTIONS (header 'true') LOCATION {_text(path)}")
    else:
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION {_text(path)}")
    if partitioned:  # partitions are found after creation; without that step the table shows no rows
        spark.catalog.recoverPartitions(full)


def _place(spark: SparkSession, full: str) -> str:
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
    return found.get("Location", "")


def _plain(path: str) -> str:
    return path.rstrip("/").removeprefix("file:").replace("///", "/")


def _keep(spark: SparkSession, full: str, path: str, partitioned: bool, csv_schema: str | None) -> bool:
    """Bring a table up to date in place; False if it has to be made anew."""
    if _plain(_place(spark, full)) != _plain(path):
        return False
    columns = spark.catalog.listColumns(full)
    keys = [c.name for c in columns if c.isPartition]
    if len(keys) > 1 or bool(keys) != partitioned:
        return False
    held = {c.name.lower(): c.dataType for c in columns if not c.isPartition}
    new = T.StructType.fromDDL(csv_schema) if csv_schema else spark.read.parquet(path).schema
    found = {f.name: f.dataType.simpleString() for f in new.fields if f.name not in keys}
    if {n: t for n, t in found.items() if n.lower() in held} != {n: held[n.lower()] for n in found if n.lower() in held} \
            or not held.keys() <= {n.lower() for n in found}:
        return False
    added = [f"{_ident(n)} {t}" for n, t in found.items() if n.lower() not in held]
    if added:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(added)})")
    if partitioned:
        known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        there = {p.rstrip("/").rsplit("/", 1)[-1] for p, _, _ in list_path(spark, path)}
        there = {p for p in there if "=" in p and not p.startswith(("_", "."))}
        _alter(spark, full, "ADD IF NOT EXISTS", sorted(there - known), " ")
        _alter(spark, full, "DROP IF EXISTS", sorted(known - there), ", ")
    return True


def _alter(spark: SparkSession, full: str, what: str, parts: list[str], between: str) -> None:
    from urllib.parse import unquote
    specs = []
    for part in parts:
        name, _, value = part.partition("=")
        specs.append(f"PARTITION ({_ident(unquote(name))} = {'NULL' if value == NO_VALUE else _text(unquote(value))})")
    for i in range(0, len(specs), BATCH):
        spark.sql(f"ALTER TABLE {full} {what} {between.join(specs[i:i + BATCH])}")
