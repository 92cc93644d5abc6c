"""Publication of a written folder: staged beside its target, then moved in by renames.

A job writes into ``_staging-<name>-<id>`` next to the target; nothing reads that folder, so a job that
fails or is killed in its write leaves the old layer whole. Then a small journal names the moves: the
whole folder, or each partition that the job carries. The old folder (or partition) is moved aside, the
new one moved in, and the old one removed. A publication that was cut off is finished from its journal
by :func:`recover`, which every writer and job calls first; each move can be repeated. Between the two
renames of a folder a reader may find it missing for a moment, but never half old and half new. On
stores without renames (object stores) a move is a copy by the file system, so there a move takes
time in proportion to its bytes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tiertrip.session import (list_path, make_dir, path_exists, read_text, remove_path, rename_path, write_text)


def _beside(path: str, kind: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}-{name}"


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a publication of ``path`` that was cut off; True if there was one."""
    text = read_text(spark, _beside(path, "publish"))
    if text is None:
        return False
    _finish(spark, path.rstrip("/"), json.loads(text))
    return True


def _finish(spark: SparkSession, path: str, journal: dict) -> None:
    staged, old, parts = journal["staged"], journal["old"], journal["partitions"]
    if parts is None:
        _swap(spark, staged, path, old)
    else:
        make_dir(spark, path)
        make_dir(spark, old)
        for part in parts:
            _swap(spark, f"{staged}/{part}", f"{path}/{part}", f"{old}/{part}")
    remove_path(spark, old)
    remove_path(spark, staged)
    remove_path(spark, _beside(path, "publish"))


def _swap(spark: SparkSession, new: str, path: str, old: str) -> None:
    if not path_exists(spark, new):  # moved before the cut
        return
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, new, path)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], partitions: bool = False) -> None:
    """Run ``write`` on a staging folder and publish what it wrote as ``path``: all of it in place of the
    old folder, or with ``partitions`` only the partitions that it holds."""
    recover(spark, path)
    path = path.rstrip("/")
    staged = f"{_beside(path, 'staging')}-{uuid.uuid4().hex}"
    try:
        write(staged)
    except BaseException:
        remove_path(spark, staged)
        raise
    parts = None
    if partitions and path_exists(spark, path):
        names = [p.rstrip("/").rsplit("/", 1)[-1] for p, _, _ in list_path(spark, staged)]
        parts = [n for n in names if "=" in n and not n.startswith(("_", "."))]
    journal = {"staged": staged, "old": f"{_beside(path, 'old')}-{uuid.uuid4().hex}", "partitions": parts}
    write_text(spark, _beside(path, "publish"), json.dumps(journal))
    _finish(spark, path, journal)
