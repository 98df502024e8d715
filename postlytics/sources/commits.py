"""Commit log of tables that are written batch by batch.

A batch is written to ``<table>/data/batch=<id>/attempt=<a>/`` and counts from the moment
``<table>/commits/<id>-<a>`` exists. An attempt without a commit is what a killed batch left, and
no reader sees it. Commits are empty files, so one listing tells all there is to read.

A compaction is an attempt that stands for all batches up to an id (``<table>/data/upto=<id>/attempt=<a>/``,
``<table>/compactions/<id>-<a>``); the newest one and the batches after it are the table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import hadoop_path


def attempt_path(table: str, batch: int, attempt: str) -> str:
    return f"{table}/data/batch={batch}/attempt={attempt}"


def _listed(spark: SparkSession, table: str, folder_name: str) -> dict[int, str]:
    fs, folder = hadoop_path(spark, f"{table}/{folder_name}")
    if not fs.exists(folder):
        return {}
    out: dict[int, str] = {}
    for status in fs.listStatus(folder):
        batch, _, attempt = status.getPath().getName().partition("-")
        if int(batch) in out:
            raise ValueError(f"batch {batch} of {table} was committed twice; two writers share this table")
        out[int(batch)] = attempt
    return dict(sorted(out.items()))


def committed(spark: SparkSession, table: str) -> dict[int, str]:
    """Attempt of every committed batch, by id."""
    return _listed(spark, table, "commits")


def committed_paths(spark: SparkSession, table: str) -> list[str]:
    """Folders that make up the table: the newest compaction and the batches after it."""
    compactions = _listed(spark, table, "compactions")
    upto = max(compactions, default=-1)
    paths = [compaction_path(table, upto, compactions[upto])] if compactions else []
    return paths + [attempt_path(table, batch, attempt) for batch, attempt in committed(spark, table).items() if batch > upto]


def is_committed(spark: SparkSession, table: str, batch: int) -> bool:
    fs, pattern = hadoop_path(spark, f"{table}/commits/{batch:012d}-*")
    found = fs.globStatus(pattern)
    return found is not None and len(found) > 0


def compaction_path(table: str, upto: int, attempt: str) -> str:
    return f"{table}/data/upto={upto}/attempt={attempt}"


def commit(spark: SparkSession, table: str, batch: int, attempt: str, folder: str = "commits") -> None:
    fs, path = hadoop_path(spark, f"{table}/{folder}/{batch:012d}-{attempt}")
    fs.mkdirs(path.getParent())
    if not fs.createNewFile(path):
        raise ValueError(f"{path} exists")
