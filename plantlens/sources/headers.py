"""CSV files by their header: as many scans as there are different headers."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files from this size on are opened one a task, which stops at the first rows; smaller ones are read whole, many a task.
LARGE_FILE = 1 << 26
# a file is never split, nor put into one task with another
_ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}


class Found(str):
    """The path of a file that a listing has named already."""


def same_path(path: str) -> str:
    """One form of the several that name a file (``file:/a``, ``file:///a``)."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def file_of_row() -> Column:
    """The row's file, as :func:`same_path` writes it."""
    return F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/")


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The file at ``path``, or the files of a folder but for hidden ones."""
    if isinstance(path, Found):
        return [path]
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(at) if f.isFile()]
    shown = [f for f in found if not f.getName().startswith(("_", "."))]
    return sorted(same_path(fs.makeQualified(f).toString()) for f in shown)


def find_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> list[str]:
    """All files under ``root`` that are not empty, by name; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return sorted(Found(r[0]) for r in listed.load(root).select(file_of_row()).collect())


def _first_row(batches):
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _names(line: str) -> tuple[str, ...]:
    """Column names of a header line; a repeated name gets its place, so that all differ."""
    seen, names = set(), []
    for i, name in enumerate(next(csv.reader([line.removeprefix("﻿")]), [])):
        name = name if name and name.lower() not in seen else f"{name}#{i}"
        seen.add(name.lower())
        names.append(name)
    return tuple(names)


def _first_lines(spark: SparkSession, paths: list[str]) -> list:
    """(path, first line) of each file that is not empty."""
    size = F.col("_metadata.file_size")
    line = F.substring_index(F.substring_index("value", "\n", 1), "\r", 1)
    whole = spark.read.text(paths, wholetext=True).where((size < LARGE_FILE) & (F.length("value") > 0))
    rows = whole.select(file_of_row().alias("path"), line.alias("value")).collect()
    seen = {r["path"] for r in rows}
    rest = [p for p in paths if same_path(p) not in seen]
    if not rest:
        return rows
    kept = {k: spark.conf.get(k) for k in _ONE_FILE_A_TASK}
    try:
        for k, v in _ONE_FILE_A_TASK.items():
            spark.conf.set(k, v)
        lines = spark.read.text(rest).select(file_of_row().alias("path"), "value")
        return rows + lines.mapInArrow(_first_row, lines.schema).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def header_groups(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header. One job reads the files, many a task, and keeps their first lines; another reads
    the large ones, a task a file, which stops at its first rows. The driver gets one line a file. Empty
    files are left out."""
    if not paths:
        return {}
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(_first_lines(spark, paths)):
        groups.setdefault(_names(row["value"]), []).append(row["path"])
    return groups


def scan(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """The files of one header, all columns as text; unused ones are pruned."""
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in header)
    return spark.read.schema(schema).csv(paths, header=True)


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
