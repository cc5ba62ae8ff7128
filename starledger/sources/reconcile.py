"""CSV folders whose files disagree on their header.

Spark reads a folder of CSV files by position under the first header it
meets, so a file with the same columns in another order gives wrong
values without an error.  Here every file's header is read first (one
task per file, which stops after the first line), files are grouped by
header, each group is scanned once under its own columns, and the groups
are united by name.  Columns are the same when they are equal after
trimming and in lower case.  :func:`header_report` tells which files
miss, move or add which columns.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BYTE_ORDER_MARK = chr(0xFEFF)

#: Per-session settings under which a scan has one task per file and hands rows over one by one.
_ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                    "spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}


@dataclass(frozen=True)
class HeaderGroup:
    """Files that share one header line."""

    columns: tuple[str, ...]     # as written, trimmed
    files: tuple[str, ...]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.lower() for c in self.columns)


def read_headers(spark: SparkSession, path, sep: str = ",", quote: str = '"') -> list[HeaderGroup]:
    """The headers of the files under ``path`` (folders, globs or files),
    files in path order, groups by their first file.  Files without a line
    are left out.  A header that names a column twice is an error."""
    apart = spark.newSession()
    for key, value in _ONE_FILE_A_TASK.items():
        apart.conf.set(key, value)

    def first_line(batches):
        for batch in batches:
            if batch.num_rows:
                line = batch.column(0)[0].as_py().removeprefix(BYTE_ORDER_MARK)
                columns = next(csv.reader([line], delimiter=sep, quotechar=quote), [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[c.strip() for c in columns]], pa.list_(pa.string())), batch.column(1).slice(0, 1)],
                    ["columns", "file"])
                return     # the rest of the file is not read

    lines = apart.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    heads = lines.mapInArrow(first_line, "columns array<string>, file string")
    # one row per header, with its files: what a scan of them holds on the driver anyway
    found = heads.groupBy("columns").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    groups = sorted((HeaderGroup(tuple(r["columns"]), tuple(r["files"])) for r in found), key=lambda g: g.files[0])
    for g in groups:
        twice = sorted({n for n in g.names if g.names.count(n) > 1})
        if twice:
            raise ValueError(f"{g.files[0]} names a column twice: {', '.join(twice)}")
    return groups


def canonical_columns(groups: list[HeaderGroup]) -> list[str]:
    """All columns: those of the first file, then others as they appear."""
    out: dict[str, str] = {}
    for g in groups:
        for name, column in zip(g.names, g.columns):
            out.setdefault(name, column)
    return list(out.values())


def literal_path(file: str) -> str:
    """A file's path as one that no reader takes for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", file)


def read_csv_reconciled(spark: SparkSession, path, groups: list[HeaderGroup] | None = None, sep: str = ",",
                        quote: str = '"', base_path: str | None = None, **options) -> DataFrame:
    """All files under ``path`` as text columns, by name: a column that a
    file does not have is null in its rows.  One scan per distinct header;
    with one header it is the plain scan of ``path``.  ``base_path`` keeps
    the columns of partition folders below it.  No file with a line gives
    an empty frame without columns."""
    groups = read_headers(spark, path, sep, quote) if groups is None else groups
    columns = canonical_columns(groups)
    known = {c.lower(): c for c in columns}
    reader = spark.read.options(header=True, sep=sep, quote=quote, **options)
    if base_path:
        reader = reader.option("basePath", base_path)
    out = None
    for g in groups:
        schema = StructType([StructField(known[n], StringType()) for n in g.names])
        files = path if len(groups) == 1 else [literal_path(unquote(f)) for f in g.files]
        part = reader.schema(schema).csv(files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], StructType([]))
    return out.select(*[f"`{c}`" for c in columns], *[f"`{c}`" for c in out.columns if c not in columns])


def header_report(spark: SparkSession, groups: list[HeaderGroup]) -> DataFrame:
    """One row per header and column of any header, first header first:
    ``header`` (number), ``files`` (how many), ``first_file``, ``column``,
    and ``state``: same, moved (another place than in the first header),
    missing, or extra (not in the first header)."""
    columns = canonical_columns(groups)
    rows = []
    for number, g in enumerate(groups, 1):
        for column in columns:
            name = column.lower()
            first = groups[0].names.index(name) if name in groups[0].names else None
            own = g.names.index(name) if name in g.names else None
            if own is None and first is None:
                continue
            state = "missing" if own is None else "extra" if first is None else "same" if own == first else "moved"
            rows.append((number, len(g.files), unquote(g.files[0]), column, state))
    return spark.createDataFrame(rows, "header int, files int, first_file string, column string, state string")
