"""Per-symbol CSV files inside ZIP archives.

The members are listed first, from the archives' directories alone; each
member is then a task's unit of work, read by seeking, so one large archive
spreads over the cluster.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.functions.scalars import is_csv_member, path_stem
from barsignal.sources.files import PRICE_COLUMNS
from barsignal.sources.paths import arrow_path

LINES_PER_BATCH = 10_000


def _open_archive(path: str) -> zipfile.ZipFile:
    fs, name = arrow_path(path)
    return zipfile.ZipFile(fs.open_input_file(name))


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["archive"]:
            with _open_archive(path) as z:
                yield pd.DataFrame({"archive": path, "member": z.namelist()})


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            with _open_archive(row.archive) as z, z.open(row.member) as raw:
                text = io.TextIOWrapper(raw, encoding="utf-8", newline=None)
                lines: list[str] = []
                start = 0
                for line in text:
                    lines.append(line.rstrip("\n"))
                    if len(lines) == LINES_PER_BATCH:
                        yield _line_frame(row, start, lines)
                        start += len(lines)
                        lines = []
                if lines:
                    yield _line_frame(row, start, lines)


def _line_frame(row, start: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({
        "archive": row.archive,
        "member": row.member,
        "Stock_symbol": row.Stock_symbol,
        "line_no": range(start, start + len(lines)),
        "line": lines,
    })


def list_archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, Stock_symbol) of every CSV member below ``path``."""
    archives = spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"))
    members = archives.mapInPandas(_list_members, "archive string, member string")
    return members.where(is_csv_member(F.col("member"))).withColumn(
        "Stock_symbol", F.upper(path_stem(F.col("member")))
    )


def archive_ingest(
    spark: SparkSession, path: str, universe: DataFrame, columns=PRICE_COLUMNS, parallelism: int | None = None
) -> DataFrame:
    """Rows, as strings, of the members whose stem is a symbol of the universe.

    The members are dealt to ``parallelism`` tasks (default: the cluster's
    default parallelism), a number that adaptive execution leaves alone.
    """
    parallelism = parallelism or spark.sparkContext.defaultParallelism
    wanted = list_archive_members(spark, path).join(universe.select("Stock_symbol"), "Stock_symbol", "left_semi")
    lines = wanted.repartition(parallelism, "archive", "member").mapInPandas(
        _read_members, "archive string, member string, Stock_symbol string, line_no long, line string"
    )
    ddl = ", ".join(f"`{name}` string" for name in columns)
    return (
        lines.where((F.col("line_no") > 0) & (F.length("line") > 0))
        .select("Stock_symbol", F.from_csv("line", ddl, {"escape": '"'}).alias("r"))
        .select("r.*", "Stock_symbol")
    )
