"""Splittable scan of CSV files whose quoted fields span lines.

``multiLine`` reads a file in one task, whatever its size. Here the file is
read as lines, in ordinary splits. What a line does is a function of the state
it starts in (outside or inside a quoted field): it leaves the reader outside
or inside. There are four such functions: keep, swap, always outside, always
inside. They compose by a parity of swaps since the last constant one, so a
running sum and a running last value give every line's state: first per piece
of a split, then over the pieces of a file, then back to the lines. A piece is
a run of at most ``PIECE_LINES`` lines, so no task holds a whole split at once.

Quotes mean what they mean to the ordinary scan: a quote opens a field only at
its start; inside, a doubled quote is a character; a closing quote followed by
anything but a delimiter or the line's end makes the field an unquoted one up
to the next delimiter; other quotes are characters. A line ends in LF or CRLF,
which both read as LF inside a field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsignal.session import materialize

FILE, SPLIT, LINE = "_file", "_split", "_line"
PLACE = (FILE, SPLIT, "_row")
# Lines of a split whose states follow from one window.
PIECE_LINES = 1000
# Bits of a piece's number below the byte its split starts at.
PIECE_BITS = 21
# Characters of a record beyond which its open quote counts as a stray one.
MAX_RECORD = 16_000_000
DELIMITER = ","
REFUSED = "file string, line bigint, n_lines bigint, n_chars bigint, reason string"

# States within a line: at a field's start, in an unquoted field, in a quoted
# field, after a quote in a quoted field; and where a line starts.
_START, _PLAIN, _QUOTED, _CLOSING, _OUTSIDE, _INSIDE = range(6)


def _ends_inside(value: Column, start: int) -> Column:
    """Whether a line ends inside a quoted field, from the pieces between its quotes."""
    def step(state: Column, piece: Column) -> Column:
        # The quote before the piece; none stands before the first one.
        after = (
            F.when(state == _OUTSIDE, _START).when(state == _INSIDE, _QUOTED).when(state == _START, _QUOTED)
            .when(state == _QUOTED, _CLOSING).when(state == _CLOSING, _QUOTED).otherwise(_PLAIN)
        )
        return (
            F.when((after == _QUOTED) | (piece == ""), after).when(piece.endswith(DELIMITER), _START).otherwise(_PLAIN)
        )

    return F.aggregate(F.split(value, '"', -1), F.lit(start), step) == _QUOTED


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in their order within a piece of a split, with what they do from either state: _out and _in are 1 if they end inside."""
    quoted = F.col("value").contains('"')
    # The low 33 bits count the rows of a task: its lines keep their order. Pieces of a file are in the order of the file.
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    piece = F.floor(row / PIECE_LINES)
    lines = spark.read.option("lineSep", "\n").text(path).withColumn("value", F.regexp_replace("value", "\r$", "")).select(
        F.col("_metadata.file_path").alias(FILE),
        (F.shiftleft(F.col("_metadata.file_block_start"), PIECE_BITS) + piece).alias(SPLIT),
        F.monotonically_increasing_id().alias(LINE),
        "value",
        F.when(quoted, _ends_inside(F.col("value"), _OUTSIDE)).otherwise(F.lit(False)).cast("int").alias("_out"),
        F.when(quoted, _ends_inside(F.col("value"), _INSIDE)).otherwise(F.lit(True)).cast("int").alias("_in"),
    )
    in_split = Window.partitionBy(FILE, SPLIT).orderBy(LINE)
    return lines.withColumn("_row", F.row_number().over(in_split))


def _states(lines: DataFrame) -> DataFrame:
    """Lines with the state before and after them, their record and their number in the file.

    ``_home`` and ``_no`` name the record: the piece it starts in and its rank there.
    """
    constant, swap = F.col("_out") == F.col("_in"), F.col("_out") > F.col("_in")

    def carried(order, value: Column, swaps: Column) -> Column:
        """What the last constant leaves, corrected by the swaps before it."""
        return F.last(F.when(value.isNotNull(), (value + swaps) % 2), ignorenulls=True).over(order)

    in_split = Window.partitionBy(FILE, SPLIT).orderBy(LINE)  # the order of _row, in which the lines stand already
    upto = in_split.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_swaps", F.sum(swap.cast("int")).over(upto))
    lines = lines.withColumn("_known", carried(upto, F.when(constant, F.col("_out")), F.col("_swaps")))

    by_file = Window.partitionBy("_f").orderBy("_s")
    so_far = by_file.rowsBetween(Window.unboundedPreceding, 0)
    last = F.max_by(F.struct("_known", "_swaps"), "_row")
    splits = lines.groupBy(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s")).agg(F.count("*").alias("_lines"), last.alias("_end"))
    splits = splits.withColumn("_flips", F.sum(F.col("_end._swaps") % 2).over(so_far))
    leaves = carried(so_far, (F.col("_end._known") + F.col("_end._swaps")) % 2, F.col("_flips"))
    splits = splits.withColumn("_leaves", (F.coalesce(leaves, F.lit(0)) + F.col("_flips")) % 2).select(
        "_f", "_s", F.coalesce(F.lag("_leaves").over(by_file), F.lit(0)).alias("_enters"),
        (F.sum("_lines").over(so_far) - F.col("_lines")).alias("_lines_before"),
    )
    placed = (
        lines.join(splits, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s"))).drop("_f", "_s")
        .withColumn("_after", (F.coalesce("_known", "_enters") + F.col("_swaps")) % 2)
        .withColumn("_before", F.coalesce(F.lag("_after").over(in_split), F.col("_enters")))
        .withColumn("_record", F.sum((F.col("_before") == 0).cast("long")).over(upto))
        .withColumn("_number", F.col("_lines_before") + F.col("_row"))
    )
    # Lines before a split's first record start belong to the last record of
    # the nearest earlier split that starts one.
    owner = F.last(F.when(F.col("_records") > 0, F.struct("_s", "_records")), ignorenulls=True)
    owners = placed.groupBy(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s")).agg(F.max("_record").alias("_records")).select(
        "_f", "_s", owner.over(by_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_owner")
    )
    tail = F.col("_record") == 0
    return placed.join(owners, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s"))).select(
        *PLACE, "value", "_number", "_before", "_after",
        F.when(tail, F.col("_owner._s")).otherwise(F.col(SPLIT)).alias("_home"),
        F.when(tail, F.col("_owner._records")).otherwise(F.col("_record")).alias("_no"),
    )


RECORD = (FILE, "_home", "_no")


def _cut(lines: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """Lines with those in ``cuts`` made to end outside, and a mark on them."""
    if cuts is None:
        return lines.withColumn("_cut", F.lit(False))
    mine = cuts.select(*[F.col(c).alias(f"_cut{c}") for c in PLACE])
    met = F.col("_cut_row").isNotNull()
    joined = lines.join(mine, [F.col(c) == F.col(f"_cut{c}") for c in PLACE], "left").withColumn("_cut", met)
    kept = {c: F.when(met, 0).otherwise(F.col(c)) for c in ("_out", "_in")}
    return joined.withColumns(kept).drop(*[f"_cut{c}" for c in PLACE])


def _stray_quotes(lines: DataFrame, max_record: int) -> DataFrame:
    """Places of the lines whose open quote makes a record longer than ``max_record``: the last quote before its end."""
    opened = F.when((F.col("_after") == 1) & F.col("value").contains('"'), F.struct(*PLACE[1:]))
    long = _states(lines).groupBy(*RECORD).agg(F.sum(F.length("value") + 1).alias("_chars"), F.max(opened).alias("_last"))
    return long.where(F.col("_chars") > max_record).select(FILE, F.col(f"_last.{SPLIT}").alias(SPLIT), F.col("_last._row").alias("_row"))


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, max_record: int = MAX_RECORD,
) -> tuple[DataFrame, DataFrame]:
    """(records, refused) of the files at ``path``.

    A record longer than ``max_record`` characters is no record but a quote
    that was never closed: what stands up to that quote's line is refused, and
    the lines after it are read as records again. Refused rows name the file,
    the first line (from 1), lines, characters and the reason, so nothing is
    lost unseen, and no task ever holds more than ``max_record`` characters of
    a record. Files shorter than that are read without the search for such
    quotes.
    """
    lines = _lines(spark, path)
    longest = spark.read.format("binaryFile").load(path).agg(F.max("length")).collect()[0][0] or 0
    cuts = None
    while longest > max_record:
        found = materialize(_stray_quotes(_cut(lines, cuts), max_record), "stray_quotes")
        if found.isEmpty():
            break
        cuts = found if cuts is None else cuts.unionByName(found)
    states = _states(_cut(lines, cuts))
    if cuts is not None:
        states = states.join(
            cuts.withColumn("_stray", F.lit(True)).select(*PLACE, "_stray"), list(PLACE), "left"
        )
    else:
        states = states.withColumn("_stray", F.lit(None).cast("boolean"))
    part = F.struct(SPLIT, "_row", "value")
    stray = F.coalesce(F.bool_or("_stray"), F.lit(False))
    whole = states.groupBy(*RECORD).agg(
        F.array_sort(F.collect_list(part)).alias("_parts"), F.min("_number").alias("line"), stray.alias("_refused"),
    )
    refused = whole.where("_refused").select(
        F.col(FILE).alias("file"), "line", F.size("_parts").cast("long").alias("n_lines"),
        F.aggregate("_parts", F.lit(0), lambda n, p: n + F.length(p["value"]) + 1).cast("long").alias("n_chars"),
        F.format_string("quote not closed within %d characters", F.lit(max_record)).alias("reason"),
    )
    records = whole.where(~F.col("_refused") & ((F.col("line") > 1) | F.lit(not header)))
    text = F.array_join(F.transform("_parts", lambda p: p["value"]), "\n")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = (
        records.select(text.alias("_text"))
        .where(F.length("_text") > 0)
        .select(F.from_csv("_text", ddl, {"escape": '"', "multiLine": "true"}).alias("r"))
        .select("r.*")
    )
    return parsed, refused


def scan_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, max_record: int = MAX_RECORD) -> DataFrame:
    """The records alone; ``read_quoted_csv`` also tells what was refused."""
    return read_quoted_csv(spark, path, schema, header, max_record)[0]
