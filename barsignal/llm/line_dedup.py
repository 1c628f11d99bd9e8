"""Line dedup by winnowing over line hashes, in DataFrame operations only.

A document is the sequence of its non-blank lines. A window starts at every
line and is the shortest stretch of whole lines with at least ``min_words``
words (one long line is a window of its own). The smallest line hash of each
window, the last one on ties, is a fingerprint, so two documents that share
a window share its fingerprint. Windows whose fingerprint occurs once are
dropped at once; for the others the content decides: the first window of a
content stays, every later one is deleted, and the match is extended line by
line to both sides. To the left reach the lines that begin within
``min_words`` words before the window, to the right those that begin within
``min_words`` words after its end. A line on a side is deleted if the window
with the lines up to it has stood anywhere before: every earlier occurrence
counts, not only the first.

First means the smallest (doc_id, line); a run that repeats inside one
document is deleted there too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import free_names, shared

MIN_WORDS = 20


def _trimmed(line: Column) -> Column:
    return F.trim(line)


def line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """_doc, _copy (hash of the text), line (from 0), h, words: one row per non-blank line.

    Equal rows are one document. Words are separated by single spaces.
    """
    lines = docs.select(
        F.col(key).alias("_doc"), F.xxhash64(text).alias("_copy"), F.posexplode(F.split(F.col(text), "\n")).alias("line", "_l")
    )
    trimmed = lines.withColumn("_l", _trimmed(F.col("_l"))).where("_l <> ''")
    words = (F.length("_l") - F.length(F.replace("_l", F.lit(" "), F.lit(""))) + 1).cast("long")
    hashed = trimmed.select("_doc", "_copy", "line", F.xxhash64("_l").alias("h"), words.alias("words"))
    return hashed.repartition("_doc", "_copy").groupBy("_doc", "_copy", "line").agg(F.first("h").alias("h"), F.first("words").alias("words"))


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Complete windows: their lines' hashes, their fingerprint, what lies on either side."""
    order = Window.partitionBy("_doc", "_copy").orderBy("line")
    total = Window.partitionBy("_doc", "_copy")
    placed = lines.withColumn("_at", F.sum("words").over(order) - F.col("words")).withColumn("_all", F.sum("words").over(total))
    span = Window.partitionBy("_doc", "_copy").orderBy("_at")
    cell = F.struct("h", "line", F.col("_at").alias("at"))
    inside = F.collect_list(cell).over(span.rangeBetween(0, min_words - 1))
    # What begins within min_words of a line's end: a window's last line has its window's.
    placed = placed.withColumn("_next", F.collect_list(cell).over(span.rangeBetween(0, min_words)))
    placed = placed.withColumn("_next", F.coalesce(F.lead("_next").over(span), F.slice("_next", 1, 0)))
    around = placed.select(
        "_doc", "_copy", "line", "_at", "_all", inside.alias("_in"),
        F.min(F.struct("h", (-F.col("line")).alias("_n"))).over(span.rangeBetween(0, min_words - 1)).alias("_low"),
        F.collect_list(cell).over(span.rangeBetween(-min_words, -1)).alias("_left"),
        F.last("_next").over(span.rangeBetween(0, min_words - 1)).alias("right"),
    )
    complete = around.where(F.col("_at") + min_words <= F.col("_all"))
    return complete.select(
        "_doc", "_copy", "line", F.col("_low.h").alias("fingerprint"), (-F.col("_low._n")).alias("place"),
        F.transform("_in", lambda x: x["h"]).alias("content"), F.transform("_in", lambda x: x["line"]).alias("lines"),
        F.reverse("_left").alias("left"), "right",
    )


def _extended(side: str) -> Column:
    """A window with its next lines on a side, one after the other: hash of the whole, the line added last."""
    hashes = F.transform(side, lambda x: x["h"])
    return F.transform(side, lambda x, i: F.struct(
        F.xxhash64(F.lit(side), "content", F.slice(hashes, F.lit(1), i + 1)).alias("c"), F.array(x["line"]).alias("lines"),
    ))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _copy, gone): per document with later repeated runs, the lines to delete, ascending."""
    found = shared(windows(line_rows(docs, key, text), min_words), "line_windows")
    # Fingerprints are selected once per place, whatever the number of windows that select them.
    places = found.select("fingerprint", "_doc", "_copy", "place").distinct()
    common = shared(places.groupBy("fingerprint").agg(F.count("*").alias("_n")).where("_n > 1").select("fingerprint"), "fingerprints")
    whole = F.array(F.struct(F.xxhash64(F.lit("window"), "content").alias("c"), F.col("lines").alias("lines")))
    parts = F.concat(whole, _extended("left"), _extended("right"))
    runs = shared(found.join(common, "fingerprint").select("_doc", "_copy", "line", F.inline(parts)), "shared_runs")
    spot = F.struct("_doc", "_copy", "line")
    # Distinct rows of equal doc_id and text are one document, so spots are unique.
    firsts = shared(runs.groupBy("c").agg(F.count("*").alias("_n"), F.min(spot).alias("_first")).where("_n > 1").select("c", "_first"), "first_runs")
    later = runs.join(firsts, "c").where(~spot.eqNullSafe(F.col("_first")))
    return (
        later.select("_doc", "_copy", F.explode("lines").alias("line"))
        .groupBy("_doc", "_copy").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    )


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rid of later repeated runs, and n_lines, n_removed.

    n_lines counts non-blank lines. A text that loses lines is the rest of its
    lines joined by \\n; any other text stays as it is. A null text has no
    line, a null key sorts first, repeated rows get the same result. Columns
    named n_lines or n_removed are replaced.
    """
    copy_of, dup_doc, dup_copy, dup_lines = free_names(docs, "_copy_of", "_dup_doc", "_dup_copy", "_dup_lines")
    gone = repeated_lines(docs, min_words, key, text).toDF(dup_doc, dup_copy, dup_lines)
    base = docs.withColumn(copy_of, F.xxhash64(text))
    joined = base.join(gone, F.col(key).eqNullSafe(F.col(dup_doc)) & (F.col(copy_of) == F.col(dup_copy)), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(dup_lines, i)), "\n")
    counted = F.coalesce(F.size(F.filter(lines, lambda x: _trimmed(x) != "")), F.lit(0))
    return (
        joined.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(counted).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size(dup_lines), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col(dup_lines).isNull(), F.col(text)).otherwise(kept))
        .drop(copy_of, dup_doc, dup_copy, dup_lines)
    )
