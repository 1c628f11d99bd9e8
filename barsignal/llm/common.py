"""What the operators share: sessions, written tables, deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.session import configure, materialize

# Rows of an Arrow batch: documents may hold 20,000 words each.
BATCH_ROWS = 1024
SAMPLE_SEED = 7


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: small Arrow batches, settings of the library."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in the shared folder and scanned again: the lineage ends there."""
    return materialize(df, name)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores until no column of ``df`` has it, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold_of(key: str | Column, folds: int) -> Column:
    """crc32 of an id's text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(0)).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int, text: str = "text", key: str = "doc_id",
    classes: tuple | None = None,
) -> tuple[list[tuple[str, object]], dict]:
    """At most ``rows`` (text, label) pairs of labelled documents, by a hash of the id, and the rows of each label.

    ``keep`` is a condition on the key. With ``classes`` each of them gets an
    equal share of the rows. The bound is the caller's documented parameter;
    the rows taken do not depend on partitions or order. Several labels of an
    id count as its largest.
    """
    order = (F.xxhash64(F.col(key), F.lit(SAMPLE_SEED)), F.col(key))
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & keep).groupBy(key).agg(F.max(label).alias("_label"))
    if classes:
        parts = [known.where(F.col("_label") == c).orderBy(*order).limit(rows // len(classes)) for c in classes]
        ids = parts[0]
        for part in parts[1:]:
            ids = ids.union(part)
        counts = {r["_label"]: r["n"] for r in known.where(F.col("_label").isin(*classes)).groupBy("_label").agg(F.count("*").alias("n")).collect()}
    else:
        ids, counts = known.orderBy(*order).limit(rows), {}
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("_text"))
    found = texts.join(F.broadcast(ids), key).orderBy(*order, "_text").limit(rows)  # at most ``rows`` ids
    return [(r["_text"], r["_label"]) for r in found.select("_text", "_label").collect()], counts
