"""Article scoring and daily sentiment."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.functions.scalars import SENTIMENT_LABELS, argmax_article, argmax_label, softmax

BATCH_SIZE = 64

# A scorer turns a list of texts into an (n, labels) array of probabilities.
Scorer = Callable[[Sequence[str]], np.ndarray]

# Word lists of the built-in lexicon scorer; both are parameters of it.
POSITIVE_WORDS = (
    "good", "great", "gain", "gains", "growth", "profit", "strong", "rise", "rises", "beat", "upgrade", "record", "up",
)
NEGATIVE_WORDS = (
    "bad", "worthless", "loss", "losses", "decline", "weak", "fall", "falls", "miss", "downgrade", "risk", "down", "no",
)


def score_lexicon(
    df: DataFrame,
    id_col: str = "No",
    text_col: str = "Lsa_summary",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    """Scores from word counts over the whole text, without leaving the JVM.

    The logits are the two counts and, for neutral, one; a missing text has
    no words.
    """
    words = F.split(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z]+", " "), " ")

    def hits(lexicon: Sequence[str]):
        return F.size(F.filter("_words", lambda word: word.isin(*lexicon))).cast("double")

    logits = [hits(negative), F.lit(1.0), hits(positive)]
    counted = df.select(F.col(id_col), words.alias("_words")).select(
        id_col, *[x.alias(f"_{name}") for name, x in zip(SENTIMENT_LABELS, logits)]
    )
    scores = softmax([F.col(f"_{name}") for name in SENTIMENT_LABELS])
    return counted.select(id_col, *[s.alias(n) for n, s in zip(SENTIMENT_LABELS, scores)]).withColumn(
        "predicted_sentiment", argmax_article([F.col(n) for n in SENTIMENT_LABELS])
    )


def score_sentiment(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    id_col: str = "No",
    text_col: str = "Lsa_summary",
    labels: Sequence[str] = SENTIMENT_LABELS,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Scores from any model, in batches of ``batch_size`` texts.

    ``make_scorer`` runs once per task, so a model loads once per task and
    never on the driver. ``labels`` names the scorer's columns in its order;
    take them from the model's own configuration.
    """
    id_type = dict(df.dtypes)[id_col]
    names = list(labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for frame in batches:
            scorer = scorer or make_scorer()
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start:start + batch_size]
                scores = np.asarray(scorer(part[text_col].fillna("").tolist()), dtype="float64")
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), **{n: scores[:, i] for i, n in enumerate(names)}})

    schema = ", ".join([f"`{id_col}` {id_type}", *[f"`{n}` double" for n in names]])
    scored = df.select(id_col, text_col).mapInPandas(run, schema)
    return scored.withColumn("predicted_sentiment", argmax_article([F.col(n) for n in names], tuple(names)))


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("predicted_sentiment").count()


def daily_sentiment(articles: DataFrame) -> DataFrame:
    """Average probabilities, article count and label per symbol and day."""
    return (
        articles.groupBy("Date", "Stock_symbol")
        .agg(
            *[F.avg(name).alias(name) for name in SENTIMENT_LABELS],
            F.count("No").alias("article_count"),
        )
        .withColumn("predicted_sentiment", argmax_label(F.col("positive"), F.col("neutral"), F.col("negative")))
    )
