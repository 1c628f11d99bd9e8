"""Scoring, daily averages, ties and the merge."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsignal.functions import scalars
from barsignal.operators import merge, sentiment
from barsignal.plans.flows import sector_panel
from barsignal.plans.queries import lexicon_scorer


def test_softmax_sums_to_one_and_survives_large_logits(spark):
    df = spark.sql("select * from values (1000D, 1D, -1000D), (0D, 0D, 0D) as t(a, b, c)")
    p = [x.alias(n) for x, n in zip(scalars.softmax([F.col(c) for c in "abc"]), "xyz")]
    rows = df.select(*p).collect()
    assert tuple(rows[0]) == (1.0, 0.0, 0.0)
    assert rows[1].x == pytest.approx(1 / 3)


@pytest.mark.parametrize("scores, daily, article", [
    ((1, 1, 1), "positive", "negative"),
    ((0, 1, 1), "positive", "neutral"),
    ((1, 1, 0), "neutral", "negative"),
    ((1, 0, 1), "positive", "negative"),
    ((2, 1, 0), "negative", "negative"),
])
def test_tie_orders(spark, scores, daily, article):
    negative, neutral, positive = (F.lit(float(x)) for x in scores)
    row = spark.range(1).select(
        scalars.argmax_label(positive, neutral, negative).alias("d"),
        scalars.argmax_article([negative, neutral, positive]).alias("a"),
    ).first()
    assert (row.d, row.a) == (daily, article)


def test_lexicon_counts_whole_words_of_the_whole_text(spark):
    text = "Gain! gains, again. " + "filler " * 50_000 + "loss"
    df = spark.createDataFrame([(1, text), (2, None)], "No long, Lsa_summary string")
    rows = {r.No: r for r in sentiment.score_lexicon(df).collect()}
    weights = [math.exp(x) for x in (1, 1, 2)]
    assert rows[1].positive == pytest.approx(weights[2] / sum(weights))
    assert rows[2].predicted_sentiment == "neutral"


def test_batched_scorer_agrees_and_sees_batches_only(spark):
    texts = [(i, " ".join(["gain"] * (i % 4) + ["risk"] * (i % 3))) for i in range(300)]
    df = spark.createDataFrame(texts, "No long, Lsa_summary string").repartition(3)

    def make():
        score = lexicon_scorer()

        def checked(batch):
            assert 0 < len(batch) <= 16
            return score(batch)

        return checked

    got = sentiment.score_sentiment(df, make, batch_size=16).orderBy("No").toPandas()
    want = sentiment.score_lexicon(df).orderBy("No").toPandas()
    assert (got["predicted_sentiment"] == want["predicted_sentiment"]).all()
    np.testing.assert_allclose(got[["negative", "positive"]], want[["negative", "positive"]])


def test_label_order_is_the_scorers(spark):
    df = spark.createDataFrame([(1, "x")], "No long, Lsa_summary string")
    row = sentiment.score_sentiment(
        df, lambda: lambda texts: np.array([[0.7, 0.2, 0.1]] * len(texts)), labels=("positive", "negative", "neutral")
    ).first()
    assert (row.predicted_sentiment, row.positive) == ("positive", 0.7)


@pytest.fixture
def tables(spark):
    prices = spark.sql("""select * from values
        (date'2020-01-02', 'A', 1D), (date'2020-01-03', 'A', 2D), (date'2020-01-03', 'B', 3D), (date'2024-01-01', 'A', 4D)
        as t(Date, Stock_symbol, Close)""")
    news = spark.sql("""select * from values
        (1, date'2020-01-02', 'A'), (2, date'2020-01-02', 'A'), (3, date'2020-01-04', 'A'), (4, date'2024-01-01', 'A'), (5, date'2020-01-02', 'A')
        as t(No, Date, Stock_symbol)""")
    scores = spark.sql("""select * from values
        (1, 0.5D, 0.5D, 0D), (2, 0D, 0.5D, 0.5D), (3, 1D, 0D, 0D), (4, 1D, 0D, 0D), (9, 1D, 0D, 0D)
        as t(No, negative, neutral, positive)""")
    sectors = spark.sql("select 'A' as Stock_symbol, 'Tech' as category")
    return prices, news, scores, sectors


def test_merge(tables):
    rows = {(str(r.Date), r.Stock_symbol): r for r in sector_panel(*tables, "2020-01-01", "2023-12-31").collect()}
    assert len(rows) == 3
    first = rows["2020-01-02", "A"]
    assert (first.article_count, first.neutral, first.predicted_sentiment, first.has_news) == (2, 0.5, "neutral", True)
    quiet = rows["2020-01-03", "A"]  # the article of the 4th does not roll back or forward
    assert (quiet.article_count, quiet.neutral, quiet.positive, quiet.predicted_sentiment, quiet.has_news) == (0, 1.0, 0.0, "neutral", False)
    assert rows["2020-01-03", "B"].category == "Miscellaneous" and first.category == "Tech"


def test_repeated_article_numbers_multiply_and_are_reported(spark, tables):
    _, news, scores, _ = tables
    twice = scores.unionByName(scores.where("No = 1"))
    daily = sentiment.daily_sentiment(merge.news_x_sentiment(news, twice)).where("Date = '2020-01-02'").first()
    assert daily.article_count == 3
    assert [tuple(r) for r in merge.duplicate_articles(twice).collect()] == [(1, 2)]


def test_texts_stay_out_of_the_merge(spark, tables, tmp_path):
    prices, news, scores, sectors = tables
    news.withColumn("Article", F.lit("long")).write.parquet(str(tmp_path / "n"))
    plan = sector_panel(prices, spark.read.parquet(str(tmp_path / "n")), scores, sectors)._jdf.queryExecution().executedPlan().toString()
    assert "Article" not in plan
