"""The checked queries, over the driver's tables.

The stages hand written tables to one another, so the stand-ins for them are
written once per session in the shared folder and scanned by the queries.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.functions import scalars
from barsignal.operators import clean, eda, features, folds, labels, merge, metrics, models, panel, sentiment, zscore
from barsignal.plans import flows, standins
from barsignal.session import configure, materialize, work_dir
from barsignal.sources import archive, dims, files, quoted_csv, sinks

Query = Callable[[SparkSession, str], DataFrame]

START, END = "1996-01-01", "1999-12-31"
KEY = ("Stock_symbol", "Date")
PLACES = 6
# Averages of exact 128ths have short decimals: round beyond them, not at a tie.
PLACES_OF = dict.fromkeys(
    ("negative", "neutral", "positive", "Sent_Net", "Sent_MA5", "Sent_Mom5", "Sent_Lag3"), 12
)

# The walk-forward queries fit every sector and date with the reference's train
# length, depth and rounds. walk_forward_status has its test span too; in the
# others it is that of their SQL, which is longer and predicts each date once
# as well.
TRIAL = {"train_days": 252, "test_days": 504}

_REGISTRY: dict[str, Query] = {}
_WRITTEN: dict[tuple, DataFrame] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        _REGISTRY[name] = run
        return fn

    return add


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Stand-in tables ----------------------------------------------------------

def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.sector_panel(*[silver(spark, sf_dir, t) for t in ("prices", "news", "scores", "sectors")])


_BUILDERS: dict[str, Query] = {
    "prices": standins.prices,
    "news": standins.news,
    "scores": standins.article_sentiment,
    "sectors": standins.sectors,
    "raw_prices": standins.raw_prices,
    "panel": _panel,
    "features": lambda s, d: flows.labelled_features(silver(s, d, "panel")),
    # The exploration labels days on the adjusted close.
    "eda_features": lambda s, d: flows.labelled_features(silver(s, d, "panel"), price_col="Adj Close"),
}


def _model_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "model_set")
    table = flows.model_set(silver(spark, sf_dir, "panel"))
    sinks.write_model_set(table, path)
    return files.scan_parquet(spark, path, table.schema)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stage's output table, written on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        if name == "model_set":
            _WRITTEN[key] = _model_set(spark, sf_dir)
        else:
            _WRITTEN[key] = materialize(_BUILDERS[name](spark, sf_dir), name)
    return _WRITTEN[key]


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Any other result that several queries share in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_prediction(standins.predictions(spark, sf_dir))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold results of the synthetic predictions; fold k tests month k of 1996."""
    start = F.add_months(F.lit("1996-11-01").cast("date"), F.col("fold"))
    per_fold = standins.predictions(spark, sf_dir).groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"))
    return metrics.all_metrics(predictions(spark, sf_dir), ["fold"]).join(per_fold, "fold").withColumn("test_start", start)


def shown(df: DataFrame, *columns: str, places: int = PLACES, places_of: dict[str, int] = PLACES_OF) -> DataFrame:
    """Chosen columns with dates as text and doubles rounded, for comparison."""
    types = dict(df.dtypes)

    def cell(c: str) -> Column:
        x = F.col(f"`{c}`")
        if types[c] == "double":
            x = F.round(x, places_of.get(c, places))
        elif types[c] in ("date", "timestamp"):
            x = x.cast("date").cast("string")
        return x.alias(c)

    return df.select(*[cell(c) for c in (columns or df.columns)])


def _stack(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


# Sources and sinks --------------------------------------------------------

def _news_csv(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        path = work_dir(spark, "news_csv")
        standins.raw_news(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
        return path

    return once(spark, sf_dir, "news_csv", make)


def _news_shown(df: DataFrame) -> DataFrame:
    return df.select(
        "No", "Date", "Article_title", "Stock_symbol", "Url", "Publisher", "Author",
        F.length("Article").alias("article_length"), F.md5(F.col("Lsa_summary").cast("binary")).alias("summary_md5"),
    )


@query("scan_news_csv")
def _(spark, sf_dir):
    return _news_shown(files.scan_news_csv(spark, _news_csv(spark, sf_dir), split=False))


@query("scan_quoted_csv")
def _(spark, sf_dir):
    schema = files.strings(files.NEWS_COLUMNS)
    return _news_shown(quoted_csv.scan_quoted_csv(spark, _news_csv(spark, sf_dir), schema))


@query("scan_stray_quotes")
def _(spark, sf_dir):
    """Records among quotes that open nothing, and nothing refused."""
    path = work_dir(spark, "stray_quotes_csv")
    standins.stray_quotes(spark, sf_dir).write.text(path)
    found, refused = quoted_csv.read_quoted_csv(spark, path, files.strings(("id", "field", "text", "source")), header=False)
    lost = refused.agg(F.count(F.lit(1)).alias("refused"))
    return found.select("id", "field", F.md5(F.col("text").cast("binary")).alias("text_md5"), "source").crossJoin(lost)  # one row


@query("scan_price_csv")
def _(spark, sf_dir):
    path = work_dir(spark, "price_csv")
    raw = silver(spark, sf_dir, "raw_prices")
    raw.select(*[f"`{c}`" for c in files.PRICE_COLUMNS]).write.option("header", True).csv(path)
    scan = files.scan_price_csv(spark, f"{path}/*.csv").drop("Stock_symbol")
    return shown(clean.typed_prices(scan))


@query("symbol_from_path")
def _(spark, sf_dir):
    path = F.concat(F.lit("s3a://lake/full_history/"), F.lower("p_brand"), F.when(F.col("p_size") > 25, ".csv").otherwise(".txt"))
    parts = standins.table(spark, sf_dir, "part")
    return parts.select(path.alias("path")).distinct().select("path", scalars.symbol_from_path(F.col("path")).alias("symbol"))


@query("scan_parquet")
def _(spark, sf_dir):
    path = work_dir(spark, "by_symbol")
    sinks.write_by_symbol(silver(spark, sf_dir, "prices"), path)
    return shown(files.scan_parquet(spark, path).where("Stock_symbol = 'Brand#12'"), "Date", "Close", "Stock_symbol")


@query("sector_dim")
def _(spark, sf_dir):
    path = work_dir(spark, "sector_csv")
    silver(spark, sf_dir, "sectors").write.option("header", True).csv(path)
    return dims.scan_sector_dim(spark, path)


@query("universe_dim")
def _(spark, sf_dir):
    return dims.universe_dim(standins.table(spark, sf_dir, "part"), "p_brand")


def _sector_csv(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        path = work_dir(spark, "category_csvs")
        sinks.export_sector_csv(silver(spark, sf_dir, "panel"), path)
        return path

    return once(spark, sf_dir, "category_csvs", make)


@query("export_sector_csv")
def _(spark, sf_dir):
    written = spark.read.option("header", True).csv(_sector_csv(spark, sf_dir))
    return written.groupBy("sector", "category").agg(F.count(F.lit(1)).alias("rows"))


@query("scan_sector_csv")
def _(spark, sf_dir):
    schema = silver(spark, sf_dir, "panel").schema
    scan = files.scan_sector_csv(spark, f"{_sector_csv(spark, sf_dir)}/*", schema)
    return shown(scan, *KEY, "Close", "Volume", "positive", "article_count", "has_news", "category", places=8)


@query("archive_ingest")
def _(spark, sf_dir):
    path = work_dir(spark, "archives")
    standins.write_price_archives(silver(spark, sf_dir, "raw_prices"), path)
    universe = silver(spark, sf_dir, "sectors").select(F.upper("Stock_symbol").alias("Stock_symbol"))
    rows = archive.archive_ingest(spark, f"{path}/*.zip", universe)
    return shown(clean.typed_prices(rows), *KEY, "Close", "Volume")


@query("write_by_symbol")
def _(spark, sf_dir):
    path = work_dir(spark, "by_symbol")
    sinks.write_by_symbol(silver(spark, sf_dir, "prices"), path)
    return shown(files.scan_parquet(spark, path), *KEY, "Open", "High", "Low", "Close", "Volume")


@query("write_by_sector")
def _(spark, sf_dir):
    path = work_dir(spark, "by_sector")
    sinks.write_by_sector(silver(spark, sf_dir, "panel"), path)
    return shown(files.scan_parquet(spark, path), *KEY, "category", "Close", "article_count", "has_news")


@query("write_parquet")
def _(spark, sf_dir):
    path = work_dir(spark, "daily")
    sinks.write_parquet(_daily(spark, sf_dir), path)
    return shown(files.scan_parquet(spark, path), *KEY, "article_count", "predicted_sentiment")


@query("export_results_csv")
def _(spark, sf_dir):
    path = work_dir(spark, "results_csv")
    sinks.export_results_csv(results(spark, sf_dir).select("fold", "test_start", "n_test"), path)
    return spark.read.schema("fold int, test_start string, n_test bigint").option("header", True).csv(path)


# Cleaning -----------------------------------------------------------------

@query("drop_columns")
def _(spark, sf_dir):
    left = clean.drop_columns(standins.raw_news(spark, sf_dir))
    return left.withColumns({
        "Article": F.length("Article"), "Lsa_summary": F.md5(F.col("Lsa_summary").cast("binary")),
    })


@query("select_columns")
def _(spark, sf_dir):
    return clean.select_columns(standins.raw_news(spark, sf_dir)).select("No", F.length("Lsa_summary").alias("summary_length"))


@query("strip_names")
def _(spark, sf_dir):
    padded = silver(spark, sf_dir, "prices").withColumnsRenamed({"Open": " Open", "Volume": "Volume "})
    return shown(files.strip_names(padded), *KEY, "Open", "Volume")


@query("typed_prices")
def _(spark, sf_dir):
    return shown(clean.typed_prices(silver(spark, sf_dir, "raw_prices")), *KEY, "Open", "Close", "Adj Close", "Volume")


@query("typed_news")
def _(spark, sf_dir):
    return shown(clean.typed_news(standins.raw_news(spark, sf_dir)), "No", "Date", "Stock_symbol", "Url")


@query("in_universe")
def _(spark, sf_dir):
    wanted = [f"Brand#{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3, 4, 5)]
    return shown(clean.in_universe(silver(spark, sf_dir, "news"), wanted), "No", "Stock_symbol")


@query("semi_universe")
def _(spark, sf_dir):
    return shown(clean.semi_universe(silver(spark, sf_dir, "news"), silver(spark, sf_dir, "sectors")), "No", "Stock_symbol")


@query("drop_any_null")
def _(spark, sf_dir):
    typed = clean.typed_news(clean.drop_columns(standins.raw_news(spark, sf_dir)))
    return shown(clean.drop_any_null(typed), "No", "Date", "Stock_symbol", "Url")


@query("drop_null_subset")
def _(spark, sf_dir):
    return shown(clean.drop_null_subset(silver(spark, sf_dir, "features"), ["Return_20d", "Vol_20d"]), *KEY, "Label")


@query("date_range")
def _(spark, sf_dir):
    return shown(clean.date_range(silver(spark, sf_dir, "prices"), START, END), *KEY, "Close")


@query("eq_filter")
def _(spark, sf_dir):
    return shown(clean.eq_filter(silver(spark, sf_dir, "panel"), category="Sector_3", has_news=True), *KEY, "article_count")


@query("clean_news")
def _(spark, sf_dir):
    articles, _ = flows.ingest_news(spark, _news_csv(spark, sf_dir), silver(spark, sf_dir, "sectors"))
    return shown(articles, "No", "Date", "Stock_symbol", "Url")


@query("clean_prices")
def _(spark, sf_dir):
    raw = silver(spark, sf_dir, "raw_prices")
    return shown(flows.clean_prices(raw), *KEY, "Open", "High", "Low", "Close", "Adj Close", "Volume")


@query("row_counts")
def _(spark, sf_dir):
    counts = [
        eda.row_count(silver(spark, sf_dir, t)).select(F.lit(t).alias("stage"), "rows") for t in ("prices", "news", "scores", "panel")
    ]
    return _stack(*counts)


# Sentiment and merge ------------------------------------------------------

def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.news_x_sentiment(silver(spark, sf_dir, "news"), silver(spark, sf_dir, "scores"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.daily_sentiment(_articles(spark, sf_dir))


SCORES = ("negative", "neutral", "positive")


@query("news_x_sentiment")
def _(spark, sf_dir):
    return shown(_articles(spark, sf_dir), "No", *KEY, *SCORES, "predicted_sentiment", places=8)


@query("duplicate_articles")
def _(spark, sf_dir):
    return merge.duplicate_articles(silver(spark, sf_dir, "news"))


@query("sentiment_distribution")
def _(spark, sf_dir):
    articles = _articles(spark, sf_dir)
    return _stack(*[
        sentiment.sentiment_distribution(df).withColumn("stage", F.lit(stage))
        for stage, df in (("all", articles), ("dated", clean.date_range(articles, START, END)))
    ])


@query("daily_sentiment")
def _(spark, sf_dir):
    return shown(_daily(spark, sf_dir), *KEY, *SCORES, "article_count", "predicted_sentiment", places=8)


@query("price_x_sentiment")
def _(spark, sf_dir):
    joined = merge.price_x_sentiment(silver(spark, sf_dir, "prices"), _daily(spark, sf_dir))
    return shown(joined, *KEY, "Close", "positive", "article_count", places=8)


@query("has_news")
def _(spark, sf_dir):
    joined = merge.price_x_sentiment(silver(spark, sf_dir, "prices"), _daily(spark, sf_dir))
    return merge.has_news(joined).groupBy("Stock_symbol", "has_news").agg(F.count(F.lit(1)).alias("rows"))


@query("fill_neutral")
def _(spark, sf_dir):
    joined = merge.price_x_sentiment(silver(spark, sf_dir, "prices"), _daily(spark, sf_dir))
    return shown(merge.fill_neutral(joined), *KEY, *SCORES, "article_count", "predicted_sentiment", places=8)


@query("with_sector")
def _(spark, sf_dir):
    return shown(merge.with_sector(silver(spark, sf_dir, "prices"), silver(spark, sf_dir, "sectors")), *KEY, "category")


@query("fill_misc")
def _(spark, sf_dir):
    joined = merge.with_sector(silver(spark, sf_dir, "prices"), silver(spark, sf_dir, "sectors"))
    return shown(merge.fill_misc(joined), *KEY, "category")


@query("merge")
def _(spark, sf_dir):
    tables = [silver(spark, sf_dir, t) for t in ("prices", "news", "scores", "sectors")]
    merged = flows.sector_panel(*tables, START, END)
    return shown(
        merged, *KEY, "Open", "High", "Low", "Close", "Adj Close", "Volume", *SCORES, "article_count",
        "predicted_sentiment", "has_news", "category", places=8,
    )


@query("score_lexicon")
def _(spark, sf_dir):
    documents = standins.table(spark, sf_dir, "documents")
    return shown(sentiment.score_lexicon(documents, "doc_id", "text"), places=8, places_of={})


def lexicon_scorer():
    """The lexicon scores for a batch of texts, in the form of a model."""
    import re

    import numpy as np

    def score(texts):
        counts = np.array([
            [sum(w in words for w in found) for words in (set(sentiment.NEGATIVE_WORDS), set(sentiment.POSITIVE_WORDS))]
            for found in (re.split("[^a-z]+", t.lower()) for t in texts)
        ], dtype=float).reshape(-1, 2)
        logits = np.column_stack([counts[:, 0], np.ones(len(counts)), counts[:, 1]])
        weights = np.exp(logits - logits.max(axis=1, keepdims=True))
        return weights / weights.sum(axis=1, keepdims=True)

    return score


@query("score_sentiment")
def _(spark, sf_dir):
    documents = standins.table(spark, sf_dir, "documents")
    return shown(sentiment.score_sentiment(documents, lexicon_scorer, "doc_id", "text"), places=8, places_of={})


@query("scan_parquet_batches")
def _(spark, sf_dir):
    """The scorer's two columns, scanned from Parquet in slices of 64 rows."""
    path = work_dir(spark, "scorer_input")
    sinks.write_parquet(clean.select_columns(standins.raw_news(spark, sf_dir)), path)
    scored = sentiment.score_sentiment(files.scan_parquet(spark, path), lexicon_scorer)
    return shown(scored.groupBy("predicted_sentiment").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("positive").alias("positive")
    ), places=8, places_of={})


# Labels, features, z-scores -----------------------------------------------

@query("create_labels")
def _(spark, sf_dir):
    return shown(labels.create_labels(silver(spark, sf_dir, "prices")), *KEY, "Daily_Return", "Up_Day", "Up_Count_5d", "Label")


@query("create_labels_forward")
def _(spark, sf_dir):
    forward = labels.create_labels(silver(spark, sf_dir, "prices"), price_col="Adj Close", mode="forward")
    return shown(forward, *KEY, "Daily_Return", "Up_Day", "Up_Count_5d", "Label")


FEATURE_QUERIES = {
    "returns": ("engineer_return_features", ("Return_1d", "Return_5d", "Return_20d")),
    "moving_averages": ("engineer_moving_average_features", ("MA5", "MA20", "MA5_Ratio", "MA20_Ratio", "Trend_5_20")),
    "extrema": ("engineer_extrema_features", ("High_20", "Low_20", "Dist_20High", "Dist_20Low")),
    "volatility": ("engineer_volatility_features", ("Vol_5d", "Vol_20d", "Vol_Ratio", "Gap")),
    "volume": (
        "engineer_volume_features", ("Vol_Change", "Vol_MA20", "Vol_MA5", "Vol_Ratio_20", "PV_Score", "Vol_Trend")
    ),
    "sentiment_features": ("engineer_sentiment_features", ("Sent_Net", "Sent_MA5", "Sent_Mom5")),
    "news_intensity": ("engineer_news_features", ("Art_MA20", "News_Intensity")),
    "lag_features": ("engineer_lag_features", ("Ret_Lag1", "Ret_Lag5", "Sent_Lag3")),
    "all_features": ("engineer_all_features", features.FEATURES),
    "moving_avgs": ("engineer_moving_average_features", ("MA5", "MA20")),
    "ma_ratios": ("engineer_moving_average_features", ("MA5_Ratio", "MA20_Ratio")),
    "trend": ("engineer_moving_average_features", ("Trend_5_20",)),
    "dist_extrema": ("engineer_extrema_features", ("Dist_20High", "Dist_20Low")),
    "vol_ratio": ("engineer_volatility_features", ("Vol_Ratio",)),
    "gap": ("engineer_volatility_features", ("Gap",)),
    "volume_change": ("engineer_volume_features", ("Vol_Change",)),
    "volume_ma": ("engineer_volume_features", ("Vol_MA20", "Vol_MA5")),
    "volume_ratio": ("engineer_volume_features", ("Vol_Ratio_20",)),
    "pv_score": ("engineer_volume_features", ("PV_Score",)),
    "volume_trend": ("engineer_volume_features", ("Vol_Trend",)),
    "sent_net": ("engineer_sentiment_features", ("Sent_Net",)),
    "sent_ma5": ("engineer_sentiment_features", ("Sent_MA5",)),
    "sent_mom5": ("engineer_sentiment_features", ("Sent_Mom5",)),
}
LABEL_QUERIES = {
    "daily_return": ("Daily_Return",), "up_day": ("Up_Day",), "up_count_5d": ("Up_Count_5d",), "label": ("Label",),
}


def _feature_query(fn: str, columns: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: shown(getattr(features, fn)(silver(spark, sf_dir, "panel")), *KEY, *columns, places=8)


for _name, (_fn, _columns) in FEATURE_QUERIES.items():
    query(_name)(_feature_query(_fn, _columns))


def _label_query(columns: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: shown(labels.create_labels(silver(spark, sf_dir, "panel")), *KEY, *columns, places=8)


for _name, _columns in LABEL_QUERIES.items():
    query(_name)(_label_query(_columns))


@query("all_features_ffill")
def _(spark, sf_dir):
    """Changes over days whose price is taken out, from the last known one."""
    gaps = silver(spark, sf_dir, "panel").withColumn(
        "Adj Close", F.when(F.dayofmonth("Date") % 4 != 1, F.col("`Adj Close`"))
    )
    filled = features.engineer_all_features(gaps, fill="ffill")
    return shown(filled, *KEY, "Return_1d", "Return_5d", "Return_20d", "Vol_Change", "MA5", places=8)


Z_COLUMNS = tuple(f"{f}_z" for f in features.FEATURES)


@query("zscore")
def _(spark, sf_dir):
    scored = zscore.normalize_features(silver(spark, sf_dir, "features"))
    return shown(scored, *KEY, *Z_COLUMNS, places=5)


@query("zscore_sliding")
def _(spark, sf_dir):
    scored = zscore.normalize_features(silver(spark, sf_dir, "features"), window=60, method="sliding")
    return shown(scored, *KEY, *Z_COLUMNS, places=5)


@query("model_set")
def _(spark, sf_dir):
    return shown(flows.model_set(silver(spark, sf_dir, "panel")), *KEY, "category", "Label", *Z_COLUMNS, places=5)


@query("panel_sort")
def _(spark, sf_dir):
    return shown(panel.panel_sort(silver(spark, sf_dir, "prices")), *KEY, "Close")


@query("model_matrix")
def _(spark, sf_dir):
    rows = clean.drop_null_subset(silver(spark, sf_dir, "features"), list(features.FEATURES))
    matrix = models.model_matrix(rows, features.FEATURES)
    x = vector_to_array("features")
    return shown(matrix.select(*KEY, "Label", F.size(x).alias("width"), x[0].alias("first"), x[22].alias("last")))


# Folds --------------------------------------------------------------------

@query("date_index")
def _(spark, sf_dir):
    return shown(folds.date_index(silver(spark, sf_dir, "model_set")).drop("n"))


@query("fold_table")
def _(spark, sf_dir):
    return shown(folds.fold_table(silver(spark, sf_dir, "model_set")))


@query("fold_counts")
def _(spark, sf_dir):
    return folds.fold_counts(silver(spark, sf_dir, "panel"))


@query("assign_folds")
def _(spark, sf_dir):
    assigned = folds.assign_folds(silver(spark, sf_dir, "panel"))
    return assigned.groupBy("Stock_symbol", "category", "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("Volume").alias("volume")
    )


@query("fold_slice")
def _(spark, sf_dir):
    return shown(folds.fold_slice(silver(spark, sf_dir, "panel"), START, END), *KEY, "category")


@query("sector_skip")
def _(spark, sf_dir):
    """Sectors with and without folds of this length."""
    return folds.sector_skip(silver(spark, sf_dir, "panel"), 2050, 21)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = folds.fold_table(silver(spark, sf_dir, "panel"), 300, 35)
    dates = [F.col(c) for c in scalars.MODEL_DATE_FIELDS]
    return saved.withColumn("model_path", F.concat(F.col("category"), F.lit("/"), scalars.format_model_name(*dates)))


@query("match_model")
def _(spark, sf_dir):
    periods = folds.fold_table(silver(spark, sf_dir, "panel"))
    matched = folds.match_model(periods, _registry(spark, sf_dir))
    return shown(matched, "category", "fold", "test_start", "test_end", "model_path", "exact_match")


@query("format_model_name")
def _(spark, sf_dir):
    return _registry(spark, sf_dir).select("category", "fold", "model_path")


@query("parse_model_name")
def _(spark, sf_dir):
    name = F.substring_index("model_path", "/", -1)
    odd = F.when(F.col("fold") % 5 == 0, F.concat(name, F.lit(".bak"))).otherwise(F.concat(name, F.lit(".pkl")))
    named = _registry(spark, sf_dir).select("category", "fold", odd.alias("name"))
    return shown(named.select("category", "fold", *scalars.parse_model_name(F.col("name"))))


@query("sorted_dates")
def _(spark, sf_dir):
    return shown(folds.sorted_dates(silver(spark, sf_dir, "panel")))


@query("distinct_values")
def _(spark, sf_dir):
    return eda.distinct_values(silver(spark, sf_dir, "panel"), "Stock_symbol")


@query("distinct_months")
def _(spark, sf_dir):
    return shown(folds.distinct_months(silver(spark, sf_dir, "panel")))


# Scalars ------------------------------------------------------------------

@query("softmax")
def _(spark, sf_dir):
    logits = [F.col("value") / 50, F.lit(1.0), (F.col("event_id") % 10).cast("double") / 4]
    columns = [p.alias(n) for p, n in zip(scalars.softmax(logits), SCORES)]
    return shown(standins.table(spark, sf_dir, "events").select("event_id", *columns), places=8, places_of={})


@query("argmax_label")
def _(spark, sf_dir):
    third = {n: (F.floor(F.col("event_id") / d) % 3).cast("double") for n, d in zip(SCORES, (1, 3, 9))}
    label = scalars.argmax_label(third["positive"], third["neutral"], third["negative"])
    return standins.table(spark, sf_dir, "events").select("event_id", label.alias("label"))


@query("argmax_article")
def _(spark, sf_dir):
    thirds = [(F.floor(F.col("event_id") / d) % 3).cast("double") for d in (1, 3, 9)]
    return standins.table(spark, sf_dir, "events").select("event_id", scalars.argmax_article(thirds).alias("label"))


@query("threshold")
def _(spark, sf_dir):
    return standins.table(spark, sf_dir, "events").select(
        "event_id", scalars.threshold((F.col("event_id") % 9).cast("double") / 8).alias("y_pred")
    )


@query("path_stem")
def _(spark, sf_dir):
    path = F.concat(F.lit("archive.d/"), F.lower("p_brand"), F.when(F.col("p_size") > 25, ".us.csv").otherwise("")).alias("path")
    return standins.table(spark, sf_dir, "part").select(path).distinct().select("path", scalars.path_stem(F.col("path")).alias("stem"))


@query("is_csv_member")
def _(spark, sf_dir):
    folder = F.when(F.col("p_size") % 2 == 0, "__MACOSX/").otherwise("history/")
    ending = F.when(F.col("p_size") % 3 == 0, ".txt").otherwise(".csv")
    name = F.concat(folder, F.col("p_brand"), ending).alias("name")
    return standins.table(spark, sf_dir, "part").select(name).distinct().select("name", scalars.is_csv_member(F.col("name")).alias("kept"))


@query("sector_names")
def _(spark, sf_dir):
    file = F.concat(F.replace("category", F.lit("_"), F.lit(" ")), F.lit("_stocks_data.csv"))
    return silver(spark, sf_dir, "sectors").select(
        "Stock_symbol",
        files.sector_of_file(file).alias("sector"),
        scalars.sector_key(F.replace(file, F.lit(".csv"), F.lit(""))).alias("folder"),
    )


@query("date_functions")
def _(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    text = F.date_format(day, "yyyyMMdd")
    parsed = scalars.to_date_or_null(text, "yyyyMMdd")
    end = F.lit(END).cast("date")
    return standins.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        text.alias("text"),
        parsed.cast("string").alias("parsed"),
        F.year(parsed).alias("year"),
        F.datediff(F.greatest(parsed, end), F.least(parsed, end)).alias("days"),
    )


@query("percent")
def _(spark, sf_dir):
    return (
        standins.table(spark, sf_dir, "events").groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("user_id") % 2).cast("bigint")).alias("odd"))
        .select("event_type", scalars.percent(F.col("odd"), F.col("n")).alias("percent"))
    )


# Metrics and reports ------------------------------------------------------

SIX = tuple(metrics.METRICS)


@query("auc")
def _(spark, sf_dir):
    return shown(metrics.auc(predictions(spark, sf_dir), ["fold"]), places=8)


@query("auc_by_symbol")
def _(spark, sf_dir):
    return shown(metrics.auc(predictions(spark, sf_dir), ["Stock_symbol"]), places=8)


@query("classification_metrics")
def _(spark, sf_dir):
    return shown(metrics.classification_metrics(predictions(spark, sf_dir), ["fold"]), places=8)


@query("log_loss")
def _(spark, sf_dir):
    return shown(metrics.log_loss(predictions(spark, sf_dir), ["fold"]), places=8)


@query("fold_results")
def _(spark, sf_dir):
    """Fold results of a synthetic score on the panel's test dates."""
    table = silver(spark, sf_dir, "features").select(*KEY, "category", "Label", "Volume")
    tests = folds.assign_folds(table, role="test").withColumns({
        "y_test": F.col("Label"), "y_prob": (F.col("Volume") % 97 + 1).cast("double") / 98,
    })
    return shown(flows.fold_report(table, metrics.with_prediction(tests)), places=8)


@query("predict_threshold")
def _(spark, sf_dir):
    return predictions(spark, sf_dir).groupBy("fold", "y_pred").agg(F.count(F.lit(1)).alias("rows"))


@query("confusion_matrix")
def _(spark, sf_dir):
    return metrics.confusion_matrix(predictions(spark, sf_dir))


@query("confusion_rates")
def _(spark, sf_dir):
    return shown(metrics.confusion_rates(predictions(spark, sf_dir)), places=8)


@query("metrics_overall")
def _(spark, sf_dir):
    return shown(metrics.metrics_overall(results(spark, sf_dir)), places=8)


@query("metrics_summary")
def _(spark, sf_dir):
    return shown(metrics.metrics_summary(results(spark, sf_dir)), places=8)


@query("metrics_by_year")
def _(spark, sf_dir):
    return shown(metrics.metrics_by_year(results(spark, sf_dir)), places=8)


@query("metrics_timeline")
def _(spark, sf_dir):
    return shown(metrics.metrics_timeline(results(spark, sf_dir)), places=8)


@query("daily_labels")
def _(spark, sf_dir):
    return shown(metrics.daily_labels(predictions(spark, sf_dir)), places=8)


@query("symbol_metrics")
def _(spark, sf_dir):
    return shown(metrics.symbol_metrics(predictions(spark, sf_dir)), places=8)


@query("symbol_leaders")
def _(spark, sf_dir):
    return shown(metrics.symbol_leaders(predictions(spark, sf_dir)), places=8)


@query("symbol_laggards")
def _(spark, sf_dir):
    return shown(metrics.symbol_laggards(predictions(spark, sf_dir)), places=8)


@query("union_predictions")
def _(spark, sf_dir):
    table = predictions(spark, sf_dir)
    stacked = models.union_predictions(*[table.where(F.col("fold") % 2 == k) for k in (0, 1)])
    return shown(stacked.groupBy("fold", "Stock_symbol").agg(F.sum("y_pred").alias("predicted"), F.sum("y_test").alias("actual")))


@query("backtest_report")
def _(spark, sf_dir):
    """Every value of every report table."""
    return shown(flows.report_values(flows.backtest_report(results(spark, sf_dir), predictions(spark, sf_dir))), places=8)


# Exploration --------------------------------------------------------------

@query("sector_counts")
def _(spark, sf_dir):
    return eda.sector_counts(silver(spark, sf_dir, "panel"))


@query("distinct_symbols")
def _(spark, sf_dir):
    return eda.distinct_symbols(silver(spark, sf_dir, "panel"))


@query("value_counts")
def _(spark, sf_dir):
    return shown(eda.value_counts(silver(spark, sf_dir, "panel"), "Stock_symbol"))


@query("label_by_symbol")
def _(spark, sf_dir):
    return shown(eda.label_by_symbol(silver(spark, sf_dir, "eda_features")))


@query("class_balance")
def _(spark, sf_dir):
    return eda.class_balance(silver(spark, sf_dir, "eda_features"))


@query("describe_panel")
def _(spark, sf_dir):
    columns = ["Open", "High", "Low", "Close", "Adj Close", "Volume", *SCORES, "article_count"]
    return shown(eda.describe(silver(spark, sf_dir, "panel"), columns))


@query("describe")
def _(spark, sf_dir):
    return shown(eda.describe(silver(spark, sf_dir, "features"), features.FEATURES))


@query("missing_values")
def _(spark, sf_dir):
    return shown(eda.missing_values(silver(spark, sf_dir, "features").select(*KEY, "Up_Count_5d", *features.FEATURES)))


def _corr_group_query(group: str) -> Query:
    return lambda spark, sf_dir: shown(eda.corr_group(silver(spark, sf_dir, "features"), group))


for _group in ("momentum", "volatility", "volume", "sentiment"):
    query(f"corr_{_group}")(_corr_group_query(_group))


@query("corr_with_label")
def _(spark, sf_dir):
    return shown(eda.corr_with_label(silver(spark, sf_dir, "eda_features")))


@query("corr_with_label_by_group")
def _(spark, sf_dir):
    return shown(eda.corr_with_label_by_group(silver(spark, sf_dir, "eda_features")))


@query("corr_matrix")
def _(spark, sf_dir):
    return shown(eda.corr_matrix(silver(spark, sf_dir, "features")))


@query("corr_top10")
def _(spark, sf_dir):
    return shown(eda.corr_top(silver(spark, sf_dir, "eda_features")))


@query("corr_bottom10")
def _(spark, sf_dir):
    return shown(eda.corr_bottom(silver(spark, sf_dir, "eda_features")))


@query("top_abs_corr")
def _(spark, sf_dir):
    return shown(eda.top_abs_corr(silver(spark, sf_dir, "eda_features")))


@query("hist_by_label")
def _(spark, sf_dir):
    return shown(eda.histogram_by_label(silver(spark, sf_dir, "eda_features")))


@query("quality_summary")
def _(spark, sf_dir):
    return shown(eda.quality_summary(silver(spark, sf_dir, "features")))


@query("nth_frequent_symbol")
def _(spark, sf_dir):
    return shown(eda.nth_frequent_symbol(silver(spark, sf_dir, "features")), *KEY, "MA20", "Sent_Net", "Vol_MA20")


@query("preview")
def _(spark, sf_dir):
    return shown(eda.preview(panel.panel_sort(silver(spark, sf_dir, "panel"))), *KEY, "Close", "category")


# Models ------------------------------------------------------------------
# Scores have no SQL equivalent; what they must agree with has.

def _trial(spark: SparkSession, sf_dir: str, **spans: int):
    """(models' folder, predictions, status) of a run, by default that of ``TRIAL``."""
    spans = spans or TRIAL

    def make():
        folder = work_dir(spark, "models")
        return folder, *models.walk_forward(silver(spark, sf_dir, "model_set"), models_dir=folder, **spans)

    return once(spark, sf_dir, f"trial {sorted(spans.items())}", make)


def _consistent(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "cut_agrees": F.col("y_pred") == (F.col("y_prob") > 0.5).cast("int"),
        "in_range": F.col("y_prob").between(0, 1),
    })


@query("walk_forward")
def _(spark, sf_dir):
    checked = _consistent(_trial(spark, sf_dir)[1])
    return shown(checked, "category", "fold", *KEY, "Label", "y_test", "cut_agrees", "in_range")


@query("walk_forward_status")
def _(spark, sf_dir):
    whole = _trial(spark, sf_dir, train_days=folds.TRAIN_DAYS, test_days=folds.TEST_DAYS)
    return whole[2].select("category", "fold", "status")


@query("walk_forward_results")
def _(spark, sf_dir):
    folder, predicted, _ = _trial(spark, sf_dir)
    registry = models.model_registry(spark, folder)
    report = flows.fold_report(silver(spark, sf_dir, "model_set"), predicted, registry=registry, **TRIAL)
    named = report.withColumn("model", F.substring_index("model_path", "/", -1))
    return shown(named, "category", "fold", "train_start", "train_end", "test_start", "test_end", "n_train", "n_test", "model")


@query("model_registry")
def _(spark, sf_dir):
    return shown(models.model_registry(spark, _trial(spark, sf_dir)[0]).drop("model_path"))


@query("sorted_models")
def _(spark, sf_dir):
    registry = models.model_registry(spark, _trial(spark, sf_dir)[0])
    return shown(models.sorted_models(registry).select("category", "test_start", "test_end"))


@query("save_model")
def _(spark, sf_dir):
    folder, predicted, _ = _trial(spark, sf_dir)
    path = work_dir(spark, "registry")
    report = flows.fold_report(silver(spark, sf_dir, "model_set"), predicted, **TRIAL)
    models.save_registry(models.model_registry(spark, folder), report, path)
    saved = spark.read.parquet(path).withColumns({
        "features": F.size("features"), "scored": F.col("accuracy").between(0, 1) & F.col("log_loss").isNotNull(),
    })
    return shown(saved, "category", "train_start", "train_end", "test_start", "test_end", "n_train", "n_test", "features", "scored")


@query("evaluate_saved")
def _(spark, sf_dir):
    folder, predicted, _ = _trial(spark, sf_dir)
    again = models.evaluate_saved(silver(spark, sf_dir, "model_set"), models.model_registry(spark, folder), **TRIAL)[0]
    before = predicted.select("category", "fold", *KEY, F.col("y_prob").alias("_was"))
    both = again.join(before, ["category", "fold", *KEY], "left").withColumn("same_score", F.coalesce(F.col("y_prob") == F.col("_was"), F.lit(False)))
    return shown(both, "category", "fold", *KEY, "Label", "same_score")
