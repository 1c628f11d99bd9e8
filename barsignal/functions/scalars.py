"""Scalar column functions: labels, probabilities, paths and model names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "argmax_article", "argmax_label", "drop_name_suffix", "format_model_name", "is_csv_member",
    "parse_model_name", "path_stem", "percent", "sector_key", "softmax", "symbol_from_path",
    "threshold", "to_date_or_null", "to_double_or_null", "to_int_or_null",
]

# Names and patterns that files and model folders already use.
SENTIMENT_LABELS = ("negative", "neutral", "positive")
MODEL_NAME_PATTERN = r"^model_train_(\d{8})_to_(\d{8})_test_(\d{8})_to_(\d{8})(\.pkl)?$"
MODEL_DATE_FIELDS = ("train_start", "train_end", "test_start", "test_end")
SECTOR_FILE_SUFFIX = "_stocks_data.csv"


def to_date_or_null(x: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(x, F.lit(fmt)).cast("date")


def to_double_or_null(x: Column) -> Column:
    return x.try_cast("double")


def to_int_or_null(x: Column, kind: str = "int") -> Column:
    """Integer from text such as ``12`` or ``12.0``; NULL when it is no number.

    Plain integers take the direct cast, which is exact beyond 2^53.
    """
    return F.coalesce(x.try_cast(kind), _whole(x, kind))


def _whole(x: Column, kind: str) -> Column:
    number = x.try_cast("double")
    return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast(kind)


def argmax_label(positive: Column, neutral: Column, negative: Column) -> Column:
    """Largest of three averages; a tie goes to positive, then to neutral."""
    return argmax_article([positive, neutral, negative], ("positive", "neutral", "negative"))


def softmax(logits: list[Column]) -> list[Column]:
    """Probabilities of the given logits, shifted by their maximum."""
    top = F.greatest(*logits)
    weights = [F.exp(x - top) for x in logits]
    total = sum(weights[1:], weights[0])
    return [w / total for w in weights]


def argmax_article(probabilities: list[Column], labels: tuple[str, ...] = SENTIMENT_LABELS) -> Column:
    """Name of the first largest probability, in the order of ``labels``."""
    values = F.array(*probabilities)
    names = F.array(*[F.lit(name) for name in labels])
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def threshold(probability: Column, cut: float = 0.5) -> Column:
    """1 when the probability is strictly above the cut."""
    return (probability > cut).cast("int")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def path_stem(path: Column) -> Column:
    """Base name of a path without its last extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def symbol_from_path(path: Column) -> Column:
    """Upper-cased stem of a ``.csv`` file, empty for other files."""
    return F.upper(F.regexp_extract(path, r"([^/]+)\.csv$", 1))


def is_csv_member(name: Column) -> Column:
    """Archive member that is a CSV and not resource-fork metadata."""
    return name.endswith(".csv") & ~name.contains("__MACOSX")


def drop_name_suffix(name: Column, suffix: str = SECTOR_FILE_SUFFIX) -> Column:
    return F.replace(name, F.lit(suffix), F.lit(""))


def sector_key(name: Column) -> Column:
    """Folder name of a sector: no data suffix, spaces as underscores."""
    return F.replace(F.replace(name, F.lit("_stocks_data"), F.lit("")), F.lit(" "), F.lit("_"))


def parse_model_name(name: Column) -> list[Column]:
    """The four dates of a model name; all NULL when the name does not match."""
    return [
        to_date_or_null(F.nullif(F.regexp_extract(name, MODEL_NAME_PATTERN, i), F.lit("")), "yyyyMMdd").alias(field)
        for i, field in enumerate(MODEL_DATE_FIELDS, start=1)
    ]


def format_model_name(train_start: Column, train_end: Column, test_start: Column, test_end: Column) -> Column:
    return F.format_string(
        "model_train_%s_to_%s_test_%s_to_%s",
        *[F.date_format(d, "yyyyMMdd") for d in (train_start, train_end, test_start, test_end)],
    )
