"""Quality by compression: how much better a text packs with a good dictionary than a bad one.

Two zstandard dictionaries are built from blocks of good and of bad labelled
texts. A text is cut into blocks of fixed size, so that a long text does not
become its own dictionary, and every block is compressed with both; the
difference of the sizes over the text's bytes is the measure. A logistic curve
fitted on labelled texts that the dictionaries have not seen makes it a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import fold_of, labelled_sample
from barsignal.llm.words import text_bytes

# Bounds of the fit: labelled rows read, and the size of a dictionary.
SAMPLE_ROWS = 4000
DICTIONARY_BYTES = 1 << 16
BLOCK = 512
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    base: float

    def __post_init__(self) -> None:
        self._packers = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_packers": None}

    def measure(self, text: str | None) -> float:
        """(bytes with the bad dictionary - bytes with the good one) / bytes; 0 for an empty text."""
        if self._packers is None:
            self._packers = [_packer(d) for d in (self.good, self.bad)]
        data = text_bytes(text)
        if not data:
            return 0.0
        good, bad = (
            sum(len(pack.compress(data[k : k + BLOCK])) for k in range(0, len(data), BLOCK)) for pack in self._packers
        )
        return (bad - good) / len(data)

    def score(self, texts) -> np.ndarray:
        return _curve(self.slope * np.array([self.measure(t) for t in texts], float) + self.base)


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    content = zstandard.ZstdCompressionDict(dictionary)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=content, compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_dict_id=0)
    )


def _dictionary(texts: list[str]) -> bytes:
    blocks = [d[k : k + BLOCK] for d in map(text_bytes, texts) for k in range(0, len(d), BLOCK)]
    # The builder needs many samples: few texts become the content as they are.
    step = max(1, len(blocks) * BLOCK // (100 * DICTIONARY_BYTES))
    blocks = blocks[::step]
    if len(blocks) < 32:
        return b"".join(blocks)[-DICTIONARY_BYTES:]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def fit_quality(sample: list[tuple[str, int]]) -> QualityModel:
    """Dictionaries from the even half of the (text, label) pairs of each class, the curve from the odd half.

    Without both classes the score is the smoothed share of label 1.
    """
    by = {label: [t for t, y in sample if y == label] for label in (1, 0)}
    share = (len(by[1]) + 1) / (len(by[1]) + len(by[0]) + 2)
    if min(len(by[0]), len(by[1])) < 2:
        return QualityModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    model = QualityModel(*(_dictionary(by[label][::2]) for label in (1, 0)), 0.0, 0.0)
    x = np.array([model.measure(t) for label in (1, 0) for t in by[label][1::2]])
    y = np.repeat([1.0, 0.0], [len(by[1][1::2]), len(by[0][1::2])])
    model.slope, model.base = _logistic(x, y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    scale = x.std() or 1.0
    z = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = _curve(z @ w)
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def learn_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows: int = SAMPLE_ROWS, label: str = "quality"
) -> QualityModel:
    """Fits on at most ``rows`` labelled documents whose crc32(doc_id) mod ``folds`` is not ``held_out``."""
    return fit_quality(labelled_sample(docs, labels, label, fold_of("doc_id", folds) != held_out, rows)[0])


def quality_score(model: QualityModel, text: Column) -> Column:
    """Score from 0 to 1 of whole texts; null and empty ones get the curve's value at no difference."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(batch))

    return score(text)


def with_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted (1 from the threshold on); columns of those names are replaced."""
    scored = docs.withColumn("score", quality_score(model, F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
