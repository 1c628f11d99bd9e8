"""Language by string kernels: n-gram presence, Nystrom landmarks, ridge regression.

The kernel of two texts is the number of n-grams (2 to 4 bytes of the
lower-cased letters, all lengths in one spectrum) that both contain, over the
root of the product of the counts each contains. n-grams are those of the
landmark texts, in hashed slots. With K the kernels to the landmarks, the
Nystrom map K (K_mm)^-1/2 feeds one ridge regression per language; a batch of
texts is scored by matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import fold_of, labelled_sample
from barsignal.llm.words import text_bytes

# Bounds of the fit: labelled rows read, landmarks, n-grams of the landmarks.
SAMPLE_ROWS = 2000
LANDMARKS = 128
GRAMS = 8192
SIZES = (2, 3, 4)
SLOT_BITS = 18
RIDGE = 1e-3
# Texts whose presence rows stand in memory at once, and their bytes.
ROWS = 256
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return any(c.isalpha() for c in text)


def gram_slots(data: bytes) -> np.ndarray:
    """Hashed slots of all n-grams of some bytes, those across spaces only included."""
    x = _FOLD[np.frombuffer(data, np.uint8)].astype(np.uint32)
    out, code = [], x
    for n in range(2, max(SIZES) + 1):
        code = (code[:-1] << np.uint32(8)) | x[n - 1 :]
        if n in SIZES:
            h = (code + np.uint32(n)) * np.uint32(2654435761)
            h ^= h >> np.uint32(15)
            out.append((h * np.uint32(2246822519)) >> np.uint32(32 - SLOT_BITS))
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    column: np.ndarray  # of each slot, -1 if no landmark has it
    landmarks: np.ndarray  # presence of the grams, grams x landmarks
    weights: np.ndarray  # landmarks x languages

    def presence(self, texts: list[bytes]) -> np.ndarray:
        grams = self.landmarks.shape[0]
        found = np.zeros((len(texts), grams), np.float32)
        for row, data in zip(found, texts, strict=True):
            if len(data) < 2:
                continue
            for slots in gram_slots(data):
                at = self.column[slots]
                row[at[at >= 0]] = 1
        return found

    def kernels(self, texts: list[bytes]) -> np.ndarray:
        found = self.presence(texts)
        own, theirs = found.sum(1), self.landmarks.sum(0)
        return (found @ self.landmarks) / np.sqrt(np.maximum(own, 1)[:, None] * np.maximum(theirs, 1)[None])

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred and score (0 to 1: the winner's regression value, clipped)."""
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        for k in range(0, len(known), ROWS):
            rows = known[k : k + ROWS]
            values = self.kernels([text_bytes(texts[i]) for i in rows]) @ self.weights
            best = values.argmax(1)
            names[rows] = np.array(self.languages, object)[best]
            scores[rows] = np.clip(values[np.arange(len(rows)), best], 0, 1)
        return pd.DataFrame({"lang_pred": names, "score": scores})


def fit_language(sample: list[tuple[str, str]], landmarks: int = LANDMARKS) -> LanguageModel:
    """Landmarks are dealt evenly over the languages; without any text nothing is learned."""
    sample = [(text_bytes(t), y) for t, y in sample if has_letter(t)]
    languages = sorted({y for _, y in sample})
    share = max(1, landmarks // max(1, len(languages)))
    chosen = [x for lang in languages for x in [t for t, y in sample if y == lang][:share]]
    seen = np.zeros(1 << SLOT_BITS, np.int32)
    for data in chosen:
        seen[np.unique(np.concatenate([np.empty(0, np.uint32), *gram_slots(data)]))] += 1
    order = np.argsort(-seen, kind="stable")[: min(GRAMS, int((seen > 0).sum()))]
    column = np.full(1 << SLOT_BITS, -1, np.int32)
    column[order] = np.arange(len(order))
    model = LanguageModel(languages, column, np.zeros((max(1, len(order)), 1), np.float32), np.zeros((1, len(languages))))
    if not languages:
        return model
    model.landmarks = np.ascontiguousarray(model.presence(chosen).T)
    values, vectors = np.linalg.eigh(model.kernels(chosen).astype(float))
    kept = values > 1e-6
    root = vectors[:, kept] / np.sqrt(values[kept])  # K_mm^-1/2 up to a rotation
    mapped = np.concatenate([model.kernels([t for t, _ in sample[k : k + ROWS]]) for k in range(0, len(sample), ROWS)]) @ root
    target = np.array([[y == lang for lang in languages] for _, y in sample], float)
    inner = mapped.T @ mapped + RIDGE * len(sample) * np.eye(mapped.shape[1])
    model.weights = root @ np.linalg.solve(inner, mapped.T @ target)
    return model


def learn_language(docs: DataFrame, folds: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS, lang: str = "lang") -> LanguageModel:
    """Fits on at most ``rows`` documents with a language whose crc32(doc_id) mod ``folds`` is not ``held_out``."""
    return fit_language(labelled_sample(docs, docs, lang, fold_of("doc_id", folds) != held_out, rows)[0])


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of those names are replaced.

    A null text and one without a letter is ``und`` with score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield sent.value.predict(batch.tolist())

    found = docs.withColumn("_found", predict(F.col(text)))
    return found.withColumn("lang_pred", F.col("_found.lang_pred")).withColumn("score", F.col("_found.score")).drop("_found")
