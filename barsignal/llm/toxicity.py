"""Toxicity by a bidirectional GRU with attention pooling over words and their characters.

A word's input is its own vector, if the training texts know it, plus the mean
of its character trigrams' vectors. Every text is scored in overlapping
windows of words, and its score is the largest of them. Labels are of whole
texts: in training a toxic text speaks through its likeliest window, the other
texts through their likeliest and a random one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.llm import bigru
from barsignal.llm.common import fold_of, labelled_sample
from barsignal.llm.words import batch_words, span_hashes, text_bytes

# Bounds of the fit: labelled rows read, windows of a text tried, words known.
SAMPLE_ROWS = 4000
TRAIN_WINDOWS = 48
WORDS = 4096
GRAMS = 4096  # twelve bits of a hash
DIM, HIDDEN = 8, 8
WINDOW, STRIDE = 32, 24
EPOCHS, BATCH, RATE = 5, 64, 0.01
# Steps at least, on few rows in more epochs; the word table starts small and learns slowly, as most words come in few texts.
STEPS = 180
TABLE_START, WORD_RATE = 0.5, 0.3
# Roots of likelihood ratios that some of some thousand words reach by chance.
CHANCE = 3.5
WINDOWS_AT_ONCE = 2048
CHARS_AT_ONCE = 1 << 22
THRESHOLD = 0.3

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[65:91], _FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


def gram_slots(data: np.ndarray) -> np.ndarray:
    """Slot of the trigram around each byte."""
    x = np.concatenate([[32], _FOLD[data], [32]]).astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.uint16)


def window_starts(words: int) -> np.ndarray:
    """First words of the windows of a text: each overlaps the next, the last one ends with the text or before a window does."""
    return np.arange(0, max(1, words - (WINDOW - STRIDE)), STRIDE)


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # sorted hashes of known words
    p: dict[str, np.ndarray] = field(repr=False)
    chars_of_known: np.ndarray | None = None  # character part of the known words

    def __post_init__(self) -> None:
        self._known = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": None}

    def _inputs(self, slots, starts, ends, grams: np.ndarray) -> np.ndarray:
        """Character part of the words' inputs."""
        if not len(starts):
            return np.zeros((0, DIM), np.float32)
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        at = np.repeat(starts - first, lengths) + np.arange(lengths.sum())
        sums = np.add.reduceat(grams[slots[at]], first, axis=0)
        return sums / lengths[:, None].astype(np.float32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word in the word table, 0 for unknown ones."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0) if len(self.vocabulary) else np.zeros(len(hashes), np.int64)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Largest window score of each text; a text without words gets the score of an empty window."""
        parts, part, size = [], [], 0
        for text in texts:
            part.append(text)
            size += len(text or "")
            if size > CHARS_AT_ONCE:
                parts.append(self._score(part))
                part, size = [], 0
        return np.concatenate([*parts, self._score(part)]) if part or not parts else np.concatenate(parts)

    def _score(self, texts: list[str | None]) -> np.ndarray:
        data, starts, ends, bounds = batch_words([text_bytes((t or "").lower()) for t in texts], "mark")
        out = np.full(len(texts), -np.inf)
        hashes = span_hashes(data, starts, ends)
        place = self.places(hashes)
        # Gate inputs of known words are made once; unknown ones once a batch.
        new, inverse = np.unique(hashes[place == 0], return_index=True, return_inverse=True)[1:]
        unknown = np.flatnonzero(place == 0)
        rows = unknown[new]
        p = self.p
        chars = self._inputs(gram_slots(data), starts[rows], ends[rows], p["grams"])
        row_of = place - 1
        row_of[unknown] = len(self.vocabulary) + inverse
        if self._known is None:
            self._known = (p["words"][1:] + self.chars_of_known) @ p["w"] + p["bias"]
        table = np.concatenate([self._known, (p["words"][0] + chars) @ p["w"] + p["bias"]]).astype(np.float32)
        sizes = np.diff(bounds)
        begins = [window_starts(n) for n in sizes]
        doc = np.repeat(np.arange(len(texts)), [len(b) for b in begins])
        begin = np.concatenate([np.empty(0, np.int64), *begins]).astype(np.int64)
        for k in range(0, len(doc), WINDOWS_AT_ONCE):
            d, b = doc[k : k + WINDOWS_AT_ONCE], begin[k : k + WINDOWS_AT_ONCE]
            at = b[:, None] + np.arange(WINDOW)
            mask = at < sizes[d, None]
            words = np.minimum(np.array(bounds)[d, None] + at, max(0, len(row_of) - 1))
            named = np.where(mask, row_of[words], 0) if len(row_of) else np.zeros(at.shape, np.int64)
            if not len(table):
                table = np.zeros((1, 6 * HIDDEN), np.float32)
            np.maximum.at(out, d, bigru.logits(p, table, named, mask.astype(np.float32)).astype(float))
        return bigru.sigmoid(out)

def _windows(n: int, draw: np.random.Generator) -> np.ndarray:
    starts = window_starts(n)
    return starts if len(starts) <= TRAIN_WINDOWS else np.sort(draw.choice(starts, TRAIN_WINDOWS, replace=False))


def fit_toxicity(sample: list[tuple[str, int]], counts: dict[int, int] | None = None, seed: int = 3, epochs: int | None = None) -> ToxicityModel:
    """Trains on (text, label) pairs. Without both labels the score is the smoothed share of label 1.

    Without ``epochs`` there are EPOCHS, or as many as STEPS steps need.
    ``counts`` of all labelled rows by label move the scores from the share
    of label 1 in the sample to that among all.
    """
    draw = np.random.default_rng(seed)
    y = np.array([float(v) for _, v in sample])
    slots, starts, ends, hashes, sizes = _all_words([t for t, _ in sample])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(sample)), sizes)
    order = np.lexsort((doc, hashes))
    once = np.ones(len(order), bool)
    once[1:] = (np.diff(doc[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    pair_words, pair_docs = hashes[order][once], doc[order][once]
    words, df = np.unique(pair_words, return_counts=True)
    vocabulary = np.sort(words[np.argsort(-df, kind="stable")[:WORDS]][: int((df >= 3).sum())])
    p = bigru.init(len(vocabulary) + 1, GRAMS, DIM, HIDDEN, seed)
    for name in ("words", "grams"):
        p[name] *= TABLE_START
    share = (y.sum() + 1) / (len(y) + 2)
    model = ToxicityModel(vocabulary, p)
    model.chars_of_known = np.zeros((len(vocabulary), DIM), np.float32)
    p["base"][:] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y) or not len(hashes):
        p["out"][:] = 0
        return model
    # The first component of a known word starts as the evidence for its side, beyond what chance explains.
    known = np.isin(pair_words, vocabulary)
    at = np.searchsorted(vocabulary, pair_words[known])
    p["words"][1:, 0] = _evidence(np.bincount(at, y[pair_docs[known]], len(vocabulary)), np.bincount(at, minlength=len(vocabulary)), y.mean())
    place = model.places(hashes)
    tried = [_windows(int(n), draw) for n in sizes]
    adam = bigru.Adam(p, RATE, {"words": WORD_RATE})
    a_round = -(-(len(y) + int((y == 0).sum())) // BATCH)
    epochs = epochs or max(EPOCHS, -(-STEPS // a_round))

    def batch(docs: np.ndarray, begins: np.ndarray):
        at = begins[:, None] + np.arange(WINDOW)
        mask = (at < sizes[docs, None]).astype(np.float32)
        words = np.minimum(np.asarray(bounds)[docs, None] + at, len(place) - 1)
        return words, mask

    flat_docs = np.repeat(np.arange(len(sample)), [len(t) for t in tried])
    flat = np.concatenate(tried)
    chosen = None
    for epoch in range(epochs):
        if epoch == 0:  # likeliest by the words' first component
            words, mask = batch(flat_docs, flat)
            value = (p["words"][place[words], 0] * mask).max(1)
        else:
            model.chars_of_known = _known_chars(model, slots, starts, ends, hashes)
            value = _window_logits(model, slots, starts, ends, place, flat_docs, flat, batch)
        order = np.lexsort([-value, flat_docs])
        docs, at = np.unique(flat_docs[order], return_index=True)
        top = flat[order][at]
        some = np.array([draw.choice(t) for t in tried])
        good = np.flatnonzero(y == 0)
        chosen_docs = np.concatenate([docs, good])
        chosen = np.concatenate([top, some[good]])
        adam.rate = RATE * (1 - epoch / (epochs + 1))
        mixed = draw.permutation(len(chosen_docs))
        for k in range(0, len(mixed), BATCH):
            part = mixed[k : k + BATCH]
            words, mask = batch(chosen_docs[part], chosen[part])
            _step(p, adam, place, slots, starts, ends, words, mask, y[chosen_docs[part]].astype(np.float32))
    model.chars_of_known = _known_chars(model, slots, starts, ends, hashes)
    if counts:
        p["base"] += np.log(counts.get(1, 0) + 1) - np.log(counts.get(0, 0) + 1) - np.log(y.sum() + 1) + np.log((1 - y).sum() + 1)
    return model


def _evidence(toxic: np.ndarray, texts: np.ndarray, share: float) -> np.ndarray:
    """Signed root of the likelihood ratio of words in ``texts`` texts, ``toxic`` of them toxic, against ``share``; 0 within CHANCE."""
    clean = texts - toxic
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(toxic > 0, toxic * np.log(toxic / (texts * share)), 0) + np.where(clean > 0, clean * np.log(clean / (texts * (1 - share))), 0)
    root = np.sqrt(2 * np.maximum(ratio, 0))
    return np.sign(toxic - texts * share) * np.clip(root - CHANCE, 0, 3)


def _known_chars(model, slots, starts, ends, hashes) -> np.ndarray:
    """Character part of the known words, from a place where each stands."""
    words, first = np.unique(hashes, return_index=True)
    rows = first[np.searchsorted(words, model.vocabulary)]
    return model._inputs(slots, starts[rows], ends[rows], model.p["grams"])


def _all_words(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Trigram slots of all bytes, start, end and hash of every word, words of each text; read in parts."""
    parts, at = [], 0
    for k in range(0, len(texts), 256):
        data, starts, ends, bounds = batch_words([text_bytes(t.lower()) for t in texts[k : k + 256]], "mark")
        parts.append((gram_slots(data), starts + at, ends + at, span_hashes(data, starts, ends), np.diff(bounds)))
        at += len(data)
    if not parts:
        return np.empty(0, np.uint16), *np.empty((2, 0), np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _window_logits(model, slots, starts, ends, place, docs, begins, batch) -> np.ndarray:
    p, out = model.p, []
    for k in range(0, len(docs), WINDOWS_AT_ONCE):
        words, mask = batch(docs[k : k + WINDOWS_AT_ONCE], begins[k : k + WINDOWS_AT_ONCE])
        rows, inverse = np.unique(words, return_inverse=True)
        x = p["words"][place[rows]] + model._inputs(slots, starts[rows], ends[rows], p["grams"])
        table = (x @ p["w"] + p["bias"]).astype(np.float32)
        out.append(bigru.logits(p, table, inverse.reshape(words.shape), mask))
    return np.concatenate(out)


def _step(p, adam, place, slots, starts, ends, words, mask, y) -> float:
    flat, inverse = np.unique(words[mask > 0], return_inverse=True)
    lengths = ends[flat] - starts[flat]
    first = np.cumsum(lengths) - lengths
    at = slots[np.repeat(starts[flat] - first, lengths) + np.arange(lengths.sum())]
    chars = np.add.reduceat(p["grams"][at], first, axis=0) / lengths[:, None].astype(np.float32)
    x = np.zeros((*words.shape, DIM), np.float32)
    x[mask > 0] = (p["words"][place[flat]] + chars)[inverse]
    loss, g, dx = bigru.gradient(p, x, mask, y)
    by_word = np.zeros((len(flat), DIM), np.float32)
    np.add.at(by_word, inverse, dx[mask > 0])
    g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
    np.add.at(g["words"], place[flat], by_word)
    np.add.at(g["grams"], at, np.repeat(by_word / lengths[:, None].astype(np.float32), lengths, axis=0))
    adam.step(g)
    return loss


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS, label: str = "toxic"
) -> ToxicityModel:
    """Fits on at most ``rows`` labelled documents whose crc32(doc_id) mod ``folds`` is not ``held_out``, half of each label."""
    sample, counts = labelled_sample(docs, labels, label, fold_of("doc_id", folds) != held_out, rows, classes=(1, 0))
    return fit_toxicity(sample, counts)


def with_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from the threshold on); columns of those names are replaced.

    Whole texts are scored. Null and empty texts, and those without a letter
    or digit, get the score of an empty window.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(sent.value.score(batch.tolist()), dtype=float)

    scored = docs.withColumn("score", score(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
