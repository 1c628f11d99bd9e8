"""Benchmark decontamination by CGK embeddings and bit sampling.

A text is its sequence of words (lower case, without punctuation). For every
length of benchmark items all windows of that many words are candidates, at
every word of a document. The CGK walk reads a window from the left and, by a
random bit per step and word, stays or moves on: windows few edits apart give
strings few coordinates apart. Every walk is sampled several times at a few
coordinates; windows that agree with an item in one sample are compared with
it by exact edit distance over words. With the defaults a window at the
largest distance is met with a chance above 0.99.

An edit breaks two pairs of neighbouring words at most, so a window that holds
too few words or word pairs of the items of its length to be within the
distance is left out before the walk: a bound that loses nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import free_names, shared
from barsignal.llm.words import mix, text_bytes, word_hashes
from barsignal.session import remove

# Edits allowed: a quarter of an item's words, none for items under 8 words.
EDIT_SHARE = 4
SHORT = 8
WALKS, SAMPLES, COORDINATES = 6, 12, 3
# Items, and their characters, whose index is sent to the tasks at once; more mean more passes.
ITEMS_PER_BLOCK = 20_000
CHARS_PER_BLOCK = 8_000_000
PAIR_SLOTS = 1 << 20
WINDOWS_AT_ONCE = 1 << 14
# Cells of the windows whose exact distances are taken at once.
CELLS_AT_ONCE = 1 << 22
WORDS_AT_ONCE = 1 << 20

HITS = "array<struct<item_id:bigint,start_word:bigint,n_words:bigint,edits:bigint>>"


def words_of(text: str | None) -> np.ndarray:
    return word_hashes(text_bytes((text or "").lower()), "mark")


def _pair_slots(symbols: np.ndarray) -> np.ndarray:
    x = symbols.astype(np.uint32)
    return ((x[:-1] * np.uint32(2654435761) + x[1:]) * np.uint32(2246822519)) >> np.uint32(12)


def allowed(n: int) -> int:
    return n // EDIT_SHARE if n >= SHORT else 0


class BenchmarkIndex:
    """LSH tables of a block of items, by length."""

    def __init__(self, items: list[tuple[int, str]], seed: int = 11) -> None:
        same: dict[bytes, list[int]] = defaultdict(list)
        for item, text in items:
            if len(found := words_of(text)):
                same[found.tobytes()].append(item)
        self.ids = [sorted(x) for x in same.values()]
        hashed = [np.frombuffer(x, np.uint64) for x in same]
        self.vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *hashed]))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.vocabulary & np.uint64((1 << 20) - 1)] = True
        self.items = [np.searchsorted(self.vocabulary, x).astype(np.int32) + 1 for x in hashed]
        self.by_length: dict[int, np.ndarray] = {}
        for n in sorted({len(x) for x in self.items}):
            self.by_length[n] = np.array([i for i, x in enumerate(self.items) if len(x) == n])
        self.seed = seed
        # A walk's bit at a step is the top bit of a multiply-add of this and the step's own two numbers.
        self.mixed = (mix(np.arange(1, len(self.vocabulary) + 2, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
        self.classes = self._length_classes()
        self.tables = {n: self._table(n) for n in self.by_length}

    def _length_classes(self) -> list[list[tuple[list[int], np.ndarray, np.ndarray]]]:
        """Neighbouring lengths that share a first bound, the words and word pairs of their items; by octave of length."""
        out: list[list[int]] = []
        for n in self.by_length:
            if out and n <= out[-1][0] * 1.15 and n.bit_length() == out[-1][0].bit_length():
                out[-1].append(n)
            else:
                out.append([n])
        octaves: dict[int, list] = defaultdict(list)
        for lengths in out:
            mask, pairs = np.zeros(len(self.vocabulary) + 1, bool), np.zeros(PAIR_SLOTS, bool)
            for n in lengths:
                for i in self.by_length[n]:
                    mask[self.items[i]] = True
                    pairs[_pair_slots(self.items[i])] = True
            octaves[lengths[0].bit_length()].append((lengths, mask, pairs))
        return list(octaves.values())

    def symbols(self, text: str | None) -> np.ndarray:
        """Numbers of a text's words, 0 for words of no item."""
        found = words_of(text)
        out = np.zeros(len(found), np.int32)
        at = np.flatnonzero(self.maybe[found & np.uint64((1 << 20) - 1)])
        if len(at):
            place = np.searchsorted(self.vocabulary, found[at])
            place[place == len(self.vocabulary)] = 0
            out[at] = np.where(self.vocabulary[place] == found[at], place + 1, 0)
        return out

    def keys(self, stream: np.ndarray, mixed: np.ndarray, starts: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """Sample keys of the windows of n words at ``starts``, one array per sample."""
        steps = max(1, 8 * n // 5)  # a walk takes about two steps a word: most stay inside
        draw = np.random.default_rng([self.seed, n])
        for walk in range(WALKS):
            coordinates = draw.integers(0, steps, (SAMPLES, COORDINATES))
            times, plus = draw.integers(0, 1 << 31, (2, steps)).astype(np.uint32)
            times = times * np.uint32(2) + np.uint32(1)
            factors = mix(draw.integers(1, 1 << 62, COORDINATES).astype(np.uint64)) | np.uint64(1)
            needed = {int(c) for c in coordinates.ravel()}
            seen: dict[int, np.ndarray] = {}
            at = starts.copy()
            for step in range(max(needed) + 1):
                if step in needed:
                    seen[step] = stream[at].astype(np.uint64)
                at += (mixed[at] * times[step] + plus[step]) >> np.uint32(31)
            for s, places in enumerate(coordinates):
                key = np.full(len(starts), walk * SAMPLES + s + 1, np.uint64)
                for c, factor in zip(places, factors, strict=True):
                    key += seen[int(c)] * factor
                yield key  # met by equality alone: needs no further mixing

    def _table(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        mine = self.by_length[n]
        stream = np.zeros((len(mine), 2 * n), np.int32)
        stream[:, :n] = [self.items[i] for i in mine]
        out = []
        for key in self.keys(stream.ravel(), self.mixed[stream.ravel()], np.arange(len(mine)) * 2 * n, n):
            order = np.argsort(key, kind="stable")
            out.append((key[order], mine[order]))
        return out

    def candidates(self, stream: np.ndarray, mixed: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window start, item) pairs that agree in one sample at least."""
        found = []
        for (keys, items), key in zip(self.tables[n], self.keys(stream, mixed, starts, n), strict=True):
            lo = np.searchsorted(keys, key)
            hit = np.flatnonzero(keys.take(lo, mode="clip") == key)
            if len(hit):
                lo = lo[hit]
                times = np.searchsorted(keys, key[hit], "right") - lo
                first = np.repeat(lo - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
                found.append(np.repeat(starts[hit], times) * len(self.items) + items[first + np.arange(times.sum())])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        both = np.unique(np.concatenate(found))
        return both // len(self.items), both % len(self.items)

    def distances(self, stream: np.ndarray, starts: np.ndarray, items: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each item against a text from its start on, and the words it then covers."""
        width = n + allowed(n)
        text = stream[starts[:, None] + np.arange(width)]
        want = np.array([self.items[i] for i in items])
        steps = np.arange(width + 1)
        row = np.broadcast_to(steps, (len(starts), width + 1)).copy()
        for k in range(n):
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (text != want[:, k, None]), out=new[:, 1:])
            row = np.minimum.accumulate(new - steps, axis=1) + steps
        return row.min(1), row.argmin(1)

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, start_word, n_words, edits) of the items in each text, the closest place of each."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        block: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            symbols = self.symbols(text)
            block.append((i, symbols))
            size += len(symbols)
            if size > WORDS_AT_ONCE:
                self._search(block, out)
                block, size = [], 0
        self._search(block, out)
        return out

    def _search(self, block: list[tuple[int, np.ndarray]], out: list[list]) -> None:
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for classes in self.classes:
            # Texts too short for any item of the octave hold none.
            shortest = min(n - allowed(n) for lengths, _, _ in classes for n in lengths)
            mine = [(doc, symbols) for doc, symbols in block if len(symbols) >= shortest]
            if mine:
                self._search_octave(classes, mine, best)
        for (doc, item), (edits, start, covered) in best.items():
            out[doc].extend((i, start, covered, edits) for i in self.ids[item])

    def _search_octave(self, classes: list, block: list[tuple[int, np.ndarray]], best: dict) -> None:
        gap = 2 * classes[-1][0][-1] + 1
        bases = np.concatenate([[0], np.cumsum([len(s) + gap for _, s in block])])
        stream, inside = np.zeros(bases[-1] + gap, np.int32), np.zeros(bases[-1] + gap, bool)
        for base, (_, symbols) in zip(bases, block, strict=False):
            stream[base : base + len(symbols)] = symbols
            inside[base : base + len(symbols)] = True
        mixed = self.mixed[stream]
        slots = _pair_slots(stream)
        top = len(stream) - gap
        for lengths, mask, known_pairs in classes:
            sums = np.concatenate([[0], np.cumsum(mask[stream], dtype=np.int32)])
            pairs = np.concatenate([[0], np.cumsum(known_pairs[slots], dtype=np.int32)])
            span = lengths[-1] + allowed(lengths[-1])
            least = min(n - 1 - 2 * allowed(n) for n in lengths)
            # A window begins at a word of a text, never in the gap before the next.
            near = np.flatnonzero((pairs[span - 1 : span - 1 + top] - pairs[:top] >= least) & inside[:top])
            for n in lengths:
                reach = n + allowed(n)
                starts = near[sums[near + reach] - sums[near] >= n - allowed(n)]
                starts = starts[pairs[starts + reach - 1] - pairs[starts] >= n - 1 - 2 * allowed(n)]
                at_once = max(1, min(WINDOWS_AT_ONCE, CELLS_AT_ONCE // reach))
                for k in range(0, len(starts), WINDOWS_AT_ONCE):
                    at, items = self.candidates(stream, mixed, starts[k : k + WINDOWS_AT_ONCE], n)
                    for j in range(0, len(at), at_once):
                        a, it = at[j : j + at_once], items[j : j + at_once]
                        edits, covered = self.distances(stream, a, it, n)
                        for h in np.flatnonzero(edits <= allowed(n)):
                            place = int(np.searchsorted(bases, a[h], "right")) - 1
                            key = block[place][0], int(it[h])
                            found = (int(edits[h]), int(a[h] - bases[place]), int(covered[h]))
                            best[key] = min(best.get(key, found), found)


def _searched(index):
    @F.pandas_udf(HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "start_word", "n_words", "edits")
        for batch in batches:
            found = index.value.search(batch.tolist())
            yield pd.Series([[dict(zip(names, h, strict=True)) for h in hits] for hits in found], dtype=object)

    return search


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", per_block: int = ITEMS_PER_BLOCK, name: str = "hits") -> DataFrame:
    """``docs`` with ``hits`` (or ``name``): (item_id, start_word, n_words, edits) of every benchmark item in the whole text.

    An item is in a text if some stretch of the text's words is within a
    quarter of the item's words in edits (equal for items under 8 words). Of
    each item the closest, then the earliest stretch is named; hits are
    ordered by item. Null texts have none; null items and items without words
    are in no text; repeated items are all named. A column of that name is replaced.
    Items are searched in blocks of about ``per_block`` items and
    ``CHARS_PER_BLOCK`` characters; between blocks the rows are written, so
    one index is held at a time.
    """
    spark = docs.sparkSession
    items = benchmark.where(F.col("item_id").isNotNull() & F.col(item_text).isNotNull()).select("item_id", F.col(item_text).alias("_t")).distinct()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("_t")), F.lit(0)).alias("chars")).collect()[0]
    blocks = max(1, -(-size["n"] // per_block), -(-size["chars"] // CHARS_PER_BLOCK))
    out, written = docs.withColumn(name, F.array().cast(HITS)), None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "_t"), F.lit(blocks)) == k).collect()
        index = spark.sparkContext.broadcast(BenchmarkIndex(sorted((r["item_id"], r["_t"]) for r in rows)))
        out = out.withColumn(name, F.concat(name, _searched(index)(F.col(text))))
        if k < blocks - 1:
            before, written = written, shared(out, "benchmark_hits")
            out = written
            index.unpersist()
            if before is not None:
                remove(before)
    return out.withColumn(name, F.array_sort(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item found in it; documents without one have no row."""
    found = with_hits(docs.select(key, text), benchmark, text)
    return found.select(F.col(key), F.explode("hits").alias("_h")).select(key, "_h.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item."""
    (hits,) = free_names(docs, "_benchmark_hits")
    return with_hits(docs, benchmark, text, name=hits).where(F.size(hits) == 0).drop(hits)
