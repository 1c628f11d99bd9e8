"""Ranked lexical search by range maxima over posting lists.

The documents are read once for a block of queries: of each the number of its
terms and, for the block's terms, their occurrences, written as the index. A
shard is a run of documents in ascending order of id; it holds one posting
list per term with the impact of the term in each document, and a sparse table
of range maxima over all lists. A query starts with the whole shard as one
interval. The interval with the largest bound (the sum of the range maxima of
its terms) is taken first and split at its document of largest impact, which is
scored; short intervals are scored whole. What cannot enter the
best k any more is never opened. The shards' best k meet in one ranking.

All arithmetic after the term weights is in 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import shared
from barsignal.llm.words import batch_words, span_hashes, text_bytes, word_hashes

TOP = 10
# Documents of a shard and postings of a shard, whichever is reached first.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 1_000_000
# Intervals of so few documents are scored whole, by one sum over their postings.
SHORT_INTERVAL = 512
# Characters of the queries whose terms are looked up in one pass, about.
QUERY_CHARS = 8_000_000
# Bytes of text hashed at once.
BYTES_AT_ONCE = 1 << 22

INDEX = "doc_id long, n long, terms binary, tfs binary"
FOUND = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> np.ndarray:
    """Hashes of the distinct terms of a text: runs of ASCII digits, letters and non-ASCII characters, A-Z as a-z."""
    return np.unique(word_hashes(text_bytes(text).lower(), "mark"))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _indexed(vocabulary):
    """A task that counts the words of texts and the occurrences of the vocabulary's."""
    def count(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        data, starts, ends, firsts = batch_words(texts, "mark")
        hashes = span_hashes(data, starts, ends)
        known = vocabulary.value
        place = np.searchsorted(known, hashes)
        place[place == len(known)] = 0
        hit = np.flatnonzero(known[place] == hashes) if len(known) else np.empty(0, np.int64)
        doc = np.searchsorted(firsts, hit, side="right") - 1
        both, times = np.unique(doc * len(known) + place[hit], return_counts=True)
        edges = np.searchsorted(both, np.arange(len(texts) + 1) * len(known))
        terms, times = (both % max(1, len(known))).astype("<i4"), times.astype("<i4")
        cut = [slice(edges[i], edges[i + 1]) for i in range(len(texts))]
        return np.diff(firsts), [terms[c].tobytes() for c in cut], [times[c].tobytes() for c in cut]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t).lower() for t in batch["text"]]
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= BYTES_AT_ONCE):
                    size += len(texts[j])
                    j += 1
                n, terms, tfs = count(texts[i:j])
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[i:j].astype("Int64"), "n": n, "terms": terms, "tfs": tfs})
                i = j

    return run


class Shard:
    """Posting lists of some documents in ascending order of id, and their range maxima."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int, docs: int) -> None:
        order = np.lexsort((doc, term))
        self.doc, self.impact, self.docs = doc[order].astype(np.int32), impact[order], docs
        self.starts = np.searchsorted(term[order], np.arange(terms + 1))
        longest = int(np.diff(self.starts).max(initial=1))
        # Level j: the place of the largest impact among 2^j postings. Lists
        # stand one behind the other; a query never leaves its own list.
        self.levels = [np.arange(len(self.doc), dtype=np.int32)]
        while 2 << (len(self.levels) - 1) <= longest:
            step, last = 1 << (len(self.levels) - 1), self.levels[-1]
            left, right = last[:-step], last[step:]
            self.levels.append(np.where(self.impact[left] >= self.impact[right], left, right))

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each lo..hi (hi excluded, none empty)."""
        out = np.empty(len(lo), np.int64)
        power = np.frexp(hi - lo)[1] - 1
        for level in np.unique(power):
            mine = power == level
            table = self.levels[level]
            left, right = table[lo[mine]], table[hi[mine] - (1 << int(level))]
            out[mine] = np.where(self.impact[left] >= self.impact[right], left, right)
        return out

    def best(self, terms: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the k best documents above 0, equal scores by the smaller document."""
        lo, hi = self.starts[terms], self.starts[terms + 1]
        kept: list[tuple[int, int]] = []  # heap of (score, -document): the least on top
        queue: list[tuple] = []

        def take(score: int, doc: int) -> None:
            if score > 0:
                if len(kept) < k:
                    heapq.heappush(kept, (score, -doc))
                elif (score, -doc) > kept[0]:
                    heapq.heapreplace(kept, (score, -doc))

        def push(first: int, end: int, lo: np.ndarray, hi: np.ndarray) -> None:
            some = hi > lo
            if first < end and some.any():
                lo, hi = lo[some], hi[some]
                top = self.largest(lo, hi)
                bound = int(self.impact[top].sum())
                if len(kept) < k or (bound, -first) > kept[0]:
                    heapq.heappush(queue, (-bound, first, end, lo, hi, top))

        push(0, self.docs, lo, hi)
        while queue:
            bound, first, end, lo, hi, top = heapq.heappop(queue)
            if len(kept) == k and (-bound, -first) <= kept[0]:
                if -bound < kept[0][0]:
                    break
                continue
            if end - first <= SHORT_INTERVAL:
                sizes = hi - lo
                at = np.arange(sizes.sum()) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes)
                # Sums of whole numbers far below 2^53: doubles hold them.
                sums = np.bincount(self.doc[at] - first, weights=self.impact[at], minlength=end - first)
                least = kept[0][0] if len(kept) == k else 1
                for d in np.flatnonzero(sums >= least):
                    take(int(sums[d]), first + int(d))
                continue
            split = int(self.doc[top[self.impact[top].argmax()]])
            left = np.array([a + np.searchsorted(self.doc[a:b], split) for a, b in zip(lo, hi, strict=True)])
            here = (left < hi) & (self.doc[np.minimum(left, len(self.doc) - 1)] == split)
            take(int(self.impact[left[here]].sum()), split)
            push(first, split, lo, left)
            push(split + 1, end, left + here, hi)
        return sorted(((score, -doc) for score, doc in kept), key=lambda x: (-x[0], x[1]))


def impacts(tf: np.ndarray, w: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What occurrences add to a score: ``terms`` in ``docs`` documents of the corpus, ``n`` in the document's own."""
    m = 10 + (90 * n * docs) // terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _ranked(sent, docs: int, terms: int, k: int, shard_docs: int, shard_postings: int):
    """A task that searches every query in the shards of its part of the index."""
    def search(rows: list[tuple]) -> pd.DataFrame:
        weights, queries = sent.value
        # Ids that are null come first, as they do in an ascending order.
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        counts = np.array([len(r[2]) // 4 for r in rows])
        doc = np.repeat(np.arange(len(rows)), counts)
        term = np.frombuffer(b"".join(r[2] for r in rows), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
        impact = impacts(tf, weights[term], np.array([r[1] for r in rows], np.int64)[doc], docs, terms)
        shard = Shard(doc, term, impact, len(weights), len(rows))
        found = [(item, rows[d][0], score) for item, own in queries for score, d in shard.best(own, k)]
        out = pd.DataFrame(found, columns=["item_id", "doc_id", "score"])
        return out.astype({"item_id": "int64", "doc_id": "Int64", "score": "int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        postings = 0
        for batch in batches:
            ids = batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None)
            for row in zip(ids, batch["n"], batch["terms"], batch["tfs"], strict=True):
                rows.append((None if row[0] is None else int(row[0]), *row[1:]))
                postings += len(row[2]) // 4
                if len(rows) >= shard_docs or postings >= shard_postings:
                    yield search(rows)
                    rows, postings = [], 0
        if rows:
            yield search(rows)

    return run


def ranked_search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, text: str = "text", query_text: str = "text",
    shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, query_chars: int = QUERY_CHARS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every query, of those with a score above 0.

    A term's weight w is floor(1000 ln((2N+2) / (2df+1))) for N documents with
    a term; an occurrence count tf in a document of n terms adds
    w * (10^9 tf div (1000 tf + 8m)), m = 10 + 90nN div L, L the terms of all
    documents; a query's terms count once each. Equal scores rank by ascending
    doc_id, null first. Repeated rows of ``docs`` are documents of their own;
    the rows of one item are one query; null items, null texts and texts
    without terms find nothing and are not found. Other columns are not read. Terms are compared
    by 64-bit hashes. Queries are looked up in blocks of about
    ``query_chars`` characters, each one pass over the texts.
    """
    spark = docs.sparkSession
    items = queries.where(F.col("item_id").isNotNull() & F.col(query_text).isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col(query_text).alias("text")
    ).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).collect()[0]["n"]
    blocks = max(1, -(-chars // query_chars))
    parts = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id").agg(F.collect_list("text").alias("texts")).collect()
        if rows:
            asked = sorted(((r["item_id"], terms_of("\n".join(r["texts"]))) for r in rows), key=lambda x: x[0])
            parts.append(_searched_block(docs, asked, k, text, shard_docs, shard_postings, blocks))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _searched_block(docs: DataFrame, items: list, k: int, text: str, shard_docs: int, shard_postings: int, blocks: int) -> DataFrame:
    spark = docs.sparkSession
    known = np.unique(np.concatenate([np.empty(0, np.uint64), *(t for _, t in items)]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = shared(texts.mapInPandas(_indexed(spark.sparkContext.broadcast(known)), INDEX), "search_index")
    size = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).collect()[0]
    df = np.zeros(len(known), np.int64)
    for row in index.select("terms").mapInPandas(_term_counts(len(known)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]  # one row per term of the block's queries
    weights = np.array([weight(size["docs"], int(x)) for x in df], np.int64)
    sent = spark.sparkContext.broadcast((weights, [(item, np.searchsorted(known, t)) for item, t in items]))
    search = _ranked(sent, size["docs"], max(1, size["terms"]), k, shard_docs, shard_postings)
    found = index.where("n > 0").mapInPandas(search, FOUND)
    return shared(found, "search_hits") if blocks > 1 else found


def _term_counts(terms: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(terms, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch["terms"]), "<i4"), minlength=terms)
        met = np.flatnonzero(counts)
        yield pd.DataFrame({"term": met.astype(np.int32), "df": counts[met]})

    return run
