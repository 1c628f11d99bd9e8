"""Ranked search against scoring every document, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barsignal.llm import ranked_search as rs
from barsignal.llm.common import prepare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        scores = []
        for (d, bag), size in zip(bags, sizes, strict=True):
            score = 0
            for t in words & set(bag):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + 90 * size * n // total
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is not None, d or 0, d))
        out += [(item, i + 1, s[-1], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(out)


def texts(rng, n):
    pool = [f"w{int(x)}" for x in np.random.default_rng(3).zipf(1.3, 4000) if x < 500]
    out = [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(n)]
    return out + [out[3]] * 40 + ["W1 w2,W3", None, "", "...", "É É ß w5", "the " * 3000 + "w7"]


@pytest.mark.parametrize(("k", "shard_docs", "short", "query_chars"), [(10, 16_384, 64, 10**6), (3, 50, 1, 300), (5, 70, 4, 10**6)])
def test_search_equals_scoring_every_document(spark, monkeypatch, k, shard_docs, short, query_chars):
    monkeypatch.setattr(rs, "SHORT_INTERVAL", short)
    prepare(spark)
    rng = random.Random(k)
    docs = list(enumerate(texts(rng, 400)))
    rng.shuffle(docs)
    docs += [docs[0], docs[1], (None, "w1 w2 w3"), (None, "w1 w2 w3"), (-7, "w1 w2 w3")]
    items = [(i, " ".join(f"W{rng.randint(1, 40)}" for _ in range(rng.randint(1, 20)))) for i in range(25)]
    items += [(None, "w1"), (90, None), (91, ""), (92, "nowhere"), (93, "w1 w1 w2"), (93, "w9"), (94, "ß"), (94, "ß")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as score", "3 as terms")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank")
    got = rs.ranked_search(df, bench, k, shard_docs=shard_docs, query_chars=query_chars)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == by_hand(docs, items, k)


def test_empty_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rs.ranked_search(docs.limit(0), bench).count() == 0
    assert rs.ranked_search(docs, bench.limit(0)).count() == 0


def shard(lists, docs):
    """``lists``: {document: impact} per term."""
    cells = [(d, t, x) for t, own in enumerate(lists) for d, x in own.items()]
    return rs.Shard(*(np.array(c, np.int64) for c in zip(*cells, strict=True)), len(lists), docs)


def test_range_maxima():
    rng = np.random.default_rng(1)
    lists = [{int(d): int(rng.integers(0, 50)) for d in rng.choice(900, n, replace=False)} for n in (1, 2, 7, 64, 500)]
    s = shard(lists, 900)
    lo = np.array([int(rng.integers(s.starts[t], s.starts[t + 1])) for t in range(5) for _ in range(40)])
    hi = np.array([int(rng.integers(a + 1, s.starts[t + 1] + 1)) for a, t in zip(lo, np.repeat(np.arange(5), 40), strict=True)])
    assert [s.impact[p] for p in s.largest(lo, hi)] == [s.impact[a:b].max() for a, b in zip(lo, hi, strict=True)]


def test_hopeless_intervals_are_not_opened(monkeypatch):
    rng = np.random.default_rng(2)
    lists = [{int(d): int(x) for d, x in zip(range(20_000), rng.integers(1, 100, 20_000), strict=True)} for _ in range(3)]
    for t, own in enumerate(lists):
        own.update({d: 10_000 + d + t for d in range(5_000, 5_010)})
    s, opened = shard(lists, 20_000), []
    largest = s.largest
    monkeypatch.setattr(s, "largest", lambda lo, hi: opened.append(1) or largest(lo, hi))
    assert [d for _, d in s.best(np.arange(3), 10)] == list(range(5_009, 4_999, -1))
    assert len(opened) < 100
