"""Hits stay inside their own text, whatever shares a batch; long items and many blocks in bounded memory."""

import os
import pickle

import numpy as np
import pytest

from barsignal.llm import decontaminate
from barsignal.llm.common import prepare
from barsignal.llm.decontaminate import BenchmarkIndex, allowed, words_of

SF = "/root/testdata/sf0.001"
ITEM = "the quick brown fox jumps over the lazy dog near the quiet river bank"


def by_hand(items, texts):
    """(text, item, edits): the least edits of each item against any stretch of each text."""
    out = set()
    for d, text in enumerate(texts):
        words = words_of(text)
        for item, t in items:
            want = words_of(t)
            if not len(want) or not len(words):
                continue
            row = np.zeros(len(words) + 1, np.int64)  # an item may begin anywhere
            steps = np.arange(len(words) + 1)
            for k, w in enumerate(want):
                new = np.minimum(row + 1, np.concatenate([[k + 1], row[:-1] + (words != w)]))
                row = np.minimum.accumulate(new - steps) + steps
            if row.min() <= allowed(len(want)):
                out.add((d, item, int(row.min())))
    return out


def test_a_hit_belongs_to_the_text_that_holds_it():
    index = BenchmarkIndex([(1, ITEM)])
    texts = ["a clean text about nothing at all", ITEM, "clean", None, "", ITEM.upper() + " and more", "x " * 40 + ITEM]
    whole = index.search(texts)
    assert [[h[:2] for h in hits] for hits in whole] == [[], [(1, 0)], [], [], [], [(1, 0)], [(1, 40)]]
    assert [index.search([t])[0] for t in texts] == whole
    assert index.search(texts[::-1])[::-1] == whole


def test_a_long_item_costs_memory_in_proportion():
    rng = np.random.default_rng(0)
    pool = [f"w{i}" for i in range(20_000)]
    items = [(i, " ".join(rng.choice(pool, 40))) for i in range(1000)]
    long = " ".join(rng.choice(pool, 5000))
    small, large = (len(pickle.dumps(BenchmarkIndex(x))) for x in (items, [*items, (1000, long)]))
    assert large < small + 3_000_000 < 30_000_000
    index = BenchmarkIndex([*items, (1000, long)])
    edited = long.split()
    edited[::9] = ["other"] * len(edited[::9])
    got = index.search(["short text", items[5][1], "before it " + " ".join(edited) + " after", items[7][1] + " x"])
    assert [[(h[0], h[3]) for h in hits] for hits in got] == [[], [(5, 0)], [(1000, len(long.split()[::9]))], [(7, 0)]]


def test_blocks_change_nothing(spark):
    prepare(spark)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, 30)) for _ in range(40)]
    docs = spark.createDataFrame([(i, f"so {t} it goes") for i, t in enumerate(texts)] + [(99, "clean")], "doc_id long, text string").selectExpr("*", "1 as _benchmark_hits")
    bench = spark.createDataFrame(list(enumerate(texts[:25])), "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    many = decontaminate.with_hits(docs, bench, per_block=4)
    assert sorted((r.doc_id, *h) for r in many.collect() for h in r.hits) == one and len(one) >= 25
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {*range(25, 40), 99}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_query_equals_every_window(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, items = docs.select("doc_id", "text").collect(), [tuple(r) for r in bench.select("item_id", "text").collect()]
    want = {(rows[d].doc_id, item, edits) for d, item, edits in by_hand(items, [r.text for r in rows])}
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == want
