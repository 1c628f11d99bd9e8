"""The search for one bin ends with the least waste, whatever the number of pieces."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barsignal.llm import packing, tokens


def waste_of_the_best(counts, room):
    sums = {0}
    for x, n in counts.items():
        sums = {s + k * x for s in sums for k in range(min(n, room // x) + 1) if s + k * x <= room}
    return room - max(sums)


def test_many_equal_short_pieces_pack():
    bins = packing.complete_bins({3: 1, 2: 5000}, packing.CAPACITY)
    assert sum(t * len(p) for t, p in bins) == 5001
    assert sum(t for t, _ in bins) == -(-10003 // packing.CAPACITY)


def test_every_bin_has_the_least_waste():
    rng = np.random.default_rng(4)
    for _ in range(20):
        room = int(rng.integers(200, 400))
        counts = {int(x): int(n) for x, n in zip(2 * rng.integers(20, room // 2, 12), rng.integers(1, 9, 12), strict=True)}
        counts[41] = 1
        left = dict(counts)
        for times, pattern in packing.least_waste(counts, room):
            top = pattern[0]
            assert top == max(left)
            others = {x: n - (x == top) for x, n in left.items()}
            assert room - sum(pattern) == waste_of_the_best(others, room - top)
            for x in pattern:
                left[x] -= times
            left = {x: n for x, n in left.items() if n}
        assert not left


def test_a_far_completion_is_found():
    # Only the four smallest lengths fill the bin; thousands of fillings by larger ones come first.
    counts = {1024: 1, **{x: 2 for x in range(100, 340, 6)}, 5: 1, 9: 1, 13: 1}
    (_, pattern), *_ = packing.least_waste(counts, 2048)
    assert 2048 - sum(pattern) == waste_of_the_best({x: n for x, n in counts.items() if x != 1024}, 1024)


def least_bins(pieces, room):
    """The least number of bins, by trying every place of every piece."""
    pieces, best = sorted(pieces, reverse=True), len(pieces)

    def go(i, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if i == len(pieces):
            best = len(spaces)
            return
        for k, space in enumerate(spaces):
            if space >= pieces[i] and space not in spaces[:k]:
                go(i + 1, [*spaces[:k], space - pieces[i], *spaces[k + 1 :]])
        go(i + 1, [*spaces, room - pieces[i]])

    go(0, [])
    return best


def packed(bins, room):
    assert all(sum(pattern) <= room for _, pattern in bins)
    return dict(sum((Counter({x: times * n for x, n in Counter(pattern).items()}) for times, pattern in bins), Counter()))


@settings(max_examples=300, deadline=None)
@given(st.integers(5, 60).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), min_size=1, max_size=10))))
def test_small_sets_take_the_least_bins(case):
    room, pieces = case
    counts = dict(Counter(pieces))
    bins = packing.complete_bins(counts, room)
    assert packed(bins, room) == counts
    assert packing.lower_bound(counts, room) <= packing.n_bins(bins) == least_bins(pieces, room)


def test_the_search_takes_bins_back():
    # Filling the first bin without waste spoils the rest.
    counts, room = dict(Counter([7, 6, 5, 4, 4, 3, 3, 3, 2, 2, 2, 2])), 11
    assert packing.n_bins(packing.complete_bins(counts, room)) == least_bins(list(Counter(counts).elements()), room)
    first = packing.n_bins(packing.least_waste({6: 2, 4: 2, 3: 3, 2: 4, 5: 1}, 12))
    assert packing.n_bins(packing.complete_bins({6: 2, 4: 2, 3: 3, 2: 4, 5: 1}, 12)) <= first


def test_no_nodes_gives_the_best_first_solution():
    rng = np.random.default_rng(9)
    for _ in range(30):
        counts = {int(x): int(n) for x, n in zip(rng.integers(30, 200, 20), rng.integers(1, 5, 20), strict=True)}
        first = [f(counts, 211) for f in (packing.least_waste, packing.first_fit, packing.best_fit)]
        assert all(packed(bins, 211) == counts for bins in first)
        assert packing.n_bins(packing.complete_bins(counts, 211, 0)) == min(map(packing.n_bins, first))
        assert packing.n_bins(packing.complete_bins(counts, 211, 2000)) <= min(map(packing.n_bins, first))


def first_fit_by_piece(sizes, room):
    spaces = []
    for x in sorted(sizes, reverse=True):
        for k, space in enumerate(spaces):
            if space >= x:
                spaces[k] -= x
                break
        else:
            spaces.append(room - x)
    return len(spaces)


def best_fit_by_piece(sizes, room):
    spaces = []
    for x in sorted(sizes, reverse=True):
        fits = [(space, k) for k, space in enumerate(spaces) if space >= x]
        if fits:
            spaces[min(fits)[1]] -= x
        else:
            spaces.append(room - x)
    return len(spaces)


@pytest.mark.parametrize(("sf", "most"), [("0.001", 89), ("0.01", 442)])
def test_given_tables_pack_no_worse_than_piece_by_piece(sf, most):
    path = f"/root/testdata/sf{sf}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    texts = [r[0] for r in duckdb.sql(f"select text from '{path}'").fetchall()]
    sizes = []
    for ids in tokens.encoder(tokens.vocabulary_file()).batch(texts):
        whole, rest = divmod(len(ids) // 2 + 1, packing.CAPACITY)
        sizes += [packing.CAPACITY] * whole + [rest] * (rest > 0)
    bins = packing.complete_bins(dict(Counter(sizes)), packing.CAPACITY)
    assert packed(bins, packing.CAPACITY) == dict(Counter(sizes))
    assert packing.n_bins(bins) <= min(most, first_fit_by_piece(sizes, packing.CAPACITY), best_fit_by_piece(sizes, packing.CAPACITY))
