"""The right side of a repeated window reaches the lines after its end, however long the window."""

import numpy as np

from barsignal.llm import line_dedup
from barsignal.llm.common import prepare
from test_llm import brute_lines

SCHEMA = "doc_id long, text string"


def words(name, n):
    return " ".join(f"{name}{j}" for j in range(n))


def test_short_lines_after_a_long_line_go(spark):
    prepare(spark)
    long, tail = words("a", 93), words("t", 2) + "\n" + words("u", 5)
    rows = [(1, f"{long}\n{tail}\n{words('x', 7)}"), (2, f"{words('y', 3)}\n{long}\n{tail}\n{words('z', 9)}"), (3, long)]
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == (0, rows[0][1]) and got[3] == (1, "")
    assert got[2] == (3, f"{words('y', 3)}\n{words('z', 9)}")


def test_runs_of_long_and_short_lines_equal_the_rule(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    pool = [words(f"l{i}w", int(n)) for i, n in enumerate(rng.choice([1, 2, 5, 9, 13, 40, 61], 30))]
    runs = [[pool[i] for i in rng.integers(0, 30, 12)] for _ in range(4)]
    rows = []
    for d in range(40):
        run, at = runs[int(rng.integers(0, 4))], int(rng.integers(0, 9))
        own = [words(f"d{d}k{j}w", int(rng.integers(1, 30))) for j in range(3)]
        rows.append((d, "\n".join([own[0], *run[at : at + int(rng.integers(1, 6))], own[1], *run[: int(rng.integers(1, 4))], own[2]])))
    want = brute_lines(rows, 12)
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA), 12).collect()}
    assert any(want.values())
    for d, t in rows:
        assert got[d].n_removed == len(want[d])
        if want[d]:
            assert got[d].text == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d])


def test_a_run_that_repeats_a_later_occurrence_goes_whole(spark):
    """The third text continues as the second does, not as the first: its tail goes as well."""
    prepare(spark)
    window, tail = words("a", 25), words("t", 4)
    rows = [(1, f"{window}\n{words('x', 5)}"), (2, f"{window}\n{tail}"), (3, f"{words('q', 3)}\n{tail}\n{window}\n{tail}"), (4, f"{words('q', 3)}\n{tail}\n{window}")]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: rows[0][1], 2: tail, 3: f"{words('q', 3)}\n{tail}", 4: ""}


def test_columns_that_clash(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, words("a", 25)), (2, words("a", 25))], SCHEMA).selectExpr("*", "7 as _copy_of", "8 as _dup_lines", "9 as _DUP_DOC")
    got = line_dedup.line_dedup(df).orderBy("doc_id").collect()
    assert [(r._copy_of, r._dup_lines, r._DUP_DOC, r.n_removed) for r in got] == [(7, 8, 9, 0), (7, 8, 9, 1)]
