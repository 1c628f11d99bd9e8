"""Exact quantiles, correlations, histograms and counts."""

import numpy as np
import pandas as pd
import pytest
from panels import as_spark

from barsignal.operators import eda
from barsignal.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(4)
    n = 20_000
    return pd.DataFrame({
        "normal": rng.normal(0, 1, n),
        "heavy": np.exp(rng.normal(0, 6, n)),
        "ties": rng.integers(0, 3, n).astype(float),
        "mostly_one": np.where(rng.random(n) < 0.9, 1.0, rng.random(n)),
        "gaps": np.where(rng.random(n) < 0.4, np.nan, rng.random(n)),
        "constant": 2.5,
        "spike": np.where(np.arange(n) == 5, 1e300, rng.random(n)),
        "Label": rng.integers(0, 2, n),
    })


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_quantiles_are_exact(spark, frame, rounds):
    columns = [c for c in frame if c != "Label"]
    got = {(r.name, r.prob): r["quantile"] for r in exact_quantiles(as_spark(spark, frame), columns, PROBS, rounds).collect()}
    for c in columns:
        for p in PROBS:
            assert got[c, p] == pytest.approx(frame[c].quantile(p), rel=1e-12, abs=1e-300), (c, p)


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_quantiles_of_few_values(spark, n):
    frame = pd.DataFrame({"x": [float(i * i) for i in range(n)]})
    got = {r.prob: r["quantile"] for r in exact_quantiles(spark.createDataFrame(frame), ["x"], PROBS).collect()}
    assert got == {p: pytest.approx(frame["x"].quantile(p)) for p in PROBS}


def test_describe_equals_pandas(spark, frame):
    columns = ["normal", "gaps", "ties", "constant"]
    got = eda.describe(as_spark(spark, frame), columns).toPandas().set_index("column")
    want = frame[columns].describe().T
    np.testing.assert_allclose(got.loc[columns].astype(float), want.astype(float), rtol=1e-9, atol=1e-12)


def test_describe_of_an_all_missing_column(spark):
    df = spark.sql("select 1 as a, cast(null as double) as b")
    rows = {r.column: r for r in eda.describe(df).collect()}
    assert (rows["b"]["count"], rows["b"].mean, rows["b"].p50) == (0, None, None)


def test_correlations_are_pairwise_complete(spark, frame):
    columns = ["normal", "gaps", "ties", "constant", "Label"]
    got = {(r.x, r.y): r["corr"] for r in eda.corr_matrix(as_spark(spark, frame), columns).collect()}
    want = frame[columns].corr()
    assert len(got) == 25
    for (a, b), c in got.items():
        if "constant" in (a, b):
            assert c is None
        else:
            assert c == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)


def test_correlations_of_any_partitions(spark, frame):
    """Merged blocks equal one block; constants, gaps, far-off means and empty columns keep their meaning."""
    rng = np.random.default_rng(8)
    data = pd.DataFrame({
        "far": 1e9 + rng.normal(0, 1, 3000), "near": rng.normal(0, 1, 3000), "steps": np.arange(3000) // 1000 * 1.0,
        "tenth": 0.1, "tenth_in_gaps": np.where(np.arange(3000) % 7 == 0, 0.1, np.nan), "none": np.nan,
    })
    data["near"] += data["far"] - 1e9
    columns, want = list(data), data.assign(far=data["far"] - 1e9).corr()  # the subtraction is exact
    df = as_spark(spark, data)
    for parts in (1, 3, 40):
        got = {(r.x, r.y): r["corr"] for r in eda.corr_matrix(df.repartition(parts), columns).collect()}
        assert len(got) == 36
        for (a, b), c in got.items():
            if {a, b} & {"tenth", "tenth_in_gaps", "none"}:
                assert c is None, (a, b, parts)
            else:
                assert c == pytest.approx(want.loc[a, b], abs=1e-9), (a, b, parts)
    nothing = eda.corr_matrix(df.limit(0), columns).collect()
    assert len(nothing) == 36 and all(r["corr"] is None for r in nothing)


def test_correlations_meet_odd_values(spark):
    df = spark.sql("""select * from values (1D, 2D, 1D), (2D, double('NaN'), 3D), (3D, 5D, null), (4D, 1D, 9D),
        (null, double('inf'), 2D) as t(a, b, c)""")
    got = {(r.x, r.y): r["corr"] for r in eda.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert np.isnan(got["a", "b"]) and np.isnan(got["b", "c"])
    assert got["a", "c"] == pytest.approx(np.corrcoef([1, 2, 4], [1, 3, 9])[0, 1])


def test_correlations_do_not_multiply_rows(spark, frame):
    plan = eda.corr_matrix(as_spark(spark, frame), ["normal", "gaps", "Label"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("MapInArrow")  # of finished pairs only


def test_correlation_ranking(spark):
    x = np.arange(100.0)
    frame = pd.DataFrame({"Label": (x > 60).astype(int), "up": x, "down": -x, "flat": 1.0, "weak": np.sin(x * 7)})
    df = spark.createDataFrame(frame)
    ranked = [r.feature for r in eda.corr_with_label(df, ["up", "down", "flat", "weak"]).collect()]
    assert (ranked[0], ranked[2:]) == ("up", ["down", "flat"])


def test_histogram_equals_numpy(spark, frame):
    rows = eda.histogram_by_label(as_spark(spark, frame), ["normal", "gaps", "constant"]).toPandas()
    for (feature, label), part in rows.groupby(["feature", "Label"]):
        x = frame.loc[frame["Label"] == label, feature].dropna()
        counts, edges = np.histogram(x, bins=30)
        part = part.sort_values("bin")
        assert part["count"].tolist() == counts.tolist(), feature
        np.testing.assert_allclose(part["bin_start"], edges[:-1], rtol=1e-9, atol=1e-12)


def test_counts(spark):
    df = spark.sql("""select * from values ('A', 1, 'T'), ('A', 0, 'T'), ('B', 1, 'E'), (null, null, 'E')
        as t(Stock_symbol, Label, category)""")
    assert [tuple(r) for r in eda.value_counts(df, "category").collect()] == [("E", 2, 50.0), ("T", 2, 50.0)]
    assert {r.column: (r.missing, r.percent) for r in eda.missing_values(df).collect()}["Label"] == (1, 25.0)
    assert {r.Stock_symbol: (r.label_0, r.label_1) for r in eda.label_by_symbol(df).collect()}["A"] == (0.5, 0.5)
    assert {tuple(r) for r in eda.sector_counts(df).collect()} == {("T", 2, 2), ("E", 2, 2)}
    assert eda.distinct_symbols(df).first().symbols == 2
