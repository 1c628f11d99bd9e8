"""Folds against their definition by dates; model matching."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barsignal.functions import scalars
from barsignal.operators import folds


def days(spark, n, category="A", rows=1):
    base = spark.range(n * rows).select(
        F.lit(category).alias("category"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.floor(F.col("id") / rows) * 2).cast("int")).alias("Date"),
    )
    return base


def by_definition(n, train, test):
    out = []
    for start in range(train, n, test):
        last = min(start + test - 1, n - 1)
        out.append((start - train, start - 1, start, last))
    return out


def at(i):
    return date(2020, 1, 1) + timedelta(days=2 * i)


@pytest.mark.parametrize("n", [0, 1, 252, 253, 273, 274, 300, 505])
def test_fold_table(spark, n):
    got = folds.fold_table(days(spark, n, rows=2)).orderBy("fold").collect()
    want = by_definition(n, 252, 21)
    assert [(r.train_start, r.train_end, r.test_start, r.test_end) for r in got] == [tuple(map(at, w)) for w in want]
    assert [r.fold for r in got] == list(range(len(want)))


def test_assignment_equals_comparing_dates(spark):
    rng = random.Random(5)
    for _ in range(6):
        n, train, test = rng.randint(5, 120), rng.randint(1, 40), rng.randint(1, 30)
        got = folds.assign_folds(days(spark, n), train, test).collect()
        want = []
        for k, (a, b, c, d) in enumerate(by_definition(n, train, test)):
            want += [(at(i), k, "train") for i in range(a, b + 1)] + [(at(i), k, "test") for i in range(c, d + 1)]
        assert sorted((r.Date, r.fold, r.role) for r in got) == sorted(want), (n, train, test)
        tests = [r.Date for r in got if r.role == "test"]
        assert len(tests) == len(set(tests))


def test_counts_do_not_repeat_rows(spark):
    table = days(spark, 300, "A", 3).unionByName(days(spark, 260, "B", 2)).unionByName(days(spark, 20, "C", 2))
    got = {(r.category, r.fold): (r.n_train, r.n_test) for r in folds.fold_counts(table).collect()}
    assert got == {("A", 0): (756, 63), ("A", 1): (756, 63), ("A", 2): (756, 18), ("B", 0): (504, 16)}


def test_no_nested_loop_join(spark):
    plan = folds.assign_folds(days(spark, 300))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_match_model(spark):
    periods = spark.sql("""select * from values
        ('A', 0, date'2020-01-01', date'2020-01-21'), ('A', 1, date'2020-03-01', date'2020-03-10'),
        ('A', 2, date'2020-05-01', date'2020-05-10'), ('B', 0, date'2020-01-01', date'2020-01-21'),
        ('A', 3, date'2020-07-07', date'2020-07-07'), ('A', 4, date'2020-08-01', date'2020-08-09')
        as t(category, fold, test_start, test_end)""")
    registry = spark.sql("""select * from values
        ('A', date'2020-01-01', date'2020-01-21', 'exact'), ('A', date'2019-01-01', date'2021-01-21', 'wide'),
        ('A', date'2020-03-05', date'2020-03-20', 'late'), ('A', date'2020-08-01', date'2020-08-05', 'first'),
        ('A', date'2020-08-05', date'2020-08-09', 'second'), ('A', date'2020-07-07', date'2020-07-07', 'one day')
        as t(category, test_start, test_end, model_path)""")

    def matched(registry):
        return {(r.category, r.fold): r.model_path for r in folds.match_model(periods, registry).collect()}

    got = matched(registry)
    assert got["A", 0] == "exact" and got["A", 1] == "wide" and got["A", 3] == "one day" and got["B", 0] is None
    got = matched(registry.where("model_path <> 'wide'"))
    assert got["A", 1] == "late" and got["A", 2] is None
    assert got["A", 4] == "first"  # equal overlaps: the earlier period
    touching = spark.sql("select 'A' as category, date'2020-05-10' as test_start, date'2020-05-30' as test_end, 'touch' as model_path")
    assert matched(touching)["A", 2] is None  # one shared day is no overlap


def test_model_names_round_trip(spark):
    df = folds.fold_table(days(spark, 300))
    dates = [F.col(c) for c in scalars.MODEL_DATE_FIELDS]
    named = df.withColumn("name", scalars.format_model_name(*dates))
    parsed = named.select(*[(p.eqNullSafe(d)).alias(f"ok{i}") for i, (p, d) in enumerate(zip(scalars.parse_model_name(F.col("name")), dates))])
    assert all(all(r) for r in parsed.collect())
    odd = spark.createDataFrame([("model_train_1_to_2.pkl",), ("notes.txt",)], "name string")
    assert all(v is None for r in odd.select(*scalars.parse_model_name(F.col("name"))).collect() for v in r)


def test_months_and_dates(spark):
    assert folds.distinct_months(days(spark, 40)).count() == 3
    assert [r.Date for r in folds.sorted_dates(days(spark, 3, rows=2)).collect()] == [at(0), at(1), at(2)]
