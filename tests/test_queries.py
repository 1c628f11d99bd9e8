"""The registered queries beside their SQL, on the smallest data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from barsignal.plans import standins
from barsignal.session import configure
from check import TYPES, normal

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert {n for n in QUERIES if n not in SQL and not n.startswith("op") and n != "pipeline"} == set()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(types)
    want = normal(result.fetchall(), [list(types).index(c) for c in columns])
    assert normal(df.collect(), [df.columns.index(c) for c in columns]) == want


def test_no_query_compares_all_pairs(spark):
    """No nested-loop or cross join in the plans of the heavy operators."""
    for name in ("merge", "model_set", "assign_folds", "match_model", "fold_results", "auc", "corr_matrix", "describe", "value_counts"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 5698 and "Sent_Lag3" in df.columns


def test_news_of_one_task_stay_small(spark, tmp_path):
    """However well the ids compress, a task of the join gets some megabytes of them."""
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    n = 40_000
    spark.range(n).selectExpr("id AS o_orderkey", "timestamp'1996-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(4 * n).selectExpr("id DIV 4 AS l_orderkey", "id % 5 AS l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS p_partkey", "'Brand#' || (id DIV 2) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    news = standins.news(spark, str(tmp_path))
    assert news.count() == len({(i // 4, i % 5 // 2) for i in range(4 * n)})
    plan = news._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_lines_are_shuffled_twice_for_the_news(spark, tmp_path):
    """The distinct rows of an order are found where it was joined; repeated lines, missing keys and unmatched rows do not count."""
    configure(spark)
    spark.sql("""SELECT * FROM VALUES (1L, timestamp'1996-01-01'), (2L, timestamp'1996-01-02'), (2L, timestamp'1996-01-02'),
        (2L, timestamp'1996-01-05'), (3L, null), (4L, timestamp'1996-01-04'), (null, timestamp'1996-01-04')
        AS t(o_orderkey, o_orderdate)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""SELECT * FROM VALUES (1L, 1L), (1L, 1L), (1L, 2L), (1L, 3L), (2L, 3L), (3L, 1L), (3L, null), (4L, 9L),
        (5L, 1L), (null, 1L) AS t(l_orderkey, l_partkey)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT * FROM VALUES (1L, 'A'), (2L, 'A'), (3L, null), (3L, 'B'), (null, 'C') AS t(p_partkey, p_brand)").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    news = standins.news(spark, str(tmp_path))
    assert sorted((tuple(map(str, r)) for r in news.collect())) == [
        ("1", "1996-01-01", "A"), ("1", "1996-01-01", "B"), ("1", "1996-01-01", "None"),
        ("2", "1996-01-02", "B"), ("2", "1996-01-02", "None"), ("2", "1996-01-05", "B"), ("2", "1996-01-05", "None"),
        ("3", "None", "A"),
    ]
    assert sorted(r.No for r in standins.article_sentiment(spark, str(tmp_path)).collect()) == [1, 2, 3, 4]
    # Both sides of two joins, and nothing for the distinct rows.
    plan = standins.news(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4 and "SortMergeJoin" not in plan
