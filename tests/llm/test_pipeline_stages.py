"""Every stage of the pipeline on odd rows, no rows and clashing columns."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from barsignal.llm.common import prepare

SF = "/root/testdata/sf0.001"
WORDS = " ".join(f"word{k}" for k in range(40))


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    base = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [None, "", " \n\n ", WORDS, WORDS, WORDS + "\n" + WORDS, "long " * 50_000, "éß 中文 \U0001f600"]
    odd = spark.createDataFrame([(900_000 + k, t) for k, t in enumerate(texts)] + [(900_003, WORDS), (None, WORDS), (None, None)], "doc_id long, text string")
    kinds = {f.name: f.dataType for f in base.schema}
    odd = odd.select(*[F.col(c).cast(kinds[c]).alias(c) if c in odd.columns else F.lit(None).cast(kinds[c]).alias(c) for c in base.columns])
    extra = {"_gone_id": F.lit(1), "_copy_of": F.lit("a"), "_benchmark_hits": F.lit(2.0), "_salt": F.lit(3), "hits": F.lit(4), "score": F.lit(5), "kept": F.lit(None).cast("boolean")}
    return base.limit(20).unionByName(odd).withColumns(extra)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("place", range(5))
def test_stage_on_odd_rows(spark, docs, place):
    name, stage = corpus_pipeline.STAGES[place]
    rows = stage(spark, docs, SF).collect()
    if place == 4:  # pieces: every document once, null texts as empty ones
        held = {r.doc_id for r in rows}
        assert held == {r.doc_id for r in docs.collect()}, name
        return
    left = stage(spark, docs, SF)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes, name
    assert all((r._gone_id, r._copy_of, r._benchmark_hits, r._salt, r.hits, r.score, r.kept) == (1, "a", 2.0, 3, 4, 5, None) for r in rows)
    ids = [r.doc_id for r in rows]
    if name in ("line dedup", "benchmark decontamination"):
        assert 900_000 in ids and 900_001 in ids and None in ids, name
    if name == "line dedup":
        assert len(rows) == docs.count()
    if name == "minhash near-dedup":
        assert {900_000, 900_001, 900_002, 900_003, None} <= set(ids) and not {900_004} & set(ids), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("place", range(5))
def test_stage_on_no_rows(spark, docs, place):
    name, stage = corpus_pipeline.STAGES[place]
    assert stage(spark, docs.limit(0), SF).count() == 0, name
