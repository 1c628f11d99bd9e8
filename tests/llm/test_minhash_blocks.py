"""Near copies that only meet in blocks of a bucket, and columns that clash."""

import numpy as np
from pyspark.sql import functions as F
from test_llm import oracle_components, shingles

from barsignal.llm import minhash
from barsignal.llm.common import prepare


def test_blocks_equal_brute_force(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(31)
    names = [f"t{i}" for i in range(400)]
    rows = []

    def edited(words, times):
        words = list(words)
        for place in rng.choice(len(words), times, replace=False):
            words[place] = str(rng.choice(names))
        return words

    # Versions of a text lie just below the threshold, so a hub links with one version's copies only.
    for _ in range(4):
        base = list(rng.choice(names, 80))
        for version in (edited(base, 3) for _ in range(5)):
            for _ in range(7):
                rows.append((len(rows) * 3, " ".join(edited(version, int(rng.integers(0, 3))))))
    sets = {d: shingles(t) for d, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.sketches(docs).withColumnRenamed("doc_id", "rep")
    banded = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    full = banded.groupBy("bucket").count().where("count > 1").select("bucket")
    # Nothing is linked yet: the blocks alone have to join what belongs together.
    none = spark.createDataFrame([], "node long, component long")
    found = minhash._between(banded.join(full, "bucket"), none, classes, docs.toDF("doc_id", "_text")).collect()
    pairs = {(min(r), max(r)) for r in found}
    want = oracle_components(list(sets), lambda a, b: (a, b) in links)
    assert pairs <= links and oracle_components(list(sets), lambda a, b: (a, b) in pairs) == want
    assert 1 < len(set(want.values())) < len(sets)


def member(rep, comp, out, text, band=0):
    found = minhash.shingle_set(text)
    return {"bucket": 1, "_block": 0, "_chunk": 0, "band": band, "rep": rep, "comp": comp, "_out": out,
            "n_shingles": len(found), "registers": minhash.registers(found).tobytes(), "_text": text}


def test_only_members_in_reach_need_texts():
    import pandas as pd

    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(900)], 60)) for _ in range(6)]
    near = texts[0] + " w1"
    members = [member(k, k, k != 0, t) for k, t in enumerate(texts)] + [member(9, 9, True, near)]
    members.append(member(0, 0, False, texts[0]))
    block = pd.DataFrame(members)
    asked = minhash._asked_of_block(block.drop(columns="_text"))
    assert set(block["rep"][asked]) == {0, 9}
    assert minhash._links_of_block(block) == [(9, 0)]
    inside = block[~block["_out"]]
    assert not minhash._asked_of_block(inside.drop(columns="_text")).any() and not minhash._links_of_block(inside)
    # Blocks are told apart wherever batches end.
    blocks = pd.concat([block.assign(_chunk=k) for k in range(4)], ignore_index=True)
    for size in (1, 5, 100):
        batches = [blocks.iloc[s : s + size] for s in range(0, len(blocks), size)]
        rows = pd.concat(minhash._by_block(minhash._asked)(iter(batches)))
        assert list(rows.columns) == minhash.MEMBER and sorted(rows["_chunk"]) == sorted(blocks["_chunk"][blocks["rep"].isin([0, 9])])
        assert len(pd.concat(minhash._by_block(minhash._links)(iter(batches)))) == 4


def test_texts_of_one_id_and_length_are_told_apart():
    import pandas as pd

    a, b, c = "one two three four five six", "one two three four five six", "six five four three two one"
    batch = pd.DataFrame({"a": [1, 1], "b": [2, 2], "ta": [a, a], "tb": [c, b]})
    assert [len(x) for x in minhash._confirm(iter([batch]))] == [1]


def test_clashing_columns_stay(spark):
    prepare(spark)
    rows = [(k, "a b c d e f g h", k * 2, "x") for k in range(3)] + [(7, "other words are in this text", 5, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone_id long, component_id string")
    left = minhash.first_of_groups(docs)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == [rows[0], rows[3]]
