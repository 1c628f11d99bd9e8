"""The conversation trie against plain Python, over any number of shards, and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from barsignal.llm import conversation_trie
from barsignal.llm.common import prepare
from barsignal.llm.parentheses import Parentheses, range_minima

SCHEMA = "conv_id long, turn int, role string, text string"


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest()), (role, text)))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    out = []
    for node, who in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node],
            sum(not children[x] for x in below), saved, hashlib.sha256(ids.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("shard_nodes", [3, 17, 100_000])
def test_trie_equals_plain_python(spark, shard_nodes):
    prepare(spark)
    rng = random.Random(shard_nodes)
    rows = []
    for c in rng.sample(range(0, 900), 120) + [-5, -120, 5000]:
        same = rng.random() < 0.4  # a common conversation, a common first turn
        for turn in range(rng.randint(1, 9)):
            said = "hot" if same or (turn == 0 and rng.random() < 0.6) else rng.choice("abc") * rng.randint(0, 3) + "\U0001f600"
            rows.append((c, rng.choice([turn, turn, turn, None]), "user" if turn % 2 else None, said if rng.random() < 0.95 else None))
    rows += [(None, 1, "user", "nobody"), rows[0], rows[5]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as path", "2 as turns", "3 as node")
    assert found(conversation_trie.prefix_trie(df, shard_nodes)) == by_hand(rows)


def test_long_conversation_and_empty_table(spark):
    prepare(spark)
    rows = [(700, i, "r", f"t{i}") for i in range(600)] + [(701, i, "r", f"t{i}") for i in range(300)] + [(702, 0, "r", "x" * 100_000)]
    assert found(conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 50)) == by_hand(rows)
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_of_a_path_meet_in_runs(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "IDS_AT_ONCE", 4)
    prepare(spark)
    rows = [(c, 0, "u", "same") for c in range(0, 40_000, 1000)]
    assert found(conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_parentheses_against_a_stack():
    rng = np.random.default_rng(4)
    for n in (1, 2, 31, 32, 33, 64, 65, 500, 3000):
        bits, depth, opened = [], 0, 0
        while opened < n or depth:
            if opened < n and (depth == 0 or rng.random() < (0.5 if n != 500 else 0.98)):
                bits, depth, opened = [*bits, 1], depth + 1, opened + 1
            else:
                bits, depth = [*bits, 0], depth - 1
        stack, close = [], {}
        for at, b in enumerate(bits):
            if b:
                stack.append(at)
            else:
                close[stack.pop()] = at
        bp = Parentheses(np.array(bits))
        assert bp.find_close(bp.opens).tolist() == [close[int(o)] for o in bp.opens]
        sizes, leaves = bp.subtrees()
        for i, o in enumerate(bp.opens):
            inside = bits[o : close[int(o)] + 1]
            assert sizes[i] == sum(inside) and leaves[i] == sum(a == 1 and b == 0 for a, b in zip(inside, inside[1:], strict=False))
        values = rng.integers(0, 1000, n)
        assert range_minima(values, sizes).tolist() == [values[i : i + s].min() for i, s in enumerate(sizes)]
