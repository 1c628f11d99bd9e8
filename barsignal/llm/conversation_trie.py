"""Prefix trie of conversations in shards of balanced parentheses.

Every conversation becomes the sequence of its turns' digests. Equal sequences
are one path with a count; paths are range-partitioned in the order of their
digests, so the members of a trie node stand together. A shard writes its part
of the trie as balanced parentheses: findclose over range min-max blocks gives
a node's subtree, differences of ranks its nodes and leaf pairs, differences
of cumulative arrays its members and savings.

Only nodes on a shard's first and last path can have members in other shards.
These spines leave a shard as partial sums and are merged by their prefix's
digest. What a spine node adds to its ancestors' subtrees must count once: the
least path that holds it owns it, the nodes that a path owns are its lower
end, and so sums from below along each path give every ancestor its share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import shared
from barsignal.llm.parentheses import Parentheses, range_minima

DIGEST = 16  # bytes of a turn's and of a prefix's digest
HEAD_TURNS = 6  # borrowed turns are fewer
FAMILY = 100
# Trie nodes of a shard, about.
SHARD_NODES = 100_000
# Ids joined before they meet the other members of their path.
IDS_AT_ONCE = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

PATHS = "path binary, sizes array<long>, members long, least long, ends string"
NODES = (
    "node binary, depth long, parent binary, parent_conv_id long, last_size long, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, shard long, side int"
)


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``: (place, digest, code points) in order of turn, null first, then role and the text's digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.struct(role.alias("role"), F.sha2(text.cast("binary"), 256).alias("sha"), F.length(text).alias("n")).alias("said"),
        # The length of the role keeps "a" + "bc" and "ab" + "c" apart.
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"), 256).substr(1, 2 * DIGEST).alias("digest"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "said.role", "said.sha")
    placed = known.withColumn("place", F.row_number().over(order) - 1)
    turn = F.struct("place", "digest", F.col("said.n").cast("long").alias("n"))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def borrowed(conv_id: Column) -> Column:
    """h: turns that a conversation takes from the first of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD_TURNS).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and the rebuilt ``turns`` of every conversation."""
    own = shared(turn_digests(conversations), "conversations")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_head_id"), F.slice("turns", 1, HEAD_TURNS).alias("_head")
    )
    joined = own.withColumn("_h", borrowed(F.col("conv_id"))).join(
        heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_head_id"), "left"
    )
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def distinct_paths(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence: digests, sizes, members, least id, and the digest of the ids.

    Ids meet in two steps: runs of ids by number, then the runs of a path in
    order through one running digest, which holds one run at a time.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    runs = conversations.select(
        "conv_id", path.alias("path"), F.transform("turns", lambda t: t["n"]).alias("sizes"),
        F.floor(F.col("conv_id") / IDS_AT_ONCE).alias("run"),
    ).groupBy("path", "run").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("members"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
    )
    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, held, sha = None, None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.path != path:
                    if path is not None:
                        out.append((*held, sha.hexdigest()))
                    path, held, sha = row.path, [row.path, row.sizes, 0, row.least], hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(row.ids.encode())
                held[2] += row.members
                held[3] = min(held[3], row.least)
            yield pd.DataFrame(out, columns=["path", "sizes", "members", "least", "ends"])
        if path is not None:
            yield pd.DataFrame([(*held, sha.hexdigest())], columns=["path", "sizes", "members", "least", "ends"])

    return runs.repartition("path").sortWithinPartitions("path", "run").mapInPandas(digested, PATHS)


def _common(a: bytes, b: bytes) -> int:
    """Digests that two paths share from the start."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    return next(i for i in range(n) if a[i * DIGEST : (i + 1) * DIGEST] != b[i * DIGEST : (i + 1) * DIGEST])


class Shard:
    """The part of the trie that a run of paths in ascending order spans."""

    def __init__(self, paths: list[tuple[bytes, list[int], int, int, str]], number: int) -> None:
        self.number = number
        bits: list[int] = [1]
        self.node, self.parent, self.depth, self.size = [b""], [-1], [0], [0]
        self.copies, self.least, self.ends = [0], [np.iinfo(np.int64).max], [EMPTY_SHA]
        stack, before = [0], b""
        for path, sizes, members, least, ends in paths:
            same = _common(before, path)
            bits += [0] * (len(stack) - 1 - same)
            del stack[same + 1 :]
            for d in range(same, len(path) // DIGEST):
                own = path[d * DIGEST : (d + 1) * DIGEST]
                self.node.append(hashlib.sha256(self.node[stack[-1]] + own).digest()[:DIGEST])
                self.parent.append(stack[-1])
                self.depth.append(d + 1)
                self.size.append(int(sizes[d]))
                self.copies.append(0)
                self.least.append(np.iinfo(np.int64).max)
                self.ends.append(EMPTY_SHA)
                stack.append(len(self.node) - 1)
                bits.append(1)
            self.copies[stack[-1]], self.least[stack[-1]], self.ends[stack[-1]] = members, least, ends
            before = path
            if path == paths[0][0]:
                first = list(stack)
        bits += [0] * len(stack)
        self.bits, self.spines = np.array(bits, np.int8), (first, list(stack))

    def rows(self) -> pd.DataFrame:
        """Whole results of inner nodes, partial sums of spine nodes (side 0 and 1; 2 for inner nodes)."""
        sizes, leaves = Parentheses(self.bits).subtrees()
        n = len(self.node)
        parent, points = np.array(self.parent), np.array(self.size, np.int64)
        at, beyond = np.arange(n), np.arange(n) + sizes

        def below(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[beyond] - sums[at]

        members = below(np.array(self.copies, np.int64))
        spine = np.zeros(n, bool)
        spine[self.spines[0] + self.spines[1]] = True
        savings = np.where(spine, 0, (members - 1) * points)
        inner_leaves = np.where(spine & (sizes == 1), 0, leaves)
        # A spine node's leaves without spine nodes that are childless here.
        bare = below((spine & (sizes == 1)).astype(np.int64))
        inner_leaves = np.where(spine, leaves - bare, leaves)
        children = np.bincount(parent[1:][~spine[1:]], minlength=n) if n > 1 else np.zeros(n, np.int64)
        least = range_minima(np.array(self.least, np.int64), sizes)
        known = ~spine & (parent >= 0) & ~spine[np.maximum(parent, 0)]
        table = pd.DataFrame({
            "node": self.node, "depth": np.array(self.depth, np.int64),
            "parent": [None if p < 0 else self.node[p] for p in self.parent],
            "parent_conv_id": pd.array(np.where(known, least[np.maximum(parent, 0)], 0), "Int64"),
            "last_size": points, "conv_id": least, "n_convs": members, "n_children": children.astype(np.int64),
            "n_leaves": inner_leaves, "saved_tokens": below(savings), "ends_sha256": self.ends,
            "shard": np.int64(self.number), "side": np.int32(2),
        })
        table.loc[~known, "parent_conv_id"] = pd.NA
        inner, (first, last) = table[~spine], self.spines
        left = table.iloc[first].assign(side=np.int32(0))
        right = table.iloc[last].assign(side=np.int32(1))
        # What both spines hold is counted on the first.
        twice = right["depth"].to_numpy() < sum(a == b for a, b in zip(first, last, strict=False))
        right.loc[twice, ["n_convs", "n_children", "n_leaves", "saved_tokens"]] = 0
        right.loc[twice, "ends_sha256"] = EMPTY_SHA
        return pd.concat([inner, left, right])


def _sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    paths = [tuple(row) for batch in batches for row in batch.itertuples(index=False, name=None)]
    if paths:
        yield Shard(paths, TaskContext.get().partitionId()).rows()


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node.

    Columns: conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Rows without conv_id
    belong to no conversation; null roles and texts are empty; equal turns of
    one conversation are ordered by role and digest of the text, repeated rows are
    repeated turns; further columns are not read. A table without
    conversations has no node. One conversation's turn digests, about 100
    bytes a turn, are held together.
    """
    paths = shared(distinct_paths(rebuilt(conversations.select("conv_id", "turn", "role", "text"))), "paths")
    total = paths.agg(F.coalesce(F.sum(F.size("sizes")), F.lit(0)).alias("n")).collect()[0]["n"]
    ordered = paths.repartitionByRange(max(1, -(-total // shard_nodes)), "path").sortWithinPartitions("path")
    nodes = shared(ordered.mapInPandas(_sharded, NODES), "trie_parts")
    inner = nodes.where("side = 2")
    spines = _merged(nodes.where("side < 2"))
    above = spines.select(F.col("node").alias("_above"), F.col("conv_id").alias("_above_id"))
    every = inner.select(*spines.columns).unionByName(spines)
    named = every.join(above, F.col("parent_conv_id").isNull() & (F.col("parent") == F.col("_above")), "left")
    return named.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above_id").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def _merged(parts: DataFrame) -> DataFrame:
    """One row per spine node from its parts."""
    path = F.struct("shard", "side")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ends = F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY_SHA, F.col("ends_sha256"))), F.lit(EMPTY_SHA))
    whole = parts.groupBy("node", "depth", "parent", "last_size").agg(
        F.min("conv_id").alias("conv_id"), *sums, ends.alias("ends_sha256"), F.min(path).alias("owner"),
    )
    spine_children = whole.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_p")).agg(F.count("*").alias("_c"))
    whole = whole.join(spine_children, F.col("node") == F.col("_p"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("_c", F.lit(0))
    ).drop("_p", "_c")
    whole = shared(whole, "spines")
    own = whole.select(
        F.col("node").alias("_n"), "owner", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("_leaf"),
        ((F.col("n_convs") - 1) * F.col("last_size")).alias("_saved"),
    )
    mine = F.col("owner") == path
    from_below = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    shares = (
        parts.select("node", "depth", "shard", "side").join(own, F.col("node") == F.col("_n"))
        .withColumn("_leaves", F.sum(F.when(mine, F.col("_leaf")).otherwise(0)).over(from_below))
        .withColumn("_savings", F.sum(F.when(mine, F.col("_saved")).otherwise(0)).over(from_below))
        .groupBy(F.col("node").alias("_n")).agg(F.sum("_leaves").alias("_leaves"), F.sum("_savings").alias("_savings"))
    )
    return whole.join(shares, F.col("node") == F.col("_n")).select(
        "node", "depth", "parent", F.lit(None).cast("long").alias("parent_conv_id"), "conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("_savings")).alias("saved_tokens"), "ends_sha256",
    )
