"""Near-duplicate vectors by HNSW graphs per shard.

Equal vectors of a label are one class. The classes of a label are dealt into
shards of bounded size; one graph is built per shard and written to the shared
folder; every two shards of a label query each other's graphs (a shard also
its own), with beams that widen until a recall audit passes. What the graphs
propose is confirmed by cosine in double precision. A task returns the number
of links of each class and a spanning forest of the links it has found, so a
dense group never yields all its pairs.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import shared
from barsignal.llm.components import components
from barsignal.llm.hnsw import Graph
from barsignal.session import work_dir
from barsignal.sources.paths import arrow_path

COSINE = 0.98
SHARD = 4096
BEAM = 48
RECALL = 0.99
# Single-precision similarities this far below the threshold are confirmed.
SLACK = 1e-4


def usable(vector: str = "embedding") -> F.Column:
    """Whether a vector has a direction: no null, no component that is null or not finite, not zero."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _save(path: str, graph: Graph, exact: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
    fs, name = arrow_path(path)
    fs.create_dir(name.rpartition("/")[0], recursive=True)
    data = io.BytesIO()
    np.savez(data, exact=exact, ids=ids, copies=copies, level=graph.level, entry=graph.entry, **{f"near{k}": x for k, x in enumerate(graph.near)})
    with fs.open_output_stream(name) as out:
        out.write(data.getvalue())


def _load(path: str) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    fs, name = arrow_path(path)
    with fs.open_input_file(name) as f:
        z = np.load(io.BytesIO(f.read()))
        graph = Graph(np.empty((0, z["exact"].shape[1]), np.float32))
        graph.x = z["exact"].astype(np.float32)
        graph.level, graph.entry = z["level"], int(z["entry"])
        graph.near = [z[f"near{k}"] for k in range(sum(n.startswith("near") for n in z.files))]
        return graph, z["exact"], z["ids"], z["copies"]


def _build(folder: str):
    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid")
        x = np.array(group["_v"].tolist(), np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        path = f"{folder}/{uuid.uuid4().hex}.npz"
        _save(path, Graph(x), x, group["cid"].to_numpy(np.int64), group["copies"].to_numpy(np.int64))
        first = group.iloc[0]
        return pd.DataFrame({"label": [first["label"]], "dim": [first["dim"]], "shard": [first["shard"]], "path": [path]})

    return build


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join something new, one pass of union by smallest."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _query(cosine: float, beam: int, recall: float):
    def pairs(x, y, exact_x, exact_y) -> np.ndarray:
        """(row of x, row of y) found from either side and confirmed."""
        rows, points = y.within(exact_x, cosine - SLACK, beam, recall=recall)
        back, others = x.within(exact_y, cosine - SLACK, beam, recall=recall) if x is not y else (points, rows)
        both = np.unique(np.concatenate([rows * len(exact_y) + points, others * len(exact_y) + back]))
        rows, points = both // len(exact_y), both % len(exact_y)
        good = np.concatenate([np.empty(0, bool), *(
            np.einsum("nd,nd->n", exact_x[rows[s : s + 65536]], exact_y[points[s : s + 65536]]) >= cosine for s in range(0, len(rows), 65536)
        )])
        return rows[good], points[good]

    def query(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple] = {}
        for batch in batches:
            for p, q in zip(batch["p"], batch["q"], strict=True):
                for path in (p, q):
                    if path not in held:
                        if len(held) > 3:
                            held.clear()
                        held[path] = _load(path)
                if p not in held:
                    held[p] = _load(p)
                x, exact_x, ids_x, copies_x = held[p]
                y, exact_y, ids_y, copies_y = held[q]
                if p == q:
                    y, exact_y = x, exact_x
                rows, points = pairs(x, y, exact_x, exact_y)
                if p == q:
                    rows, points = rows[rows != points], points[rows != points]
                n = np.bincount(rows, copies_y[points], len(ids_x))
                count = pd.DataFrame({"a": ids_x, "b": None, "n": n.astype(np.int64)})
                yield _typed(count[n > 0])
                if p != q:
                    m = np.bincount(points, copies_x[rows], len(ids_y))
                    count = pd.DataFrame({"a": ids_y, "b": None, "n": m.astype(np.int64)})
                    yield _typed(count[m > 0])
                links = _forest(ids_x[rows], ids_y[points])
                yield _typed(pd.DataFrame(links, columns=["a", "b"]).assign(n=0))

    return query


def _typed(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.astype({"a": "Int64", "b": "Int64", "n": "int64"})


def near_vectors(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (vec_id, embedding, label).

    Links join vectors of one non-null label and one length. n_links counts
    the other rows linked directly; component_id is the smallest vec_id that
    links reach. Vectors without a direction, null labels and null ids link
    with nothing: their component is their own id, and they are kept. An id is
    taken to name one vector; rows of one id with several may share their links.
    """
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable()
    named = base.where(fit).withColumn("dim", F.size("embedding"))
    classes = named.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"))
    classes = shared(classes, "vector_classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("_n"))
    dealt = classes.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, ["label", "dim"]).select(
        "label", "dim", "cid", "copies", F.col("embedding").cast("array<double>").alias("_v"),
        F.pmod(F.xxhash64("cid"), F.ceil(F.col("_n") / shard)).cast("int").alias("shard"),
    )
    folder = work_dir(vectors.sparkSession, "graphs")
    kind = vectors.schema["label"].dataType.simpleString()
    graphs = shared(dealt.groupBy("label", "dim", "shard").applyInPandas(_build(folder), f"label {kind}, dim int, shard int, path string"), "graphs")
    other = graphs.select("label", "dim", F.col("shard").alias("_s"), F.col("path").alias("q"))
    work = graphs.withColumnRenamed("path", "p").join(other, ["label", "dim"]).where("shard <= _s").select("label", "dim", "shard", "_s", "p", "q")
    tasks = max(1, work.count())
    found = shared(work.repartition(min(tasks, 20_000), "label", "dim", "shard", "_s").select("p", "q").mapInPandas(_query(cosine, beam, recall), "a long, b long, n long"), "found_links")
    counts = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("_n"))
    comps = components(found.where("b is not null").select("a", "b")).toDF("cid", "_c")
    outcome = shared(
        classes.join(counts, "cid", "left").join(comps, "cid", "left")
        .select("label", "dim", "embedding", (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("_c", "cid").alias("component_id")), "class_links",
    )
    linked = named.join(outcome, ["label", "dim", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = base.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
