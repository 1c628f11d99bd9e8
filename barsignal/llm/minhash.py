"""Near-duplicate documents by HyperMinHash over word shingles.

Every bucket (one hash function each) keeps of its minimum the leading-zero
count and a few mantissa bits: 16 bits a register. Bands of registers propose
candidates; the share of equal registers, corrected for chance collisions,
estimates the Jaccard index; what may reach the threshold is confirmed on the
full shingle sets.

Documents of one shingle set are one class. A band's bucket never yields all
its pairs: first every member meets the bucket's hub, the class that meets most
others over all buckets (the original of many copies, as a rule); then, only
in buckets that still hold several components, members outside the largest one
meet all members in blocks of bounded size: registers alone name the members in
reach of another, whose texts are then read, and their pairs are confirmed from
the likeliest on until their components have met. A pair is tried in the
first band it shares. Every pair of a bucket is thus confirmed, refuted,
estimated out of reach, or already connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import free_names, shared
from barsignal.llm.components import components
from barsignal.llm.words import mix, text_bytes, word_hashes

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
ROWS_PER_BAND = 4
BANDS = 28
REGISTERS = ROWS_PER_BAND * BANDS
MANTISSA = 10
# An estimate has a deviation of 0.041 at 0.75: pairs below this are out of reach.
REACH = 0.57
BLOCK = 256

_SEEDS = mix(np.arange(1, 2 * REGISTERS + SHINGLE + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLACES = _SEEDS[:SHINGLE]
_FACTORS = _SEEDS[SHINGLE : SHINGLE + REGISTERS]
_OFFSETS = _SEEDS[SHINGLE + REGISTERS : SHINGLE + 2 * REGISTERS]

# A bucket's members meet in blocks: the part of all members, the part of those outside its largest component.
BLOCK_KEYS = ["bucket", "_block", "_chunk"]
MEMBER = [*BLOCK_KEYS, "band", "rep", "comp", "_out"]

SKETCH = "doc_id long, n_shingles long, set_id binary, registers binary, bands array<bigint>"


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; fewer words than a shingle count as one."""
    words = word_hashes(text_bytes(text).lower(), "space")
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += words[k : n - size + 1 + k] * _PLACES[k]
    return np.unique(mix(total))


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers: leading zeros of each bucket's minimum, then its mantissa."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 256):
        values = shingles[k : k + 256, None] * _FACTORS
        values += _OFFSETS
        np.minimum(low, values.min(0), out=low)
    fraction, exponent = np.frexp(np.maximum(low, np.uint64(1)).astype(np.float64))
    zeros = np.minimum(64 - exponent, 62)
    mantissa = np.minimum(((fraction - 0.5) * 2 * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    return ((np.maximum(zeros, 0) << MANTISSA) | mantissa).astype("<u2")


def band_keys(values: np.ndarray) -> np.ndarray:
    parts = values.astype(np.uint64).reshape(BANDS, ROWS_PER_BAND)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS_PER_BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.astype(np.int64)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of different minima of sets of n and m shingles are equal."""
    edges = 0.5 ** np.arange(0, 64)
    def shares(x):
        above = np.exp(-np.multiply.outer(np.asarray(x, float), edges))  # minimum lies above 2^-i
        return np.diff(above, axis=-1, append=1.0)
    return (shares(n) * shares(m)).sum(-1) / (1 << MANTISSA)


def estimate(equal_share: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    chance = collisions(n, m)
    return (equal_share - chance) / (1 - chance)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch["_key"], batch["_text"], strict=True):
            found = shingle_set(text)
            if len(found):
                values = registers(found)
                name = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                rows.append((doc, len(found), name, values.tobytes(), band_keys(values)))
            else:
                rows.append((doc, 0, None, None, None))
        out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_id", "registers", "bands"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_id, registers and bands of whole texts; the last three null for an empty set."""
    return docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).mapInPandas(_sketch, SKETCH)


def _equal_share(a: Column, b: Column, n: Column, m: Column) -> Column:
    @F.pandas_udf("double")
    def of(x: pd.Series, y: pd.Series, nx: pd.Series, ny: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        p, q = (np.frombuffer(b"".join(s), "<u2").reshape(-1, REGISTERS) for s in (x, y))
        return pd.Series(estimate((p == q).mean(1), nx.to_numpy(), ny.to_numpy()))

    return of(a, b, n, m)


def _in_reach(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose estimate leaves the threshold in reach."""
    side = classes.select("rep", "n_shingles", "registers")
    joined = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
    # Sizes alone bound the index.
    sized = joined.where(DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb"))
    return sized.where(_equal_share(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb")) >= REACH).select("a", "b").distinct()


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kept: dict[str, np.ndarray] = {}

    def of(text):
        if text not in kept:
            if len(kept) > 64:
                kept.clear()
            kept[text] = shingle_set(text)
        return kept[text]

    for batch in batches:
        good = [_near(of(a), of(b)) for a, b in zip(batch["ta"], batch["tb"], strict=True)]
        yield batch.loc[np.array(good, bool), ["a", "b"]]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs confirmed on the full sets of both texts."""
    joined = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return joined.mapInPandas(_confirm, "a long, b long").distinct()


def _pairs_in_reach(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray, np.ndarray]:
    """Members outside the bucket's largest component, all members of the block, and the
    places of their pairs between components that are in reach, likeliest first."""
    mine, others = group[group["_out"]], group[~group["_out"]]
    both = pd.concat([mine, others]).drop_duplicates("rep")
    if not len(mine):
        return mine, both, np.empty(0, np.int64), np.empty(0, np.int64)
    p, q = (np.frombuffer(b"".join(x["registers"]), "<u2").reshape(-1, REGISTERS) for x in (mine, both))
    share, first = np.zeros((len(p), len(q)), np.int16), np.full((len(p), len(q)), BANDS, np.int16)
    for band in range(BANDS - 1, -1, -1):
        all_equal = np.ones(share.shape, bool)
        for k in range(band * ROWS_PER_BAND, (band + 1) * ROWS_PER_BAND):
            equal = p[:, k, None] == q[None, :, k]
            share += equal
            all_equal &= equal
        first[all_equal] = band
    n, m = np.meshgrid(mine["n_shingles"], both["n_shingles"], indexing="ij")
    fits = (DENOMINATOR * np.minimum(n, m) >= NUMERATOR * np.maximum(n, m)) & (share >= REACH * REGISTERS)
    fits &= (mine["comp"].to_numpy()[:, None] != both["comp"].to_numpy()[None]) & (first == group["band"].iloc[0])
    rows, cols = np.nonzero(fits)
    guess = estimate(share[rows, cols] / REGISTERS, n[rows, cols], m[rows, cols]) if len(rows) else np.empty(0)
    order = np.argsort(-guess, kind="stable")
    order = order[guess[order] >= REACH]
    return mine, both, rows[order], cols[order]


def _asked_of_block(group: pd.DataFrame) -> np.ndarray:
    """Whether each member of a block is in a pair in reach: only their texts are needed."""
    mine, both, rows, cols = _pairs_in_reach(group)
    if not len(rows):
        return np.zeros(len(group), bool)
    return np.isin(group["rep"].to_numpy(), np.concatenate([mine["rep"].to_numpy()[rows], both["rep"].to_numpy()[cols]]))


def _links_of_block(group: pd.DataFrame) -> list[tuple[int, int]]:
    """Links between components, of members outside the bucket's largest one with all members of the block."""
    mine, both, rows, cols = _pairs_in_reach(group)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sets: dict[str, np.ndarray] = {}
    own, own_comps, own_texts = (mine[c].to_numpy() for c in ("rep", "comp", "_text"))
    reps, comps, texts = (both[c].to_numpy() for c in ("rep", "comp", "_text"))
    out = []
    for i, j in zip(rows, cols, strict=True):
        x, y = find(own_comps[i]), find(comps[j])
        if x == y:
            continue
        for text in (own_texts[i], texts[j]):
            if text not in sets:
                sets[text] = shingle_set(text)
        if _near(sets[own_texts[i]], sets[texts[j]]):
            root[max(x, y)] = min(x, y)
            out.append((own[i], reps[j]))
    return out


def _near(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)


def _by_block(work):
    """``work`` on runs of whole blocks, given with the ends of the blocks in them."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = batch[BLOCK_KEYS].to_numpy()
            ends = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()]
            if len(ends) > 1:
                yield work(batch.iloc[: ends[-1]], ends)
            rest = batch.iloc[ends[-1] :]
        if rest is not None and len(rest):
            yield work(rest, [0, len(rest)])

    return blocks


def _asked(rows: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
    found = [_asked_of_block(rows.iloc[s:e]) for s, e in zip(ends, ends[1:], strict=False)]
    return rows.loc[np.concatenate(found), MEMBER]


def _links(rows: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
    found = [p for s, e in zip(ends, ends[1:], strict=False) for p in _links_of_block(rows.iloc[s:e])]
    return pd.DataFrame(found, columns=["a", "b"])


def _between(members: DataFrame, comps: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share a bucket."""
    now = members.join(comps.toDF("rep", "_comp"), "rep", "left").select("bucket", "band", "rep", F.coalesce("_comp", "rep").alias("comp"))
    now = shared(now, "bucket_members")
    open_buckets = now.groupBy("bucket").agg(F.count("*").alias("_n"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
    open_buckets = open_buckets.where("_lo <> _hi").select("bucket", "_n")
    sizes = now.groupBy("bucket", "comp").agg(F.count("*").alias("_k")).groupBy("bucket").agg(
        F.max(F.struct("_k", "comp")).alias("_main")
    )
    buckets = shared(open_buckets.join(sizes, "bucket").select("bucket", "_n", F.col("_main.comp").alias("_main"), (F.col("_n") - F.col("_main._k")).alias("_o")), "open_buckets")
    sides = classes.select("rep", "n_shingles", "registers")
    here = now.join(buckets, "bucket")
    here = here.withColumns({
        "_blocks": F.ceil(F.col("_n") / BLOCK).cast("int"), "_chunks": F.ceil(F.col("_o") / BLOCK).cast("int"),
        "_out": F.col("comp") != F.col("_main"),
    })
    def dealt(name):
        return F.pmod(F.xxhash64("rep", F.lit(name)), F.col(f"_{name}s")).cast("int")

    columns = ["bucket", "band", "rep", "comp"]
    own = here.select(*columns, F.lit(False).alias("_out"), dealt("block").alias("_block"), F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"))
    out = here.where("_out").select(*columns, "_out", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), dealt("chunk").alias("_chunk"))

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)

    met = own.unionByName(out).select(*MEMBER)
    # Registers say which members of a block need their texts; a text goes nowhere before.
    asked = shared(together(met.join(sides, "rep")).mapInPandas(_by_block(_asked), met.schema), "asked")
    read = asked.join(sides, "rep").join(texts.toDF("rep", "_text"), "rep")
    return together(read).mapInPandas(_by_block(_links), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    component_id is the smallest doc_id reachable over links (100 x
    intersection >= 75 x union of the shingle sets). A text without words has
    no shingles and links with nothing. Rows of one doc_id are one node; a
    null doc_id links with nothing, has a null component_id and is kept.
    """
    # Hashing a text costs far more than reading it: sketches are written once.
    found = shared(sketches(docs, key, text), "sketches")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text")).where("doc_id is not null and _text is not null")
    known = found.where("set_id is not null and doc_id is not null")
    classes = shared(
        known.groupBy("set_id").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.first("bands").alias("bands"),
        ), "classes",
    )
    banded = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("band").alias("band"), F.min("rep").alias("_r"), F.bit_xor(F.xxhash64("rep")).alias("x")).where("n > 1")
    # Buckets of the same members say the same: the one of the first band stands for them.
    full = full.groupBy("n", "_r", "x").agg(F.min(F.struct("band", "bucket")).alias("_b"))
    full = shared(full.select("_b.bucket", "n"), "buckets")
    members = shared(banded.join(full, "bucket").distinct(), "members")
    degrees = shared(members.groupBy("rep").agg(F.sum("n").alias("_d")), "degrees")
    ranked = members.join(degrees, "rep").groupBy("bucket").agg(F.max(F.struct("_d", (-F.col("rep")).alias("_m"))).alias("_hub"))
    hubs = shared(ranked.select("bucket", (-F.col("_hub._m")).alias("hub")), "hubs")
    pairs = members.join(hubs, "bucket").where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    tried = _in_reach(pairs, classes)
    # Only classes that share a bucket can be asked for again.
    texts = shared(texts.join(degrees.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "candidate_texts")
    links = shared(_verified(tried, texts), "links")
    links = links.union(shared(_between(members.select("bucket", "band", "rep"), components(links), classes, texts), "more_links"))
    # Copies link with their class, rows of one doc_id with one another.
    same = known.join(classes.select("set_id", "rep"), "set_id").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comps = components(links.union(same)).toDF("doc_id", "component_id")
    return (
        found.select("doc_id", "n_shingles").join(comps, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those whose component has a smaller doc_id; all columns stay."""
    (gone_id,) = free_names(docs, "_gone_id")
    gone = near_duplicates(docs, key, text).where("not kept").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, F.col(key) == F.col(gone_id), "left_anti")
