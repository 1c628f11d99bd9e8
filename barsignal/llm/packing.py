"""Best-fit packing of documents into sequences by bin completion.

Token ids of a document are cut into pieces only where it is longer than a
sequence. Pieces of one length are interchangeable, so the search works on the
counts per length, at most one row per length whatever the number of
documents. First-fit and best-fit decreasing and a greedy completion, which
takes the least waste for one bin after the other, give the first solutions.
Where the best of them is above the lower bound, branch and bound goes on: the
bin of the largest piece left is completed by every filling that no other
filling dominates, the least waste first; a branch ends when its waste exceeds
what a solution with fewer bins could waste; bins are taken back and filled
anew. Fillings go by (length, times), so equal pieces are one node. The search
ends at the bound or after ``NODES`` nodes, and never returns more bins than
the first solutions have. The pieces then find their places by their rank
within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import free_names, shared
from barsignal.llm.tokens import encoder

CAPACITY = 2048
# Fillings that the search looks at, at most: a parameter of the packing.
NODES = 20_000
# Pieces of a length that are ranked together, about, and the least number of parts.
PIECES_PER_PART, PARTS = 50_000, 256

PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"


def crc_of_ids(ids: bytes, dtype: np.dtype) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes())


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every whole text, the end id included.

    Returns doc_id, piece, start, length, ids (little-endian, two bytes each
    for vocabularies up to 65,536 and four beyond; null without ``with_ids``)
    and ids_crc32. A null or empty text is the end id alone; repeated rows
    each give their pieces; a null key stays null.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(tokenizer)
        width = coder.dtype.itemsize
        end = np.array([end_id], coder.dtype).tobytes()
        step = capacity * width
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["_key"], coder.batch(batch["_text"].tolist()), strict=True):
                ids += end
                for k in range(0, len(ids), step):
                    part = ids[k : k + step]
                    rows.append((
                        doc, k // step, k // width, len(part) // width, part if with_ids else None, crc_of_ids(part, coder.dtype),
                    ))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).mapInPandas(cut, PIECES)


Bins = list[tuple[int, tuple[int, ...]]]


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Bins:
    """Bins for ``counts`` of each length: (times, lengths of the bin, descending), as few as the search finds."""
    counts = {length: n for length, n in counts.items() if n > 0}
    first = [least_waste(counts, capacity), first_fit(counts, capacity), best_fit(counts, capacity)]
    best = min(first, key=n_bins)
    bound = lower_bound(counts, capacity)
    return _search(counts, capacity, best, bound, nodes) if n_bins(best) > bound else best


def n_bins(bins: Bins) -> int:
    return sum(times for times, _ in bins)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by the sum, and by pieces that exclude one another."""
    total = sum(x * n for x, n in counts.items())
    best = -(-total // capacity)
    large = sorted(x for x in counts if 2 * x > capacity)
    small = sorted((x for x in counts if 2 * x <= capacity), reverse=True)
    alone, beside = sum(counts[x] for x in large), 0
    room = 0  # left over beside the large pieces that leave room for the smallest one looked at
    at = 0
    for k in small:
        while at < len(large) and large[at] <= capacity - k:
            room += counts[large[at]] * (capacity - large[at])
            at += 1
        beside += k * counts[k]
        best = max(best, alone + max(0, -(-(beside - room) // capacity)))
    return max(best, alone)


def _repeat(left: dict[int, int], pattern: tuple[int, ...]) -> int:
    """How often a bin's pattern is there."""
    return min(left[x] // pattern.count(x) for x in set(pattern))


def _take(left: dict[int, int], pattern: tuple[int, ...], times: int) -> None:
    for x in pattern:
        left[x] -= times


def least_waste(counts: dict[int, int], capacity: int) -> Bins:
    """One bin after the other, completed with the least waste there is."""
    left, lengths, bins = dict(counts), sorted(counts), []
    while lengths:
        top = lengths[-1]
        left[top] -= 1
        filling = _completion(lengths, left, capacity - top)
        left[top] += 1
        pattern = (top, *filling)
        bins.append((_repeat(left, pattern), pattern))
        _take(left, pattern, bins[-1][0])
        for x in set(pattern):
            if not left[x]:
                lengths.pop(bisect_left(lengths, x))
    return bins


def first_fit(counts: dict[int, int], capacity: int) -> Bins:
    """First-fit decreasing, bin by bin: each takes the longest piece that fits, again and again."""
    left, lengths, bins = dict(counts), sorted(counts), []
    while lengths:
        space, pattern = capacity, ()
        for at in range(len(lengths) - 1, -1, -1):
            x = lengths[at]
            k = min(left[x], space // x)
            pattern += (x,) * k
            space -= k * x
        bins.append((_repeat(left, pattern), pattern))
        _take(left, pattern, bins[-1][0])
        lengths = [x for x in lengths if left[x]]
    return bins


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best-fit decreasing on groups of equal bins: every piece goes where the least space is left."""
    groups: list[tuple[int, int, tuple[int, ...]]] = []  # (space, times, pattern), ascending
    for x in sorted(counts, reverse=True):
        k = counts[x]
        while k:
            at = bisect_left(groups, (x,))
            space, times, pattern = groups.pop(at) if at < len(groups) else (capacity, k, ())
            each = space // x  # a bin that took one piece is the best for the next
            full = min(times, k // each)
            new = [(full, each)]
            k -= full * each
            if full < times and k:
                new.append((1, min(k, each)))
                k -= new[-1][1]
            untouched = times - sum(n for n, _ in new)
            for n, held in new:
                if n:
                    insort(groups, (space - held * x, n, pattern + (x,) * held))
            if untouched and pattern:
                insort(groups, (space, untouched, pattern))
    return [(times, pattern) for _, times, pattern in groups]


def _search(counts: dict[int, int], capacity: int, best: Bins, bound: int, nodes: int) -> Bins:
    """Branch and bound over the bins of the largest pieces; ``best`` is the incumbent."""
    left, total = dict(counts), sum(x * n for x, n in counts.items())
    goal = n_bins(best) - 1
    waste = used = 0
    path: Bins = []

    def choices() -> Iterator[tuple[int, tuple[int, ...]] | None]:
        lengths = sorted(x for x, n in left.items() if n)
        top = lengths[-1]
        left[top] -= 1
        spare = goal * capacity - total - waste
        fillings = _fillings(lengths, dict(left), capacity - top, spare)
        left[top] += 1
        for filling in fillings:
            if filling is None:
                yield None
                continue
            pattern = (top, *filling)
            times = _repeat(left, pattern)
            yield times, pattern
            if times > 1:
                yield 1, pattern

    stack = [choices()]
    open_bins: list[bool] = [False]  # whether the frame's last choice is in the path
    while stack:
        if open_bins[-1]:
            times, pattern = path.pop()
            _take(left, pattern, -times)
            waste -= times * (capacity - sum(pattern))
            used -= times
            open_bins[-1] = False
        choice = next(stack[-1], False)
        if choice is False:
            stack.pop()
            open_bins.pop()
            continue
        nodes -= 1
        if nodes < 0:
            break
        if choice is None:
            continue
        times, pattern = choice
        lost = times * (capacity - sum(pattern))
        if waste + lost > goal * capacity - total or used + times > goal:
            continue
        path.append(choice)
        open_bins[-1] = True
        _take(left, pattern, times)
        waste += lost
        used += times
        if not any(left.values()):
            best, goal = list(path), used - 1
            if used <= bound:
                break
            continue
        stack.append(choices())
        open_bins.append(False)
    return best


def _fillings(lengths: list[int], left: dict[int, int], room: int, spare: int) -> Iterator[tuple[int, ...] | None]:
    """Fillings of ``room`` that waste at most ``spare`` and that no other dominates, least waste first.

    A dominated one is None: with a longer piece in place of one, or one in
    place of two, it would be a filling that leaves the others more room.
    """
    fitting = [x for x in lengths[: bisect_right(lengths, room)] if left[x]]
    sums = _reachable(fitting, left, room)
    for total in range(room, max(-1, room - spare - 1), -1):
        if not sums[-1] >> total & 1:
            continue
        stack = [(len(fitting), total, ())]
        while stack:
            at, rest, filling = stack.pop()
            if not rest:
                yield None if _dominated(fitting, left, filling, room - total) else filling
                continue
            x = fitting[at - 1]
            for k in range(min(left[x], rest // x) + 1):
                if sums[at - 1] >> (rest - k * x) & 1:
                    stack.append((at - 1, rest - k * x, filling + (x,) * k))


def _dominated(fitting: list[int], left: dict[int, int], filling: tuple[int, ...], waste: int) -> bool:
    def free(least: int, most: int) -> bool:
        """Whether a piece of such a length is outside the filling."""
        span = fitting[bisect_left(fitting, least) : bisect_right(fitting, most)]
        return any(left[z] > filling.count(z) for z in span)

    if free(1, waste) or any(free(y + 1, y + waste) for y in set(filling)):
        return True
    pairs = {a + b for i, a in enumerate(filling) for b in filling[i + 1 :]}
    return any(free(both, both + waste) for both in pairs)


def _reachable(fitting: list[int], left: dict[int, int], room: int) -> list[int]:
    """Bits of the sums up to ``room`` that the first 0, 1, 2 ... lengths can reach."""
    full = (1 << (room + 1)) - 1
    sums = [1]
    for x in fitting:
        bits, n, k = sums[-1], min(left[x], room // x), 1
        while n > 0:
            bits |= bits << (min(k, n) * x) & full
            n, k = n - k, 2 * k
        sums.append(bits)
    return sums


def _completion(lengths: list[int], left: dict[int, int], room: int) -> tuple[int, ...]:
    """The filling of ``room`` with the least waste, the fewer and larger pieces on ties."""
    best: tuple[int, ...] = ()
    space = room
    for at in range(bisect_right(lengths, space) - 1, -1, -1):  # best fit, largest first
        x = lengths[at]
        k = min(left[x], space // x)
        best += (x,) * k
        space -= k * x
    if space == 0:
        return best
    fitting = lengths[: bisect_right(lengths, room)]
    sums = _reachable(fitting, left, room)
    filling: tuple[int, ...] = ()
    goal = sums[-1].bit_length() - 1
    for at in range(len(fitting) - 1, -1, -1):
        x = fitting[at]
        k = min(left[x], goal // x)
        while not sums[at] >> (goal - k * x) & 1:
            k -= 1
        filling += (x,) * k
        goal -= k * x
    return filling


def _slots(bins: list[tuple[int, tuple[int, ...]]], first: int) -> pd.DataFrame:
    """Runs of places: pieces of a length with ranks from ``rank`` on go to ``sequence`` on at ``offset``."""
    taken: dict[int, int] = {}
    rows = []
    sequence = first
    for times, pattern in bins:
        offset = 0
        for x in pattern:
            rows.append((x, taken.get(x, 0), times, sequence, offset))
            taken[x] = taken.get(x, 0) + times
            offset += x
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "times", "sequence", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` (any columns, ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Columns of those names are replaced. The pieces are written once in the
    shared folder; only the counts per length, at most ``capacity`` rows,
    reach the driver. No piece gives no sequence.
    """
    spark = pieces.sparkSession
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    salt_of, count_of, before_of, in_of, rank_of = free_names(pieces, "_salt", "_n", "_before", "_in", "_rank")
    written = shared(pieces.select(*own), "pieces")
    # Parts of a length hold about as many pieces however many there are.
    parts_of = max(PARTS, -(-written.count() // PIECES_PER_PART))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in own if c != "ids"]), F.lit(parts_of)).cast("int")
    written = written.withColumn(salt_of, salt)
    parts = shared(written.groupBy("length", salt_of).agg(F.count("*").alias(count_of)), "piece_counts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum(count_of).alias("n")).collect()}
    bins = complete_bins(counts, capacity, nodes)
    slots = {x: run.sort_values("rank") for x, run in _slots(bins, 0).groupby("length")}
    slots = {int(x): tuple(run[c].to_numpy(np.int64) for c in ("rank", "sequence", "offset")) for x, run in slots.items()}
    sent = spark.sparkContext.broadcast(slots)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            rank = batch[rank_of].to_numpy(np.int64)
            for x, rows in batch.groupby("length").indices.items():
                ranks, sequences, offsets = sent.value[int(x)]
                at = np.searchsorted(ranks, rank[rows], side="right") - 1
                sequence[rows] = sequences[at] + rank[rows] - ranks[at]
                offset[rows] = offsets[at]
            yield batch.drop(columns=[rank_of]).assign(sequence_id=sequence, offset=offset)

    before = F.coalesce(F.sum(count_of).over(Window.partitionBy("length").orderBy(salt_of).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = parts.select("length", salt_of, before.alias(before_of))
    order = [c for c in own if c not in ("length", "ids")] or ["length"]
    ranked = written.withColumn(in_of, F.row_number().over(Window.partitionBy("length", salt_of).orderBy(*order)) - 1)
    placed = ranked.join(firsts, ["length", salt_of]).select(*own, (F.col(before_of) + F.col(in_of)).alias(rank_of))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*own).schema)
    return placed.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, and the (doc_id, piece, offset, length) of its pieces."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return grouped.select(
        "sequence_id", ids.alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("pieces"),
    )

