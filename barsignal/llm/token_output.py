"""Token ids as Arrow files of equal-length sequences, read back in place.

Documents are ordered by doc_id over the tasks; each task writes one Arrow IPC
file whose record batches hold fixed-size lists: ids and a mask of the
positions that carry a token. All batches of a file but the last have the same
number of sequences, so token t of a file lies in sequence t // L of batch
(t // L) // B at a computed place: a memory-mapped read copies nothing.
The index, a Parquet table, names the file, place and length of every document
and commits the files: what a lost task wrote is never named.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import shared
from barsignal.llm.packing import crc_of_ids
from barsignal.llm.tokens import encoder
from barsignal.session import work_dir
from barsignal.sources.paths import arrow_path

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 64

INDEX = "doc_id long, part int, path string, place long, n_tokens long"


class SequenceWriter:
    """Appends ids to one Arrow file of fixed-size lists."""

    def __init__(self, path: str, dtype: np.dtype, sequence: int = SEQUENCE, per_batch: int = SEQUENCES_PER_BATCH) -> None:
        self.fs, name = arrow_path(path)
        self.fs.create_dir(name.rpartition("/")[0], recursive=True)
        self.dtype, self.sequence, self.size = dtype, sequence, sequence * per_batch * dtype.itemsize
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema(
            [pa.field("ids", pa.list_(kind, sequence)), pa.field("mask", pa.list_(pa.bool_(), sequence))],
            {"sequence": str(sequence), "per_batch": str(per_batch)},
        )
        self.sink = self.fs.open_output_stream(name)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.pending, self.tokens = bytearray(), 0

    def append(self, ids: bytes) -> int:
        """Adds the ids and returns the place of the first one."""
        place = self.tokens
        self.pending += ids
        self.tokens += len(ids) // self.dtype.itemsize
        if len(self.pending) >= self.size:
            whole = len(self.pending) // self.size * self.size
            for k in range(0, whole, self.size):
                self._write(bytes(self.pending[k : k + self.size]))
            del self.pending[:whole]
        return place

    def _write(self, ids: bytes) -> None:
        values = np.frombuffer(ids, self.dtype)
        n = -(-len(values) // self.sequence) * self.sequence
        padded = np.zeros(n, self.dtype)
        padded[: len(values)] = values
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(x, f.type.value_type), self.sequence)
            for x, f in zip((padded, np.arange(n) < len(values)), self.schema, strict=True)
        ]
        self.out.write_batch(pa.record_batch(arrays, schema=self.schema))

    def close(self) -> None:
        if self.pending:
            self._write(bytes(self.pending))
        self.out.close()
        self.sink.close()


class SequenceReader:
    """Slices of one Arrow file by token place, over mapped memory where it is local."""

    def __init__(self, path: str) -> None:
        fs, name = arrow_path(path)
        local = fs.type_name == "local"
        self.file = pa.ipc.open_file(pa.memory_map(name) if local else fs.open_input_file(name))
        meta = self.file.schema.metadata
        self.sequence, self.per_batch = int(meta[b"sequence"]), int(meta[b"per_batch"])
        self.held: tuple[int, np.ndarray, np.ndarray, int] | None = None

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (sequences x length, no copy) and mask of a batch."""
        b = self.file.get_batch(k)
        ids = b.column("ids").values.to_numpy(zero_copy_only=True).reshape(-1, self.sequence)
        return ids, b.column("mask").values.to_numpy(zero_copy_only=False).reshape(-1, self.sequence)

    def _held(self, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and mask of a batch, one after another, and how many lead with a token; the last batch is kept."""
        if self.held is None or self.held[0] != k:
            ids, mask = (x.reshape(-1) for x in self.batch(k))
            gaps = np.flatnonzero(~mask)
            self.held = k, ids, mask, int(gaps[0]) if len(gaps) else len(mask)
        return self.held[1:]

    def tokens(self, place: int, n: int) -> np.ndarray:
        """``n`` ids from ``place`` on; raises where the mask says there are none."""
        size = self.sequence * self.per_batch
        parts = []
        while n > 0:
            ids, mask, led = self._held(place // size)
            at = place % size
            take = min(n, size - at)
            if at + take > led and (at + take > len(ids) or not mask[at : at + take].all()):
                raise ValueError("no token there")
            parts.append(ids[at : at + take])
            place, n = place + take, n - take
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, sequence: int = SEQUENCE,
    per_batch: int = SEQUENCES_PER_BATCH, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Writes every whole text's ids below ``folder`` and returns the index.

    Documents are in ascending order of the key (null first, then text for
    repeated keys); a null or empty text is the end id alone. Index: doc_id,
    part, path, place, n_tokens, start (ids of all documents before).
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(tokenizer)
        end = np.array([end_id], coder.dtype).tobytes()
        path = f"{folder}/{uuid.uuid4().hex}.arrow"
        out = None
        for batch in batches:
            out = out or SequenceWriter(path, coder.dtype, sequence, per_batch)
            places, sizes = [], []
            for ids in coder.batch(batch["_text"].tolist()):
                places.append(out.append(ids + end))
                sizes.append(out.tokens - places[-1])
            yield pd.DataFrame({
                "doc_id": batch["_key"].astype("Int64"), "part": batch["_part"], "path": path, "place": places, "n_tokens": sizes,
            })
        if out:
            out.close()

    ordered = (
        docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
        .repartitionByRange("_key").sortWithinPartitions("_key", "_text")
        .withColumn("_part", F.spark_partition_id())
    )
    index = shared(ordered.mapInPandas(write, INDEX), "token_index")
    # One row per file: the parts' order is the order of the keys.
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = parts.select("part", before.alias("_before"))
    return index.join(F.broadcast(firsts), "part").select(
        "doc_id", "part", "path", "place", "n_tokens", (F.col("_before") + F.col("place")).alias("start")
    )


def read_tokens(index: DataFrame, with_ids: bool = True) -> DataFrame:
    """The index with ids_crc32 and, if asked for, ids as read from the files.

    A file's documents are read in blocks of batches, so one large file is
    read by many tasks.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, reader = None, None
        for batch in batches:
            crc, arrays = [], []
            for row in batch.itertuples(index=False):
                if row.path != path:
                    path, reader = row.path, SequenceReader(row.path)
                ids = reader.tokens(row.place, row.n_tokens)
                crc.append(crc_of_ids(ids.tobytes(), ids.dtype))
                arrays.append(ids.astype(np.int32) if with_ids else None)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "start": batch["start"], "n_tokens": batch["n_tokens"],
                "ids_crc32": crc, "ids": pd.Series(arrays, dtype=object),
            })

    block = F.floor(F.col("place") / F.lit(SEQUENCE * SEQUENCES_PER_BATCH * 8))
    dealt = index.select("doc_id", "path", "place", "start", "n_tokens").repartition("path", block).sortWithinPartitions("path", "place")
    return dealt.mapInPandas(read, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Index of files written in a fresh shared folder."""
    return write_tokens(docs, work_dir(docs.sparkSession, "tokens"), tokenizer, end_id)
