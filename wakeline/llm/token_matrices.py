"""Packed token matrices: best-fit-decreasing with a segment tree over free capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.store import text
from wakeline.llm.tokens import WordTokenizer
from wakeline.llm.words import parts as slices

ROWS = ("sequence_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
        "doc_ids array<long>, doc_starts array<long>")
_FIELDS = pa.schema([("sequence_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int32()),
                     ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64()))])


class Capacities:
    """Bins by free capacity; the tree's nodes say how many bins lie below them."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: dict[int, list[int]] = {}

    def _change(self, free: int, by: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, free: int, bin_: int) -> None:
        self.bins.setdefault(free, []).append(bin_)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, bin) with the least capacity of at least ``need``."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._change(free, -1)
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Indexes of ``lengths`` (each at most ``size``) by bin; equal lengths keep their order."""
    bins: list[list[int]] = []
    free = Capacities(size)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room, at = free.take(lengths[i]) or (size, len(bins))
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
        if room > lengths[i]:
            free.put(room - lengths[i], at)
    return bins


def token_matrices(docs: DataFrame, tokenizer: str, width: int = 4096, buffer_tokens: int = 8_000_000,
                   end_id: int = 2, pad_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per packed sequence: ``ids`` is a matrix row of ``width`` little-endian unsigned
    32-bit ids, padded with ``pad_id``; ``cu_seqlens`` are the cumulative segment lengths from 0;
    ``position_resets`` the columns where position ids start again at 0 (each segment and the
    padding); ``doc_ids`` and ``doc_starts`` name each segment's document and its place there.

    Documents of more than ``width`` ids are split into segments and nothing is lost.  A task packs
    whenever it has gathered ``buffer_tokens`` ids, which bounds its memory and splits nothing.  Null
    and empty texts are ``end_id`` alone; null and repeated document ids are kept; other columns
    are ignored; an empty table gives no rows.
    """
    end = int(end_id).to_bytes(4, "little")
    pad = int(pad_id).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.load(tokenizer)
        next_id = TaskContext.get().partitionId() << 32
        parts: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal parts, next_id, held
            rows = []
            for bin_ in best_fit_decreasing([len(p[2]) // 4 for p in parts], width):
                ids = b"".join(parts[i][2] for i in bin_)
                ends = np.cumsum([0] + [len(parts[i][2]) // 4 for i in bin_]).tolist()
                rows.append((next_id, ids + pad * (width - ends[-1]), ends[-1], ends,
                             ends if ends[-1] < width else ends[:-1],
                             [parts[i][0] for i in bin_], [parts[i][1] for i in bin_]))
                next_id += 1
                if len(rows) == 500:
                    yield as_batch(rows)
                    rows = []
            if rows:
                yield as_batch(rows)
            parts, held = [], 0

        for batch in batches:
            for few in slices(batch):
                for key, body in zip(few.column(0).to_pylist(), words.batch(few.column(1))):
                    ids = body + end
                    for at in range(0, len(ids), 4 * width):
                        parts.append((key, at // 4, ids[at:at + 4 * width]))
                    held += len(ids) // 4
                    if held >= buffer_tokens:
                        yield from flush()
        yield from flush()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text(text_column).alias("text")) \
        .mapInArrow(pack, ROWS)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Write the sequences as Parquet with compressed binary rows."""
    matrices.write.option("compression", "zstd").parquet(path)


def arrays(rows: list, width: int = 4096) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For a loader: the id matrix, the matrix of position ids, and the cumulative lengths of some rows."""
    ids = np.frombuffer(b"".join(r["ids"] for r in rows), "<u4").reshape(-1, width)
    positions = np.empty(ids.shape, np.int32)
    for row, r in zip(positions, rows):
        starts = np.zeros(width, np.int32)
        starts[r["position_resets"]] = r["position_resets"]
        row[:] = np.arange(width) - np.maximum.accumulate(starts)
    return ids, positions, [np.array(r["cu_seqlens"], np.int32) for r in rows]
