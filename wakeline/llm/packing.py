"""Packing token sequences: bounded-space online best fit with a final merge of the leftovers.

Each task keeps a fixed number of open windows.  A document's rest goes to the window it fills best;
if none has room, the fullest is topped up with the head of the rest and emitted full.  What is open
at the end of a task is merged within the task, then over groups of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.store import keep, text
from wakeline.llm.tokens import WordTokenizer
from wakeline.llm.words import parts

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_FIELDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Sequence ids: number of the task (or, from here on, of the merging group) in the upper half.
MERGED = 1 << 30


class Windows:
    """Open windows of one task.  A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, size: int, limit: int, first_id: int):
        self.size, self.limit, self.next_id = size, limit, first_id
        self.open: list[list] = []  # [free ids, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, ids, total, self.next_id, at))
            at += n
        self.next_id += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        size, windows = self.size, self.open
        at, end = 0, len(ids) // 4
        while end - at >= size:
            self.emit([(doc, start + at, ids[4 * at:4 * (at + size)], total)])
            at += size
        while at < end:
            n, best = end - at, None
            for w in windows:
                if n <= w[0] and (best is None or w[0] < best[0]):
                    best = w
            if best is None and len(windows) < self.limit:
                windows.append(best := [size, []])
            cut = n
            if best is None:
                best = min(windows, key=lambda w: w[0])
                cut = best[0]
            best[1].append((doc, start + at, ids[4 * at:4 * (at + cut)], total))
            best[0] -= cut
            if not best[0]:
                self.emit(best[1])
                windows.remove(best)
            at += cut

    def merge(self) -> list[tuple]:
        """Fill windows from what is open, fullest first; the pieces that fill no window remain."""
        left, self.open = sorted(self.open, key=lambda w: w[0]), []
        self.limit = 1
        for _, pieces in left:
            for piece in pieces:
                self.add(*piece)
        return self.open[0][1] if self.open else []

    def finish(self) -> None:
        """Emit the last rest as sequences of powers of two, which need no padding."""
        for doc, start, ids, total in (rest := self.merge()):
            assert len(ids) // 4 < self.size
        n = sum(len(p[2]) // 4 for p in rest)
        while n:
            part, room, later = [], 1 << (n.bit_length() - 1), []
            n -= room
            for doc, start, ids, total in rest:
                cut = min(room, len(ids) // 4)
                if cut:
                    part.append((doc, start, ids[:4 * cut], total))
                if 4 * cut < len(ids):
                    later.append((doc, start + cut, ids[4 * cut:], total))
                room -= cut
            self.emit(part)
            rest = later
        self.open = []

    def batch(self, **more) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * len(_FIELDS)
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)
        for name, value in more.items():
            out = out.append_column(name, pa.array([value] * len(rows), pa.int64()))
        return out


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, open_windows: int = 32, end_id: int = 2,
                   id_column: str = "doc_id", text_column: str = "text", fan_in: int = 32) -> DataFrame:
    """Pieces of all documents, each id in exactly one: doc_id, start (ids of its document before
    it), length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset there.

    A document's ids are its text's, then ``end_id``; null and empty texts are that id alone.
    Sequences hold ``window`` ids, but for the last few of each ``fan_in`` tasks, which are powers of
    two.  Null and repeated document ids are kept, each row being a document of its own; other columns
    are ignored; an empty table gives no rows.  Memory per task: the open windows and one batch.
    """
    end = int(end_id).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.load(tokenizer)
        task = TaskContext.get().partitionId()
        windows = Windows(window, open_windows, task << 32)
        for batch in batches:
            for rows in parts(batch):
                for doc, body in zip(rows.column(0).to_pylist(), words.batch(rows.column(1))):
                    ids = body + end
                    windows.add(doc, 0, ids, len(ids) // 4)
                    if len(windows.rows) >= 2000:
                        yield windows.batch(group=-1)
        rest = windows.merge()
        yield windows.batch(group=-1)
        windows.emit(rest)
        yield windows.batch(group=task // fan_in)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                groups.setdefault(row["group"], []).append(row)
        for group, rows in sorted(groups.items()):
            windows = Windows(window, 1, (MERGED + group) << 32)
            for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
                windows.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
            windows.finish()
            yield windows.batch()

    first = keep(docs.select(F.col(id_column).cast("long").alias("doc_id"), text(text_column).alias("text"))
                 .mapInArrow(pack, PIECES + ", group long"), "pieces")
    # the rest of a task is less than one window; a group of tasks makes one small partition
    rest = first.filter("group >= 0").repartition("group").mapInArrow(merge, PIECES)
    return first.filter("group < 0").drop("group").unionByName(rest)
