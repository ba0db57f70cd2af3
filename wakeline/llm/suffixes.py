"""Exact removal of repeated strings by a sparse suffix array that is merge-sorted in a distributed way.

Every 200-byte string has one anchor, the 64-byte gram of least hash inside it, so equal strings have
equal anchors at equal places.  Neighbouring strings share their anchor; what they cover together is
the anchor's stretch.  Stretches whose anchor stands nowhere else hold no repeated string, and
stretches that are equal in all bytes hold repeated strings only; both are settled by counting hashes.

The others share an anchor and differ around it.  The suffixes that begin at their anchors are sorted
in runs by the tasks that read them, sent front-coded to the task of their first gram, and combined
by a loser tree that compares two suffixes only beyond the prefix they are known to share with the
last one put out.  The common prefixes of neighbours in the merged order, with the common bytes
before the anchors, tell which strings are equal.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import hashes
from wakeline.llm.store import keep, text

LENGTH, GRAM = 200, 64
WINDOW = LENGTH - GRAM + 1
#: Bytes of text worked on at a time; a longer text is read in parts that overlap.
PART = (1 << 20) - 4096


def anchors(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, stretch hash, first start, last start, anchor) of the stretches of one part's bytes."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 5
    total = hashes.sums(raw)
    at = np.arange(len(raw) - GRAM + 1)
    gram = hashes.span(total, at, at + GRAM)
    value = (gram >> np.uint64(20) << np.uint64(20)) | at.astype(np.uint64)
    pad = -len(value) % WINDOW
    blocks = np.concatenate([value, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[WINDOW - 1:WINDOW - 1 + n])
    place = (least & np.uint64(0xFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:] - 1, n - 1]
    place = place[first]
    whole = hashes.mixed(hashes.span(total, first, last + LENGTH) + (place - first).astype(np.uint64))
    return gram[place].astype(np.int64), whole.astype(np.int64), first, last, place


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (id, h, key, whole, place); ``place`` packs first start, length of the stretch of starts, anchor."""
    for batch in batches:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            where = columns[0]
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where)), batch.column(1).take(pa.array(where)),
                                               *[pa.array(c) for c in columns[1:]]], names=["id", "h", "key", "whole", "place"])

        for i, t in enumerate(batch.column(2).to_pylist()):
            raw = np.frombuffer(t.encode(), np.uint8)
            for base in range(0, max(1, len(raw) - LENGTH + 1), PART):
                key, whole, first, last, at = anchors(raw[base:base + PART + LENGTH - 1])
                held.append((np.full(len(key), i), key, whole, pack(first + base, last - first, at - first)))
                size += len(key)
            if size > 100_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()


def pack(first, extent, lead):
    return (first << 16) | (extent << 8) | lead


def unpack(place):
    """(first start, last start, anchor)"""
    first = place >> 16
    return first, first + ((place >> 8) & 255), first + (place & 255)


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n  # equal up to low; not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def encode_run(suffixes: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run of (suffix, payload), front-coded: length shared with the one before, then the rest."""
    out, before = [], b""
    for suffix, payload in suffixes:
        n = common(before, suffix)
        out += [struct.pack("<HHH", n, len(suffix) - n, len(payload)), suffix[n:], payload]
        before = suffix
    return b"".join(out)


def decode_run(run: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(length shared with the one before, suffix, payload)"""
    at, before = 0, b""
    while at < len(run):
        n, rest, more = struct.unpack_from("<HHH", run, at)
        at += 6
        before = before[:n] + run[at:at + rest]
        yield n, before, run[at + rest:at + rest + more]
        at += rest + more


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted (length shared with the one before, suffix, payload) of all runs, by a loser tree.

    Every player knows what it shares with the last suffix put out.  Of two players, the one that
    shares more comes first; if both share as much, the bytes beyond decide, and the loser then
    knows what it shares with the winner.
    """
    feeds = [decode_run(r) for r in runs if r]
    n = len(feeds)
    if not n:
        return
    heads: list = [next(f, None) for f in feeds]
    shared = [0] * n

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        k = common(x, y, shared[a])
        if x[k:k + 1] <= y[k:k + 1]:
            shared[b] = k
            return a, b
        shared[a] = k
        return b, a

    losers = [-1] * n
    winners = [-1] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if n > 1 else 0
    while heads[best] is not None:
        yield shared[best], heads[best][1], heads[best][2]
        heads[best] = next(feeds[best], None)
        shared[best] = heads[best][0] if heads[best] else 0
        node = (best + n) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def repeated_starts(group: list[tuple], prefixes: list[int]) -> list[list[tuple[int, int]]]:
    """For each member (least lead, greatest lead, bytes before the anchor, nearest first) of one anchor
    in suffix order: ranges of leads whose string another member has too.  ``prefixes[i]`` is what
    suffix i shares with the one before.  A lead is the distance from the string's start to the anchor."""
    m = len(group)
    found: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if m <= 48:
        for i in range(m):
            shared = LENGTH
            for j in range(i + 1, m):
                shared = min(shared, prefixes[j])
                (low1, high1, left1), (low2, high2, left2) = group[i], group[j]
                low, high = max(low1, low2, LENGTH - shared), min(high1, high2)
                if low <= high and (high := min(high, common(left1, left2))) >= low:
                    found[i].append((low, high))
                    found[j].append((low, high))
        return found
    for lead in range(WINDOW):
        stretch, seen = 0, {}
        for i, (low, high, left) in enumerate(group):
            if prefixes[i] < LENGTH - lead:
                stretch += 1
            if low <= lead <= high:
                seen.setdefault((stretch, left[:lead]), []).append(i)
        for members in seen.values():
            if len(members) > 1:
                for i in members:
                    if found[i] and found[i][-1][1] == lead - 1:
                        found[i][-1] = (found[i][-1][0], lead)
                    else:
                        found[i].append((lead, lead))
    return found


_PAYLOAD = struct.Struct("<?q16sqBB")  # id is null, id, h, anchor, least and greatest lead; then the bytes before


def _runs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs, one per bucket of first grams and batch of stretches."""
    for batch in batches:
        by: dict[int, list] = {}
        for r in batch.to_pylist():
            first, last, at = unpack(r["place"])
            body, lead = r["body"], at - first
            payload = _PAYLOAD.pack(r["id"] is None, r["id"] or 0, r["h"], at, at - last, lead) + body[:lead][::-1]
            by.setdefault(r["key"] % buckets, []).append((body[lead:], payload))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(by), pa.int64()), pa.array([encode_run(sorted(s)) for s in by.values()], pa.binary())],
            names=["bucket", "run"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def settle(rows: list, group: list, prefixes: list) -> None:
        if len(group) < 2:
            return
        heads = [_PAYLOAD.unpack_from(p) for p in group]
        leads = [(h[4], h[5], p[_PAYLOAD.size:]) for h, p in zip(heads, group)]
        for (none, id_, h, at, _, _), ranges in zip(heads, repeated_starts(leads, prefixes)):
            rows += [(None if none else id_, h, at - high, at - low) for low, high in ranges]

    def solve(runs: list[bytes]) -> pa.RecordBatch:
        rows, group, prefixes = [], [], []
        for shared, _, payload in merge_runs(runs):
            if shared < GRAM:
                settle(rows, group, prefixes)
                group, prefixes = [], []
            group.append(payload)
            prefixes.append(shared)
        settle(rows, group, prefixes)
        columns = list(zip(*set(rows))) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["id", "h", "first", "last"])

    bucket, held = None, []
    for batch in batches:
        for b, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if b != bucket and held:
                yield solve(held)
                held = []
            bucket = b
            held.append(run)
    if held:
        yield solve(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, h, text, [(key, place)]): the bytes of each stretch."""
    for batch in batches:
        rows = []
        for id_, h, t, items in zip(*[c.to_pylist() for c in batch.columns]):
            raw = t.encode()
            for item in items:
                first, last, _ = unpack(item["place"])
                rows.append((id_, h, item["key"], item["place"], raw[first:last + LENGTH]))
            if len(rows) > 20_000:
                yield _stretches(rows)
                rows = []
        yield _stretches(rows)


def _stretches(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)],
                                      names=["id", "h", "key", "place", "body"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a stretch by itself: (id, h, start, digest)."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            first, last, _ = unpack(r["place"])
            rows += [(r["id"], r["h"], s, hashlib.blake2b(r["body"][s - first:s - first + LENGTH], digest_size=16).digest())
                     for s in range(first, last + 1)]
            if len(rows) > 50_000:
                yield _string_batch(rows)
                rows = []
        yield _string_batch(rows)


def _string_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, types)],
                                      names=["id", "h", "first", "digest"])


def spans_of(starts: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings that begin in the ranges of ``starts``."""
    out: list[list[int]] = []
    for first, end in sorted((s["first"], s["last"] + LENGTH) for s in starts):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = t.encode()
            spans = spans_of(starts or [], len(raw))
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            rows.append((len(raw), len(raw) - len(kept), kept, [{"start": a, "end": b} for a, b in spans]))
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(
            list(zip(*rows)) or [()] * 4, (pa.int64(), pa.int64(), pa.binary(), pair))]],
            names=["doc_id", "n_bytes", "n_removed", "kept", "spans"])


def remove_repeats(docs: DataFrame, group_limit: int = 2000, bucket_bytes: int = 8 << 20, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, kept (the remaining bytes, which may
    cut a character) and spans (start, end of the maximal removed runs of bytes).

    A byte goes if a 200-byte string over it starts anywhere else too, in any document or the same;
    strings are judged on the input.  Null texts are empty; null and repeated ids are kept, and two equal
    rows repeat each other; other columns are ignored; an empty table gives no rows.  An anchor with more
    than ``group_limit`` different stretches is settled string by string instead of in one task.
    """
    # a row is named by its id and 128 bits of its text; rows equal in both are one for all that follows
    rows = docs.select(F.col(id_column).cast("long").alias("id"), digest(text(text_column)).alias("h"), text(text_column).alias("text"))
    found = rows.filter(F.octet_length("text") >= LENGTH).mapInArrow(
        _find, "id long, h binary, key long, whole long, place long")
    again = keep(found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "repeated-anchors")
    some = keep(found.join(again, "key"), "shared-stretches")
    kinds = keep(some.groupBy("key", "whole").agg(F.count("*").alias("n"), F.min(F.struct("id", "h", "place")).alias("one")), "stretch-kinds")
    equal = some.join(kinds.filter("n > 1").select("key", "whole"), ["key", "whole"]).select("id", "h", "place")
    first, last, _ = unpack_columns()
    starts = [equal.select("id", "h", first.alias("first"), last.alias("last"))]

    groups = keep(kinds.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "open-anchors")
    items = kinds.join(groups, "key").select("key", "members", "one.*")
    by_doc = items.groupBy("id", "h").agg(F.collect_list(F.struct("key", "place")).alias("items"))
    by_doc = keep(by_doc, "open-stretches").select(F.col("id").alias("i_id"), F.col("h").alias("i_h"), "items")
    same = F.col("id").eqNullSafe(F.col("i_id")) & (F.col("h") == F.col("i_h"))
    # equal rows would give their stretches twice, which changes nothing that is not settled already
    bodies = keep(rows.join(by_doc, same).select("id", "h", "text", "items").mapInArrow(
        _cut, "id long, h binary, key long, place long, body binary"), "stretch-bytes")
    sized = bodies.join(groups, "key")
    small = sized.filter(F.col("members") <= group_limit).drop("members")
    total = bodies.agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes * 4
    runs = small.mapInArrow(lambda b: _runs(b, buckets), "bucket long, run binary")
    starts.append(runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge, "id long, h binary, first long, last long"))
    strings = sized.filter(F.col("members") > group_limit).drop("members").mapInArrow(
        _strings, "id long, h binary, first long, digest binary")
    twice = keep(strings.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "repeated-strings")
    starts.append(strings.join(twice, "digest").select("id", "h", "first", F.col("first").alias("last")))

    ranges = keep(starts[0].unionByName(starts[1]).unionByName(starts[2]).groupBy("id", "h").agg(
        F.collect_set(F.struct("first", "last")).alias("starts")), "repeated-starts")
    ranges = ranges.select(F.col("id").alias("i_id"), F.col("h").alias("i_h"), "starts")
    return rows.join(ranges, same, "left").select("id", "text", "starts").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:long,end:long>>")


def digest(column):
    """16 bytes that tell texts apart."""
    return F.unhex(F.md5(F.encode(column, "UTF-8")))


def unpack_columns():
    first = F.shiftright("place", 16)
    return first, first + F.shiftright("place", 8).bitwiseAND(255), first + F.col("place").bitwiseAND(255)
