"""Runs of repeated word sequences, found by block convolution.

At each scale B = 1, 2, 4, ... the words are cut into blocks of B.  A block that lies in a run of
period B <= d < 2 B stands again d words later, so it is compared with the window of 2 B words behind
it: the squared differences of word numbers at all B distances come out of one number-theoretic transform,
and a sum of zero is an occurrence.  Blocks that hold a word which does not stand again at such a
distance are left out beforehand.  Neighbouring blocks that recur at one distance form a chain,
which is compared word by word and extended to the full run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.words import joined, parts, split

#: The field of the transform, 15 * 2 ** 27 + 1, and a generator of its units.
P = 2013265921
_P = np.uint64(P)
#: Elements of one transform of many blocks.
ROOM = 1 << 19


@lru_cache(maxsize=64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    w = pow(31, (P - 1) // (2 * half), P)
    if inverse:
        w = pow(w, P - 2, P)
    out = np.ones(half, np.uint64)
    n = 1
    while n < half:
        out[n:2 * n] = _mod(out[:n] * np.uint64(pow(w, n, P)))
        n *= 2
    return out


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // _P * _P


def _less(x: np.ndarray) -> np.ndarray:
    """x modulo P for x < 2 P: the difference wraps to a huge number where x is below P."""
    return np.minimum(x, x - _P)


def transform(a: np.ndarray) -> np.ndarray:
    """Forward transform of each row, in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1]
        a = np.stack((_less(u + v), _mod((u + _P - v) * _roots(half, False))), axis=2)
        half //= 2
    return a.reshape(rows, n)


def transform_back(a: np.ndarray) -> np.ndarray:
    """Inverse of ``transform``."""
    rows, n = a.shape
    half = 1
    while half < n:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], _mod(a[:, :, 1] * _roots(half, True))
        a = np.stack((_less(u + v), _less(u + _P - v)), axis=2)
        half *= 2
    return _mod(a.reshape(rows, n) * np.uint64(pow(n, P - 2, P)))


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(rows, B) whether row r of ``blocks`` (B wide) stands in row r of ``windows`` (2 B wide) at each of
    the first B places, by squared differences modulo P: never false for an occurrence; true for something
    else only where the sum is a multiple of P, which the caller tells apart."""
    b = blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, :b] = blocks[:, ::-1]
    product = transform_back(_mod(transform(turned) * transform(windows)))[:, b - 1:2 * b - 1]
    own = _mod(_mod(blocks * blocks).sum(axis=1, dtype=np.uint64))
    below = np.zeros((len(windows), 2 * b + 1), np.uint64)
    np.cumsum(_mod(windows * windows), axis=1, out=below[:, 1:])
    behind = below[:, b:2 * b] - below[:, :b]
    return _mod(own[:, None] + behind) == _less(product + product)


def _chains(ids: np.ndarray, b: int, alive: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, first block, blocks) of the longest chains of neighbouring blocks that recur at a distance."""
    found = []
    step = max(1, ROOM // (2 * b))
    for k in range(0, len(alive), step):
        at = alive[k:k + step, None] * b
        hits = occurrences(ids[at + np.arange(b)], ids[at + b + np.arange(2 * b)])
        row, d = np.nonzero(hits)
        found.append((d + b) * (n_blocks + 1) + alive[k + row])
    keys = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    heads = np.flatnonzero(np.diff(keys, prepend=-2) != 1)
    counts = np.diff(np.append(heads, len(keys)))
    return keys[heads] // (n_blocks + 1), keys[heads] % (n_blocks + 1), counts


def _grown(ids: np.ndarray, total: int, left: int, right: int, d: int, step: int) -> tuple[int, int]:
    """The longest stretch around left..right whose words equal those d places on."""
    while left > 0:
        a = max(0, left - step)
        off = np.flatnonzero(ids[a:left] != ids[a + d:left + d])
        if len(off):
            left = a + int(off[-1]) + 1
            break
        left = a
    while right + d < total:
        z = min(right + step, total - d)
        off = np.flatnonzero(ids[right:z] != ids[right + d:z + d])
        if len(off):
            right += int(off[0])
            break
        right = z
    return left, right


def _stretches(ids: np.ndarray, total: int, left: int, right: int, d: int, b: int) -> Iterator[tuple[int, int]]:
    """The stretches of a chain; one, unless a block of it was no occurrence."""
    if np.array_equal(ids[left:right], ids[left + d:right + d]):
        yield _grown(ids, total, left, right, d, b)
        return
    for a in range(left, right, b):
        if np.array_equal(ids[a:a + b], ids[a + d:a + b + d]):
            yield _grown(ids, total, a, a + b, d, b)


def find(numbers: np.ndarray, first: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (text, start, length, period) of the runs of texts given as word numbers, ``first`` as in
    ``words.Words``; by text, start and period.  ``times`` is 3 or more."""
    if times < 3:
        raise ValueError("a run has its period at least three times")
    sizes = np.diff(first)
    # longest text first, each with a number of its own behind it, which no run can hold
    ranked = np.argsort(-sizes, kind="stable")
    begins = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes[ranked] + 1, out=begins[1:])
    total = int(begins[-1])
    top = int(numbers.max(initial=-1)) + 1
    widest = 1
    while len(sizes) and widest * 2 * times <= int(sizes[ranked[0]]):
        widest *= 2
    ids = np.full(total + 3 * widest, top + len(sizes), np.uint64)
    place = np.repeat(begins[:-1] - first[ranked], sizes[ranked]) + _spread(first[ranked], sizes[ranked])
    ids[place] = numbers[_spread(first[ranked], sizes[ranked])]
    ids[begins[1:] - 1] = top + np.arange(len(sizes))
    ids = ids % _P  # only texts of over two billion different words would meet; chains are compared
    far = total + 3 * widest
    order = np.argsort(ids[:total], kind="stable")
    known: dict[tuple[int, int], int] = {}
    b = 1
    while len(sizes) and times * b <= int(sizes[ranked[0]]):
        limit = int(begins[np.searchsorted(-sizes[ranked], -times * b, side="right")])
        order = order[order < limit]
        keys = ids[order].astype(np.int64) * far + order
        after = np.searchsorted(keys, keys + b)
        again = np.zeros(limit, bool)
        near = after < len(keys)
        again[order[near]] = keys[after[near]] < keys[near] + 2 * b
        n_blocks = limit // b
        alive = again[:n_blocks * b].reshape(n_blocks, b).all(axis=1)
        if (times - 3) * b + 2 > b:  # a run holds two neighbouring blocks at least
            beside = np.zeros(n_blocks, bool)
            beside[1:] |= alive[:-1]
            beside[:-1] |= alive[1:]
            alive &= beside
        d, block, count = _chains(ids, b, np.flatnonzero(alive), n_blocks)
        long = count * b + 2 * b - 2 >= (times - 1) * d
        d, left, right = d[long], block[long] * b, (block + count)[long] * b
        by = np.argsort(left, kind="stable")
        d, left, right = d[by], left[by], right[by]
        inner = np.zeros(len(d), bool)  # in a run whose period divides the distance
        for (start, length), period in known.items():
            if length > 2 * b and len(d):
                k = slice(*np.searchsorted(left, [start, start + length]))
                inner[k] |= (right[k] + d[k] <= start + length) & (d[k] % period == 0)
        for dist, a, z in zip(d[~inner].tolist(), left[~inner].tolist(), right[~inner].tolist()):
            for a, z in _stretches(ids, total, a, z, dist, b):
                if z - a + dist >= max(least, times * dist):
                    known.setdefault((a, z - a + dist), dist)
        b *= 2
    rows = np.array([(s, n, q) for (s, n), q in known.items()], np.int64).reshape(-1, 3)
    nth = np.searchsorted(begins, rows[:, 0], side="right") - 1
    out = np.column_stack((ranked[nth], rows[:, 0] - begins[nth], rows[:, 1], rows[:, 2]))
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each stretch, one behind the other."""
    heads = np.cumsum(sizes) - sizes
    return np.repeat(starts - heads, sizes) + np.arange(int(sizes.sum()))


def _work(rows: pa.RecordBatch, prepare, least: int, times: int, schema: pa.Schema) -> pa.RecordBatch:
    texts = rows.column("text")
    found = split(prepare(rows) if prepare else texts)
    coded = found.words.dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    runs = find(numbers, found.first, least, times)
    # all but the first period of a run goes
    edge = np.zeros(len(numbers) + 1, np.int64)
    base = found.first[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, base + runs[:, 3], 1)
    np.add.at(edge, base + runs[:, 2], -1)
    keep = np.cumsum(edge[:-1]) == 0
    kept_first = np.concatenate(([0], np.cumsum(keep)))[found.first]
    text = joined(coded.dictionary.take(pa.array(numbers[keep])), kept_first)
    item = schema.field("runs").type.value_type
    cells = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(item))
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(rows.num_rows + 1)), pa.int32()), cells)
    return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(found.first)), lists, text.cast(pa.string())], schema=schema)


def word_runs(docs: DataFrame, least: int = 6, times: int = 4,
              prepare: Callable[[pa.RecordBatch], pa.Array] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of documents (doc_id, text).

    A run is a stretch of words of smallest period q, at least ``times`` * q and ``least`` words long,
    that neither neighbour continues; ``runs`` has start, length and period by start and period.
    ``collapsed`` has the words that no run holds after its first q, joined by one space.  Words are
    what stands between the six ASCII white-space characters.  ``prepare`` may give other texts for
    a batch of rows.

    Null and empty texts have no words and an empty ``collapsed``.  Rows are worked one by one: equal
    rows, null or repeated ids all stay, an empty table gives no rows, and further columns are left out
    whatever their names.  A task holds about 4 MB of texts, or one longer text, at a time.
    """
    doc_type = docs.schema["doc_id"].dataType
    out = f"doc_id {doc_type.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in parts(batch):
                cell = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
                schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n_words", pa.int64()),
                                    ("runs", pa.list_(cell)), ("collapsed", pa.string())])
                yield _work(rows, prepare, least, times, schema)

    return docs.select("doc_id", "text").mapInArrow(work, out)
