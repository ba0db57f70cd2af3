"""Text quality by a convolutional network over bytes, in numpy.

A text is read in blocks of 4 bytes.  The input of a block is the learned code of each of its bytes and,
for each lag of 2 to 24 bytes, how many of its bytes equal the byte that far back.  Filters span 4 blocks;
their largest values are pooled over chunks of 128 windows, which overlap by what a filter spans and cover the
whole text.  The largest and the mean pooled value over all chunks go into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.words import parts

BLOCK, SPAN, CHUNK = 4, 4, 128
LAGS = range(2, 25)
#: Bytes read before and behind a stretch, and the longest stretch read at once.
BEFORE, BEHIND, STRETCH = 24, BLOCK * (SPAN - 1), BLOCK * CHUNK * 512


@dataclass
class Net:
    code: np.ndarray  #: (256, E) codes of bytes
    filters: np.ndarray  #: (SPAN, BLOCK * E + lags, F)
    bias: np.ndarray  #: (F,)
    out: np.ndarray  #: (2 F + 1,) weights of the largest and the mean pooled values, and a constant

    def arrays(self) -> list[np.ndarray]:
        return [self.code, self.filters, self.bias, self.out]


def fresh(seed: int = 7, width: int = 6, n_filters: int = 16) -> Net:
    rng = np.random.default_rng(seed)
    n = BLOCK * width + len(LAGS)
    draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    return Net(draw(0.5, 256, width), draw(0.15, SPAN, n, n_filters), draw(0.01, n_filters), draw(0.2, 2 * n_filters + 1))


# --- texts to blocks ------------------------------------------------------------------------------

def stretches(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(text, bytes) with context around and filled up to whole blocks; a long text gives several,
    cut between chunks.  An empty text is one block of zeros."""
    for k, t in enumerate(texts):
        for a in range(0, max(len(t), 1), STRETCH):
            z = min(a + STRETCH, max(len(t), 1))
            n = -(-(z - a) // BLOCK) * BLOCK
            head = t[max(0, a - BEFORE):a]
            yield k, (b"\0" * (BEFORE - len(head)) + head + t[a:a + n + BEHIND]).ljust(BEFORE + n + BEHIND, b"\0")


def read_blocks(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (blocks, 4), equal bytes per lag (blocks, lags), the first window of each chunk (ends with the
    number of windows) and the text of each chunk.  Windows are numbered by their first block; those that begin
    in context belong to no text."""
    raw = np.frombuffer(b"".join(b for _, b in held), np.uint8)
    blocks = raw.reshape(-1, BLOCK)
    equal = np.empty((len(blocks), len(LAGS)), np.float32)
    for j, lag in enumerate(LAGS):
        same = np.zeros(len(raw), np.uint8)
        np.equal(raw[lag:], raw[:-lag], out=same[lag:].view(bool))
        same[raw == 0] = 0
        equal[:, j] = same.reshape(-1, BLOCK).sum(axis=1, dtype=np.uint8)
    starts, owner, at = [], [], 0
    for k, b in held:
        n = (len(b) - BEFORE - BEHIND) // BLOCK
        for c in range(0, n, CHUNK):
            starts.append((at + c + BEFORE // BLOCK, at + min(c + CHUNK, n) + BEFORE // BLOCK))
            owner.append(k)
        at += len(b) // BLOCK
    return blocks, equal, np.array(starts, np.int64), np.array(owner, np.int64)


def _inputs(net: Net, blocks: np.ndarray, equal: np.ndarray) -> np.ndarray:
    return np.concatenate((net.code[blocks].reshape(len(blocks), -1), equal), axis=1)


def _responses(net: Net, x: np.ndarray) -> np.ndarray:
    """(windows, F): each filter at each window, as the sum of its parts on the blocks of the window."""
    span, n, f = net.filters.shape
    whole = x @ net.filters.transpose(1, 0, 2).reshape(n, span * f)
    rows = len(x) - span + 1
    return sum(whole[j:j + rows, j * f:(j + 1) * f] for j in range(span))


def _pooled(z: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Largest response of each chunk; chunks are (first window, last + 1), and the last one ends with ``z``."""
    # windows between chunks fall into every second stretch
    return np.maximum.reduceat(z, chunks.reshape(-1)[:-1], axis=0)[::2]


def _probability(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x.astype(np.float64)))


def scores(net: Net, texts: list[bytes], room: int = 1 << 20) -> np.ndarray:
    """One probability per text, from all its bytes; about ``room`` bytes are worked at a time."""
    f = len(net.bias)
    top = np.full((len(texts), f), -np.inf, np.float64)
    total = np.zeros((len(texts), f), np.float64)
    count = np.zeros(len(texts), np.int64)

    def done(held: list[tuple[int, bytes]]) -> None:
        blocks, equal, chunks, owner = read_blocks(held)
        act = np.maximum(_pooled(_responses(net, _inputs(net, blocks, equal)), chunks) + net.bias, 0).astype(np.float64)
        np.maximum.at(top, owner, act)
        np.add.at(total, owner, act)
        np.add.at(count, owner, 1)

    held, size = [], 0
    for k, b in stretches(texts):
        held.append((k, b))
        size += len(b)
        if size >= room:
            done(held)
            held, size = [], 0
    if held:
        done(held)
    return _probability(np.concatenate((top, total / count[:, None]), axis=1) @ net.out[:-1] + net.out[-1]) if len(texts) else np.zeros(0)


# --- training -------------------------------------------------------------------------------------

def gradients(net: Net, blocks: np.ndarray, equal: np.ndarray, chunks: np.ndarray, owner: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean log loss of a batch of texts and its gradient by each array of the net; chunks stand text by text."""
    f, width = len(net.bias), net.code.shape[1]
    x = _inputs(net, blocks, equal)
    z = _responses(net, x)
    best = np.stack([a + z[a:b].argmax(axis=0) for a, b in chunks.tolist()])  # (chunks, F) window of each maximum
    act = np.maximum(np.take_along_axis(z, best, axis=0) + net.bias, 0)
    first = np.searchsorted(owner, np.arange(len(y)))
    n = np.diff(np.append(first, len(owner)))
    mean = np.add.reduceat(act, first, axis=0) / n[:, None]
    lead = np.stack([a + act[a:a + m].argmax(axis=0) for a, m in zip(first.tolist(), n.tolist())])  # (texts, F) chunk
    top = np.take_along_axis(act, lead, axis=0)
    features = np.concatenate((top, mean), axis=1)
    p = _probability(features @ net.out[:-1] + net.out[-1])
    loss = float(-np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-12)))
    g = ((p - y) / len(y)).astype(np.float32)
    d_out = np.append(features.T @ g, g.sum()).astype(np.float32)
    d_act = (g[:, None] * net.out[f:2 * f] / n[:, None])[owner]
    np.add.at(d_act, (lead, np.arange(f)), g[:, None] * net.out[:f])
    d_act *= act > 0
    d_filters = np.zeros_like(net.filters)
    d_code = np.zeros_like(net.code)
    for j in range(SPAN):
        rows = best + j
        d_filters[j] = np.einsum("cf,cfk->kf", d_act, x[rows], optimize=True)
        back = (d_act[:, :, None] * net.filters[j].T[None, :, :BLOCK * width]).reshape(-1, width)
        which = blocks[rows].reshape(-1)
        for e in range(width):
            d_code[:, e] += np.bincount(which, back[:, e], 256).astype(np.float32)
    return loss, [d_code, d_filters, d_act.sum(axis=0), d_out]


def fit(texts: list[bytes], y: np.ndarray, updates: int = 700, batch: int = 32, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Net:
    """A net for labels 0 and 1, by at least ``updates`` steps of Adam in shuffled batches with a falling rate; without
    both labels the fresh net."""
    net = fresh(seed)
    if len(set(y.tolist())) < 2:
        return net
    rng = np.random.default_rng(seed)
    share = float(y.mean())
    net.out[-1] = np.log(share / (1 - share))
    first, second, step = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()], 0
    steps = -(-len(y) // batch)
    steps *= -(-updates // steps)  # whole passes
    while step < steps:
        order = rng.permutation(len(y))
        for a in range(0, len(order), batch):
            at = order[a:a + batch]
            _, grads = gradients(net, *read_blocks(list(stretches([texts[i] for i in at]))), y[at])
            step += 1
            lower = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
            for w, m, v, g in zip(net.arrays(), first, second, grads):
                g = g + decay * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (lower * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


# --- on tables ------------------------------------------------------------------------------------

def remainder(column: str = "doc_id"):
    """crc32 of the id as text, modulo 3; null ids have none."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> DataFrame:
    """At most ``rows`` labelled documents, those of smallest hash, as (text, label); of a text longer than ``chars``
    eight stretches evenly spread over it."""
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("label IN (0, 1)")
              .filter(remainder() != 1).orderBy(*by, "label").limit(rows))
    part = chars // 8
    spread = F.concat(*[F.substring(F.col("text"), F.expr(f"1 + int(bigint(length(text) - {part}) * {k} div 7)"), F.lit(part)) for k in range(8)])
    # the broadcast side has ``rows`` rows of 12 bytes
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", F.when(F.length("text") > chars, spread).otherwise(F.col("text")).alias("text"), "label")
            .orderBy(*by, "label", "text").limit(rows).select("text", "label"))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = 2000, chars: int = 8192, **training) -> DataFrame:
    """(doc_id, score) of documents (doc_id, text), with labels (doc_id, quality); 1 is good.

    The net is fitted on at most ``rows`` labelled documents whose crc32 of the id is not 1 modulo 3, of ``chars``
    characters each: the driver holds no more than that, 16 million characters by default.  Every document is scored
    from its whole text, and nothing but its text.  Null and empty texts are scored as one empty
    block; equal texts score alike up to the rounding
    of 32-bit floats; null or repeated ids all stay; an empty table gives no rows; without
    labels of both kinds the net stays as drawn; further columns are not read.  Repeated or null labels
    count as further or no examples.
    """
    sample = training_rows(docs, labels, rows, chars).collect()
    net = fit([(r["text"] or "").encode() for r in sample], np.array([r["label"] for r in sample], np.int64), **training)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in parts(batch):
                texts = [t or b"" for t in one.column("text").cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([one.column("doc_id"), pa.array(scores(net, texts))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
