"""Words of whole batches of texts, cut at single-byte separators, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Words(NamedTuple):
    words: pa.Array  #: all words, text by text
    first: np.ndarray  #: place of the first word of each text, and the number of words at the end
    piece: np.ndarray  #: number of break characters before each word


def split(texts: pa.Array, separators: bytes = SPACES, breaks: bytes = b"", lower: bool = False) -> Words:
    """Cut texts (null: empty) at runs of ``separators`` and ``breaks``, all of them ASCII, so that no
    byte of a longer UTF-8 character is taken for one; with ``lower``, A-Z become a-z."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    if lower:
        raw = _LOWER[raw]
    is_word = np.ones(256, bool)
    is_word[list(separators + breaks)] = False
    inside = is_word[raw]
    # a word begins behind a separator or at the start of a text, and ends likewise
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = at[:-1][at[:-1] < at[1:]]
    begins[filled] = inside[filled]
    lasts = at[1:][at[:-1] < at[1:]] - 1
    stops[lasts] = inside[lasts]
    starts, ends_ = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends_ - starts, out=offsets[1:])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))
    piece = np.zeros(len(starts), np.int64)
    if breaks:
        is_break = np.zeros(256, bool)
        is_break[list(breaks)] = True
        piece = np.searchsorted(np.flatnonzero(is_break[raw]), starts)
    return Words(found, np.searchsorted(starts, at), piece)


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and held + n > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def joined(words: pa.Array, first: np.ndarray) -> pa.Array:
    """One string per text: its words with one space between them."""
    lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), words)
    return pc.binary_join(lists, pa.scalar(" ", words.type))
