"""Token ids of whole texts as little-endian unsigned 32-bit bytes, with a bounded memory of words.

The tokenizer drops white space and never joins characters across it, so a text's ids are those of
its white-space separated pieces in order.  A piece of plain letters with at most one stop or comma
is taken apart and its letters go straight to the vocabulary model; any other piece goes through the
whole tokenizer.  Both results are remembered per process, within the limits below.  A piece that holds other white space
than the ASCII characters goes through the whole tokenizer too, so cutting at those alone is enough.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa

from wakeline.llm.words import split

_LOADED: dict[str, "WordTokenizer"] = {}
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch
_CONTROL = re.compile("[\x1c-\x1f]").search
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+").split


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else
    the next code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def plain_letters(words: pa.Array, longest: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For words (large strings, none empty): which are plain letters with at most one stop or comma behind and no
    more than ``longest`` bytes; those in lower case without it; and 0, 1 or 2 for none, a stop or a comma."""
    _, ends, data = words.buffers()
    at = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    size, last = np.diff(at), at[1:] - 1
    # letters from U+00C0 to U+00FF are the byte C3 and one more; D7 and F7 (bytes 97, B7) are signs
    latin = np.zeros(len(raw), bool)
    latin[1:] = raw[:-1] == 0xC3
    latin &= (raw != 0x97) & (raw != 0xB7)
    ascii_upper = (raw >= 65) & (raw <= 90)
    fine = ascii_upper | ((raw >= 97) & (raw <= 122)) | (raw == 0xC3) | latin
    stop = np.select([raw[last] == 46, raw[last] == 44], [1, 2], 0)
    fine[last[stop > 0]] = True
    bare = size - (stop > 0)
    plain = np.logical_and.reduceat(fine, at[:-1]) & (bare > 0) & (size <= longest)
    stop[~plain] = 0
    lower = raw + ((ascii_upper | (latin & (raw <= 0x9E))) * np.uint8(32))
    kept = np.repeat(plain, size)
    kept[last[stop > 0]] = False
    offsets = np.zeros(int(plain.sum()) + 1, np.int64)
    np.cumsum(bare[plain], out=offsets[1:])
    return plain, pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(lower[kept])), stop


class WordTokenizer:
    """Use ``WordTokenizer.load(path)``: one instance per process and file."""

    LETTERS, PIECES = 500_000, 300_000  # words remembered; a full memory is emptied
    SHORT = 64  # characters of the longest piece remembered

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.shown = _byte_letters()
        self.letters: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.stops = {s: self._whole(s) for s in ".,"} | {"": b""}

    @staticmethod
    def load(path: str) -> "WordTokenizer":
        if path not in _LOADED:
            _LOADED[path] = WordTokenizer(path)
        return _LOADED[path]

    def _whole(self, piece: str) -> bytes:
        ids = self.whole.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of an array without nulls: pieces are cut, lower-cased and told apart in whole arrays, each
        different one is looked up once, and the ids of all pieces are laid out by ``take``."""
        found = split(texts)
        if not len(found.words):
            return [b""] * len(texts)
        plain, bases, stop = plain_letters(found.words, self.SHORT)
        coded, others = bases.dictionary_encode(), found.words.filter(pa.array(~plain)).dictionary_encode()
        known, make = self.letters.get, self._letters
        ids = [known(w) or make(w) for w in coded.dictionary.to_pylist()]
        known, make = self.pieces.get, self._piece
        ids += [known(p) or make(p) for p in others.dictionary.to_pylist()]
        # a piece is laid out as its letters and its stop
        where = np.empty((len(plain), 2), np.int64)
        where[plain, 0] = coded.indices.to_numpy()
        where[~plain, 0] = len(coded.dictionary) + others.indices.to_numpy()
        where[:, 1] = len(ids) + stop
        ids += [b"", self.stops["."], self.stops[","]]
        laid = pa.array(ids, pa.large_binary()).take(pa.array(where.ravel()))
        _, ends, data = laid.buffers()
        at = np.frombuffer(ends, np.int64)[laid.offset:laid.offset + len(laid) + 1][2 * found.first].tolist()
        raw = memoryview(data)
        return [bytes(raw[a:z]) for a, z in zip(at, at[1:])]

    def _letters(self, word: str) -> bytes:
        """Ids of lower-case letters, which stand for themselves in the vocabulary if they are plain."""
        shown = word if word.isascii() else "".join(map(self.shown.__getitem__, word.encode()))
        ids = [t.id for t in self.model.tokenize(shown)]
        if len(self.letters) >= self.LETTERS:
            self.letters.clear()
        out = self.letters[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _piece(self, piece: str) -> bytes:
        if len(piece) > self.SHORT:
            return self._whole(piece)
        found = _SIMPLE(piece)
        if not found:
            out = self._whole(piece)
        else:
            word = found[1].lower()
            out = (self.letters.get(word) or self._letters(word)) + self.stops[found[2]]
        if len(self.pieces) >= self.PIECES:
            self.pieces.clear()
        self.pieces[piece] = out
        return out

    def ids(self, text: str) -> bytes:
        known, make = self.pieces.get, self._piece
        return b"".join([known(p) or make(p) for p in (_ASCII_SPACE(text) if _CONTROL(text) else text.split()) if p])
