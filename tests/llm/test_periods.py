"""Runs of repeated words against a direct search."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import periods, queries
from wakeline.llm.words import split

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, q, n) for (s, n), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4), sha(listed), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def found_in(texts, **kwargs):
    numbers = {}
    words = [t.split() for t in texts]
    flat = np.array([numbers.setdefault(w, len(numbers)) for t in words for w in t], np.int64)
    first = np.cumsum([0] + [len(t) for t in words])
    rows = periods.find(flat, first, **kwargs)
    return [sorted((int(s), int(q), int(n)) for k, s, n, q in rows if k == i) for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text("ab", max_size=60), st.text("abc", max_size=80),
    st.tuples(st.text("abc", max_size=9), st.text("ab", min_size=1, max_size=12), st.integers(1, 9), st.text("abc", max_size=5))
    .map(lambda x: x[0] + x[1] * x[2] + x[1][:len(x[1]) // 2] + x[3])), max_size=5), st.sampled_from([3, 4, 5]))
def test_find(texts, times):
    texts = [" ".join(t) for t in texts]
    assert found_in(texts, times=times) == [plain_runs(t.split(), times=times) for t in texts]


def test_sums_that_are_multiples_of_the_modulus(monkeypatch):
    """An occurrence that the sums only seem to show is turned down."""
    monkeypatch.setattr(periods, "occurrences", lambda b, w: np.ones((len(b), b.shape[1]), bool))
    texts = ["a b c d " * 6 + "a a b", "x y " * 9 + "z " + "x y " * 9, "q " * 40]
    assert found_in(texts) == [plain_runs(t.split()) for t in texts]


def test_transform():
    rng = np.random.default_rng(1)
    for b in (1, 2, 8, 64):
        blocks = rng.integers(0, 3, (50, b)).astype(np.uint64)
        windows = rng.integers(0, 3, (50, 2 * b)).astype(np.uint64)
        windows[::3, b // 2:b // 2 + b] = blocks[::3]
        plain = [[(w[k:k + b] == x).all() for k in range(b)] for x, w in zip(blocks, windows)]
        assert (periods.occurrences(blocks, windows) == np.array(plain)).all()
        assert (periods.transform_back(periods.transform(windows)) == windows).all()


@pytest.mark.parametrize("text", ["w " * 300_000, "a b c " * 100_000, ("a " * 200 + "x ") * 1000, " ".join(map(str, range(200_000)))])
def test_long_text_is_not_quadratic(text):
    rows = found_in([text])[0]
    assert len(rows) == (0 if "1" in text else 1 if "x" not in text else 1001)


def test_words_across_texts_and_characters():
    import pyarrow as pa

    got = split(pa.array(["a b c", None, "", "\t\x0bd", "e", " ", "é\x85f"]).slice(0))
    assert got.words.to_pylist() == ["a b", "c", "d", "e", "é\x85f"]
    assert got.first.tolist() == [0, 2, 2, 2, 3, 4, 4, 5]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([None, "", "Ab c", "x", "É Q.", " "]), max_size=9), st.integers(0, 9), st.integers(0, 9), st.booleans())
def test_words_of_slices(texts, first, n, large):
    import pyarrow as pa

    rows = pa.array(texts, pa.large_string() if large else pa.string()).slice(first, n)
    for t in (rows, pa.chunked_array([rows, rows]).combine_chunks()):
        words = [re.findall("[^ .]+", "".join(c.lower() if c < "\x80" else c for c in x or "")) for x in t.to_pylist()]
        got = split(t, b" ", b".", lower=True)
        assert got.words.to_pylist() == [w for ws in words for w in ws]
        assert got.first.tolist() == [sum(map(len, words[:k])) for k in range(len(words) + 1)]


def test_query_rows(spark, tmp_path):
    rep = [(i, f"start {i} " + "one two three " * (i % 7) + "end") for i in range(120)]
    rows = [*rep, (7, "again " * 9), (7, "again " * 9), (None, "n " * 8), (500, None), (501, ""), (502, " \n"), (503, "é " * 4000 + "x"),
            (-3, "minus " * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'c' AS collapsed", "2 AS n_words")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op11_word_runs"](spark, str(tmp_path)).select(COLUMNS).collect()]
    plain = [plain_row(*r) if r[0] is not None else (None, *plain_row(1, r[1])[1:]) for r in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(plain, key=key)


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op11_word_runs"](spark, SF).select(COLUMNS).collect()}
    assert got == {d["doc_id"]: plain_row(*d) for d in docs}


def test_empty_table(spark):
    assert periods.word_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
