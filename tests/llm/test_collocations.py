"""Collocations against a direct count."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import collocations, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=100, longest=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    f = {p: a for p, a in f.items() if a >= least}
    inside = {}
    for p, a in f.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                q = (p[0], *p[i:i + k])
                inside[q] = max(inside.get(q, 0), a)
    out = {}
    for p, a in f.items():
        lang, words = p[0], p[1:]
        if len(words) < 2 or inside.get(p, 0) >= a:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in df.collect())


HARD = [(None, "New York City is new york, city! NEW YORK"), ("und", "new york city"), ("en", None), ("en", ""), ("en", " . ,; "),
        ("en", "a a a a a a a a"), ("en", "a\ta\x0ba\x0ca a"), ("fr", "É é É é"), ("en", "a a a a a a a a"), ("de", "x y z x y z"),
        ("en", "one two three four five six one two three four five six"), ("en", "one two three four five six")]


def test_hard_rows(spark):
    frame = spark.createDataFrame([(i, *r, 1, 2) for i, r in enumerate(HARD)], "doc_id long, lang string, text string, n int, chunk int")
    for least in (1, 2, 3):
        assert rows_of(collocations.collocations(frame, least=least)) == plain(HARD, least)
    assert rows_of(collocations.collocations(frame, least=2, top=2, longest=3)) == plain(HARD, 2, 3, 2)


def test_chunks_inside_a_text(spark, monkeypatch):
    """Phrases over the border of two chunks of one text are counted once."""
    rng = np.random.default_rng(3)
    rows = [("en", " ".join(rng.choice(list("abcde,"), 400))), ("fr", "b a " * 150)]
    codes, langs, words = collocations._coded(__import__("pyarrow").RecordBatch.from_pydict(
        {"lang": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    monkeypatch.setattr(collocations, "CHUNK_PLACES", 37)
    owned = Counter()
    for own, here, ls, ws, counts in collocations._chunk_rows(codes, langs, words, 3):
        names = list(zip(ls.to_pylist(), ws.to_pylist()))
        for i in range(own):
            if len(here) > i + 2 and min(here[i:i + 3]) >= 0:
                owned[tuple(names[c] for c in here[i:i + 3])] += 1
        assert counts.sum() == (here[:own] >= 0).sum()
    whole = Counter()
    for lang, text in rows:
        for piece in text.split(","):
            w = [(lang, x) for x in piece.split()]
            whole.update(zip(w, w[1:], w[2:]))
    assert owned == whole


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.integers(1, 700), st.integers(0, 3000), st.integers(0, 5), st.sampled_from([1, 40, 10 ** 9]))
def test_count_pairs(n_left, n_right, n, seed, dense):
    rng = np.random.default_rng(seed)
    left = (n_left * rng.random(n) ** 4).astype(np.int64)
    right = (n_right * rng.random(n) ** 4).astype(np.int64)
    before = collocations.DENSE
    collocations.DENSE = dense
    try:
        a, b, times, place = collocations.count_pairs(left, right, n_left, n_right)
    finally:
        collocations.DENSE = before
    assert dict(zip(zip(a.tolist(), b.tolist()), times.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    assert (a[place] == left).all() and (b[place] == right).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(0, 9), st.integers(1, 5))
def test_levels_over_chunk_borders(width, seed, least):
    """Pairs of neighbouring phrases, sent from chunks of any width and merged, are the frequent phrases of each length."""
    words = np.random.default_rng(seed).integers(-1, 3, 90)
    chunks = {}
    for a in range(0, len(words), width):
        chunks[a] = (min(width, len(words) - a), words[a:a + width + 4], np.arange(3))
    names = [(w,) for w in range(3)]
    for k in range(2, 6):
        sent = []
        for a, (own, heads, ids) in chunks.items():
            row = collocations._counted(a, own, heads, ids, 3).to_pylist()[0]
            sent += [{"chunk": a, **m} for m in row["messages"]]
            chunks[a] = (row["own"], collocations._unpacked(row["places"]) - 1, ids)
        total, held = Counter(), {a: [] for a in chunks}
        for m in sent:
            pairs = list(zip(collocations._summed(m["left"]).tolist(), collocations._unpacked(m["right"]).tolist()))
            for i, (pair, n) in enumerate(zip(pairs, collocations._unpacked(m["counts"]).tolist())):
                total[pair] += n
                held[m["chunk"]].append((m["start"] + i, pair))
        kept = sorted(p for p, n in total.items() if n >= least)
        phrases = Counter(tuple(words[i:i + k].tolist()) for i in range(len(words) - k + 1) if words[i:i + k].min() >= 0)
        assert {names[x] + names[y][-1:]: total[x, y] for x, y in kept} == {p: n for p, n in phrases.items() if n >= least}
        rank = {p: i for i, p in enumerate(kept)}
        names = [names[x] + names[y][-1:] for x, y in kept]
        for a, (own, places, _) in chunks.items():
            mine = [(local, rank[p]) for local, p in held[a] if p in rank]
            chunks[a] = (own, *collocations._renumbered(places, np.array([x for x, _ in mine], np.int64), np.array([y for _, y in mine], np.int64)))


@pytest.mark.parametrize("values", [[], [0], [255], [256, 0], [70_000, 3], [1 << 40, 1]])
def test_packed(values):
    assert collocations._unpacked(collocations._packed(np.array(values, np.int64))).tolist() == values


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 1)], "lang string, phrase string, k int, f long")
    n = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: (phrases, n))
    assert rows_of(collocations.collocations(None)) == [
        ("en", 1, "a b", big - 1, big, big + 7, 9 * big, 1000 * (big - 1) * 9 * big // (big * (big + 7)))]


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    expected = plain(rows)
    assert expected
    assert rows_of(queries.QUERIES["op12_collocations"](spark, sf)) == expected
