"""Near-duplicate texts and vectors against brute force over all pairs; licence scan against plain Python."""

import random
import re
from itertools import combinations

import numpy as np

from wakeline.llm import embeddings, hashes, licenses, minmax, store
from wakeline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    up = {n: n for n in nodes}
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (100, 300)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    edges = spark.createDataFrame(links + links[:5], "a long, b long")
    got = {r["node"]: r["component"] for r in store.components(spark, edges).collect()}
    assert got == roots({n for e in links for n in e}, links)
    assert store.components(spark, edges.limit(0)).collect() == []


def test_stars_take_no_round(spark, monkeypatch):
    labels, held = [], store.keep
    monkeypatch.setattr(store, "keep", lambda df, label: (labels.append(label), held(df, label))[1])
    edges = spark.createDataFrame([(1, 5), (9, 1), (1, 9), (2, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in store.components(spark, edges).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 2: 2, 3: 2} and labels == ["edges"]


def plain_set(t, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def check_near(rows, got, width, percent):
    sets = {d: plain_set(t, width) for d, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        d: (len(sets[d]), want[d], want[d] == d) for d in sets}
    return len(links)


def near_rows(rng):
    vocab = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(3000)]
    rows, n = [(0, None), (1, ""), (2, " \n"), (3, "Hello"), (4, "hello"), (5, "hello world"), (6, "HELLO\tWORLD"), (7, "é É")], 10
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((n, " ".join(copy)))
            n += 1
            if rng.random() < 0.3:
                base = copy  # chains
    rng.shuffle(rows)
    return rows


def test_near_texts(spark):
    for seed, width, percent, block in ((1, 3, 85, 128), (2, 5, 80, 3), (3, 3, 85, 2)):
        rows = near_rows(random.Random(seed))
        docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n string").repartition(3)
        assert check_near(rows, minmax.near_texts(docs, width=width, percent=percent, block=block).collect(), width, percent) > 50


def test_near_texts_edges(spark):
    schema = "doc_id long, text string, component_id string"
    assert minmax.near_texts(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(f"x{i}" for i in range(200_000))
    docs = spark.createDataFrame([(None, "a b c d e f", None), (1, "a b c d e f", None), (1, "other words altogether here now", None),
                                  (2, long, "z"), (3, long + " y", "z"), (3, long + " y", "z")], schema)
    got = sorted(map(tuple, minmax.near_texts(docs).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 1, 1, True), (2, 199_996, 2, True), (3, 199_997, 2, False), (3, 199_997, 2, False)], key=repr)
    left = minmax.one_of_each(docs)
    assert left.columns == docs.columns and sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 1, 2]


def test_near_texts_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check_near(rows, QUERIES["op10_minmax_near_dup"](spark, SF).collect(), 3, 85) > 0


def plain_vectors(rows, limit):
    ok = {}
    for d, v, label in rows:
        if d is not None and label is not None and v is not None and None not in v and embeddings.usable(np.array(v, float)):
            ok[d] = (label, np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [(a, b) for a, b in combinations(sorted(ok), 2) if ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1])
             and ok[a][1] @ ok[b][1] >= limit]
    ids = [d for d, _, _ in rows if d is not None]
    root = roots(set(ids), links)
    n = {d: sum(d in e for e in links) for d in ids}
    return {d: (n[d], root[d], root[d] == d) for d in ids}, len(links)


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows, n = [(0, None, 1), (1, [0.0] * 16, 1), (2, [float("nan")] * 16, 1), (3, [1.0, None], 1), (4, [], 1), (5, [1.0, 2.0], None), (6, [1.0, 0.0], 2), (7, [2.0, 0.0], 2)], 10
    for k in range(30):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 15))):
            v = base if rng.random() < 0.4 else base + rng.standard_normal(16) * 0.1
            rows.append((n, [float(x) for x in v], None if k == 3 else int(k % 3)))
            n += 1
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, n_links string").repartition(3)
    want, links = plain_vectors(rows, 0.98)
    assert links > 100
    for block in (512, 2):
        got = embeddings.near_vectors(docs, block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want
    assert embeddings.near_vectors(docs.limit(0)).collect() == []


def test_near_vectors_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, _ = plain_vectors(rows, 0.98)
    got = QUERIES["op8_embedding_near_dup"](spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want


TEXTS = [None, "", "The MIT License (MIT). mit\nlicense; é license MIT license", "Licensed under the Apache License, Version 2.0. apache-license",
         "GNU General Public License, version 3 general public license", "SPDX-License-Identifier: GPL-2.0-or-later", "mitlicense licensemit MIT  License!",
         "see https://www.apache.org/licenses/LICENSE-2.0 and CC BY-NC-SA 4.0", "Permission is hereby granted, free of charge, to any person obtaining a copy",
         "All rights reserved. ALL RIGHTS RESERVED", "nothing 12 ÀÉ ß_x", "İ MIT License ſ K"]


def plain_base(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if tuple(words[i:i + len(phrase)]) == phrase]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "mit license", "x")], "doc_id long, text string, labels string")
    got = {r["doc_id"]: r for r in licenses.license_scan(docs).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain_base(t), t
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        every = {r[2] for r in licenses.RULES}  # without the filter
        assert [(d["start"], d["end"], d["label"]) for d in r["detections"]] == [f[:3] for f in licenses.detect(low, every)]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[5]["labels"] == "gpl" and got[7]["labels"] == "apache,cc-by-nc-sa" and got[8]["labels"] == "mit" and got[10]["labels"] == ""
    assert len(licenses.RULES) > 200 and licenses.license_scan(docs.limit(0)).collect() == []


def test_license_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_license_scan"](spark, SF).collect():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain_base(texts[r["doc_id"]])


def test_window_hashes():
    raw = np.frombuffer(b"abcabcabdabc" * 50, np.uint8)
    total = hashes.sums(raw)
    at = np.arange(len(raw) - 6)
    got = hashes.span(total, at, at + 6)
    by = {}
    for i in at.tolist():
        by.setdefault(raw[i:i + 6].tobytes(), set()).add(int(got[i]))
    assert all(len(s) == 1 for s in by.values()) and len({next(iter(s)) for s in by.values()}) == len(by)
