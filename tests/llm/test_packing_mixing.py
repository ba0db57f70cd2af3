"""Packing by exact round trip, mixing against plain Python."""

import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import pytest

from wakeline.llm import mixing, packing, token_matrices
from wakeline.llm.tokens import WordTokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, ids string, start string"
ODD = ["Don't we'll 3rd, x1y2 'SS naïve Été ÆØÅ ß İstanbul ΑΣΣ", "a\x1cb c\x85d e\xa0f g​h", "<|endoftext|> x<|startoftext|>y",
       "é café, ́start", "漢字 кот 🙂🙂,.!?", "  \n", "AKIA-12/34_[x](y)", "a.b,c. d., e,", "\x00\x01 ﻿z", "ﬁ Ⅷ Kelvin K"]


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(PATH)
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i} lorem" for i in range(6000))
    rows = [(i, t, "s", "x", "y") for i, t in enumerate(ODD)] + [(50, None, None, None, None), (51, "", "s", None, None), (52, long, "s", None, None),
            (None, "null id", "s", None, None), (3, "again", "s", None, None)]
    rows += [(100 + i, " ".join(["pack me"] * (i * 7 % 400)), "s", None, None) for i in range(150)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_ids_equal_the_tokenizer(direct):
    words = WordTokenizer(PATH)
    words.LETTERS = words.PIECES = 3  # the memories are emptied again and again
    for text in ODD + ["The cat, the Cat. THE cat the,"]:
        ids = words.ids(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) + [2] == direct(text), text


def test_ids_of_a_batch(direct):
    import pyarrow as pa

    words = WordTokenizer(PATH)
    words.LETTERS = words.PIECES = 5
    texts = ODD + ["The cat, the Cat. THE cat the,", "", "a\x1cb \x85 c\u3000d e\xa0f", "漢字" * 300, "x" * 500]
    for array in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        assert [list(struct.unpack(f"<{len(b) // 4}I", b)) + [2] for b in words.batch(array)] == [direct(t) for t in texts]
    assert words.batch(pa.array([], pa.string())) == [] and words.batch(pa.array(["", " "])) == [b"", b""]
    assert max(map(len, words.pieces)) <= words.SHORT


def test_a_very_long_document_is_cut_in_one_walk():
    import time

    windows = packing.Windows(4096, 4, 0)
    ids = bytes(4 * 20_000_001)
    began = time.process_time()
    windows.add(1, 0, ids, 20_000_001)
    assert time.process_time() - began < 5
    windows.finish()
    assert sum(r[2] for r in windows.rows) == 20_000_001 and [r[1] for r in windows.rows[:3]] == [0, 4096, 8192]


def check_pieces(pieces, want):
    """Every id in exactly one piece, sequences gapless and full or powers of two."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    got = []
    for (doc, total), parts in by_doc.items():
        starts = sorted((p["start"], p["length"], p["ids"]) for p in parts)
        ids = b"".join(x[2] for x in starts)
        got.append((doc, list(struct.unpack(f"<{len(ids) // 4}I", ids))))
        at = 0
        for start, length, raw in starts:
            assert start == at and len(raw) == 4 * length
            at += length
        assert at == total
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096 and at & (at - 1) == 0
    return len(by_seq)


def test_packing_round_trip(docs, direct):
    pieces = packing.pack_documents(docs, PATH, fan_in=2).collect()
    check_pieces(pieces, [(r["doc_id"], direct(r["text"])) for r in docs.collect()])


def test_few_windows(docs, direct):
    pieces = packing.pack_documents(docs, PATH, open_windows=1).collect()
    check_pieces(pieces, [(r["doc_id"], direct(r["text"])) for r in docs.collect()])


def test_packing_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(none, PATH).collect() == []
    assert token_matrices.token_matrices(none, PATH).collect() == []


def test_packing_query(spark, direct):
    from wakeline.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    ids = {r["doc_id"]: direct(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_packing"](spark, sf).collect()
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and r["doc_tokens"] == len(ids[r["doc_id"]])


def test_best_fit_decreasing():
    lengths = [(i * 37) % 64 + 1 for i in range(300)]
    bins = token_matrices.best_fit_decreasing(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(300))
    free = []  # the same by search through all bins
    want = []
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        fits = [f for f in free if f >= lengths[i]]
        want.append(min(fits) if fits else 64)
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 64) - lengths[i])
    assert len(free) == len(bins) and sorted(free) == sorted(64 - sum(lengths[i] for i in b) for b in bins)


def test_token_matrices(docs, direct, tmp_path):
    made = token_matrices.token_matrices(docs, PATH, buffer_tokens=20_000)
    token_matrices.write_matrices(made, f"{tmp_path}/m")
    rows = docs.sparkSession.read.parquet(f"{tmp_path}/m").collect()
    ids, positions, cu = token_matrices.arrays(rows)
    parts = defaultdict(dict)
    for k, r in enumerate(rows):
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] and len(r["doc_ids"]) == len(r["cu_seqlens"]) - 1
        assert (ids[k, r["n_tokens"]:] == 0).all()
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], cu[k], cu[k][1:]):
            assert list(positions[k, a:b]) == list(range(b - a))
            parts[doc].setdefault(start, []).append(ids[k, a:b].tolist())
    for r in docs.collect():
        want, at = direct(r["text"]), 0
        while at < len(want):
            assert want[at:at + 4096] in parts[r["doc_id"]][at]
            at += 4096
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def plain_mix(rows, repeats=3, weights=(1, 2, 3)):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = defaultdict(int)
    for _, t, s in rows:
        sums[s] += size(t)
    names = sorted(sums, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sums.values()))
    while True:
        over = {s for s in free if left * weight[s] / sum(weight[f] for f in free) > repeats * sums[s] + 1e-9}
        if not over:
            break
        for s in over:
            target[s] = float(repeats * sums[s])
        free -= over
        left = sum(sums.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
    out, ahead = [], defaultdict(int)
    for d, t, s in sorted(rows, key=lambda r: (hashlib.md5(("mix" if r[0] is None else f"mix|{r[0]}").encode()).hexdigest(), r[0] or 0)):
        n = size(t)
        taken = sum(max(0, min(n, int(target[s] + 1e-9) - e * sums[s] - ahead[s])) for e in range(repeats))
        ahead[s] += n
        out.append((d, n, sums[s], round(target[s], 6), taken))
    return sorted(out, key=repr)


def mixed(docs):
    """What is served from the sorted queue, which is what every document takes of its own turns before time 1."""
    from pyspark.sql import functions as F
    rows = lambda df: sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in df.collect()), key=repr)
    turns = mixing.queue(docs).select("doc_id", "size", "source_size", "target", F.expr("aggregate(copies, 0L, (a, c) -> a + c.taken)").alias("taken"))
    served = rows(mixing.serve(docs))
    assert served == rows(turns)
    return served


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * ((i * 31) % 90)), None if i % 11 == 0 else f"s{i % 5}" if i % 3 else "Z") for i in range(400)]
    rows += [(1000, None, "tiny"), (1001, "one two", "tiny"), (1002, "", "empty"), (1003, "a b c", ""), (1004, "d e f", "\U00010000")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", __import__("pyspark").sql.functions.lit("x"))
    got = mixed(docs)
    assert got == plain_mix(rows) == mixed(docs)
    turns = mixing.mix(docs.drop("size"))
    out = turns.collect()
    assert [r["finish"] for r in out] == sorted(r["finish"] for r in out)
    assert all(len((r["text"] or "").split()) == r["taken"] for r in out)
    assert sum(r["taken"] for r in out) == sum(r[4] for r in got)


def test_mixing_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.queue(spark.createDataFrame([], schema)).collect() == mixing.serve(spark.createDataFrame([], schema)).collect() == []
    assert mixed(spark.createDataFrame([(1, None, None), (2, "", "a")], schema)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    twice = spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s"), (1, "c", "s")], schema)
    assert sorted(r[4] for r in mixed(twice)) == [1, 2, 2]


def test_rows_without_words_and_clashing_names(spark):
    rows = [(None, None, None)] * 5 + [(None, "", "s")] * 4 + [(7, " \n", "s")] * 3 + [(8, "a b c", "s")] * 2 + [(9, "d", None)]
    docs = spark.createDataFrame([(*r, 1, "k", 2, 3) for r in rows],
                                 "doc_id long, text string, source string, taken int, _key string, _nth int, _served int")
    got = mixing.serve(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got.collect()), key=repr) == plain_mix(rows)


def test_targets_by_ranges(spark):
    rng = random.Random(4)
    sizes = {None: 70, **{f"h{i}": rng.choice([0, 1, 5, 40, 900, 40_000]) for i in range(300)}}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(5)
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = {}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    free = set(names)
    while True:
        left = sum(sizes.values()) - sum(want.values())
        over = {s for s in free if left * weight[s] > 3 * sizes[s] * sum(weight[f] for f in free)}
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    want |= {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert sum(got[s] == 3 * sizes[s] for s in got) > 50


def test_mixing_table_against_sql(spark):
    from tests.compare import duck, spark_rows, sql_rows
    from wakeline.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.01"
    got, want = spark_rows(QUERIES["op9_mixing"](spark, sf)), sql_rows(duck(sf), ORACLES["op9_mixing"])
    assert got == want and len(got[1]) == 1000
