"""Repeated strings and shared blocks against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from wakeline.llm import line_alignment, suffixes
from wakeline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_removed(texts):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if count[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = [(i, i + len(run)) for i, run in _runs(bytes(gone))]
        kept = bytes(c for c, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), spans, kept))
    return out


def _runs(flags):
    i = 0
    for part in flags.split(b"\0"):
        if part:
            yield i, part
        i += len(part) + 1


def repeat_texts(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = [prose(60), prose(45), "é" * 150, prose(300)]
    texts = [None, "", "short", "x" * 199, "x" * 200, "y" * 201, "ab" * 300, prose(400)]
    texts += [prose(rng.randrange(0, 60)) + rng.choice(passage) + prose(rng.randrange(0, 60)) for _ in range(40)]
    base = prose(150)
    for _ in range(60):  # near copies
        copy = base.split(" ")
        copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    p = prose(1000)
    texts += [p, p, p[:199] + "Z" + p[200:], p[3:260], p[:150] + p[:150] + p[:150], prose(20) + p[100:299], prose(20) + p[400:600]]
    return texts


def test_suffix_dedup(spark):
    for seed, limit in ((1, 2000), (2, 3)):
        texts = repeat_texts(random.Random(seed))
        docs = spark.createDataFrame([(i if i != 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
        rows = suffixes.remove_repeats(docs.repartition(4), group_limit=limit, bucket_bytes=4000 if limit == 3 else 8 << 20).collect()
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows}
        for i, want in enumerate(plain_removed(texts)):
            assert got[i if i != 9 else None] == want, i
    assert suffixes.remove_repeats(docs.limit(0)).collect() == []


def test_suffix_rows_repeat(spark):
    docs = spark.createDataFrame([(1, "q" * 100 + "w" * 130), (1, "q" * 100 + "w" * 130), (1, "other" * 50)], "doc_id long, text string")
    assert sorted((r["n_bytes"], r["n_removed"]) for r in suffixes.remove_repeats(docs).collect()) == [(230, 230), (230, 230), (250, 250)]


def test_unique_text_beside_one_of_equal_short_hash(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(320)) for _ in range(200_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    twins = frame.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b").orderBy("a").first()
    docs = spark.createDataFrame([(None, twins["a"]), (1, twins["a"]), (None, twins["b"])], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in suffixes.remove_repeats(docs).collect()) == [0, 320, 320]


def test_many_equal_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    docs = spark.range(3_000).selectExpr("CAST(NULL AS long) AS doc_id", f"'{text}' AS text")
    got = suffixes.remove_repeats(docs).groupBy("n_bytes", "n_removed").count().collect()
    assert [tuple(r) for r in got] == [(500, 500, 3_000)]


def test_long_text_in_parts(spark, monkeypatch):
    rng = random.Random(3)
    t = "".join(rng.choice("abcdefgh") for _ in range(1_400_000))
    texts = [t, t[700_000:1_200_000], t[1_044_000:1_045_000]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], [tuple(s) for s in r["spans"]]) for r in suffixes.remove_repeats(docs).collect()}
    assert got == {0: (500_000, [(700_000, 1_200_000)]), 1: (500_000, [(0, 500_000)]), 2: (1000, [(0, 1000)])}


def test_suffix_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, plain_removed([r["text"] for r in rows]))}
    for r in QUERIES["op6_suffix_dedup"](spark, SF).collect():
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, len(spans), hashlib.sha256(kept).hexdigest())


def test_loser_tree():
    rng = random.Random(4)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 30))), b"%d" % rng.randrange(9)) for _ in range(rng.randrange(0, 60)))
                for _ in range(k)]
        merged = list(suffixes.merge_runs([suffixes.encode_run(r) for r in runs]))
        assert sorted((s, p) for _, s, p in merged) == sorted(x for r in runs for x in r)
        assert [s for _, s, _ in merged] == sorted(s for _, s, _ in merged)
        for (_, a, _), (n, b, _) in zip(merged, merged[1:]):
            assert n == suffixes.common(a, b)


def test_patience():
    assert line_alignment.patience(list("abcde"), list("abxde")) == [(0, 0), (1, 1), (3, 3), (4, 4)]
    assert line_alignment.patience(list("xaya"), list("ayax")) in ([(1, 0), (2, 1), (3, 2)],)
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghijkl") for _ in range(rng.randrange(0, 25))] for _ in range(2))
        pairs = line_alignment.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        if a:
            assert line_alignment.patience(a, list(a)) == [(i, i) for i in range(len(a))]


def plain_clean(rows, min_words=20, rare=100):
    """doc_id -> text without shared blocks; ids are unique."""
    texts = {d: t or "" for d, t in rows}
    first = {}
    for d in sorted(texts):
        first.setdefault(texts[d], d)
    lines = {d: [x.strip() for x in t.split("\n")] for d, t in texts.items()}
    df, owner = Counter(), {}
    for d in sorted(first.values()):
        for x in {x for x in lines[d] if x.split()}:
            df[x] += 1
            owner.setdefault(x, d)
    out = {}
    for d, t in texts.items():
        words = [len(x.split()) for x in lines[d]]
        gone = set()
        if first[t] != d:
            gone = set(range(len(words))) if sum(words) >= min_words else set()
        else:
            with_owner = defaultdict(set)
            for x in lines[d]:
                if df[x] > 1 and owner[x] != d:
                    with_owner[owner[x]].add(x)
            least = min((df[x] for xs in with_owner.values() for x in xs), default=0)
            for o, xs in with_owner.items():
                if min(df[x] for x in xs) <= max(rare, least) or max(len(x.split()) for x in xs) >= min_words:
                    for a, b in line_alignment.common_blocks(lines[o], lines[d], words, min_words):
                        gone |= set(range(a, b))
        out[d] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


@pytest.mark.parametrize("spread", [512, 1])
def test_line_dedup(spark, monkeypatch, spread):
    monkeypatch.setattr(line_alignment, "SPREAD", spread)
    rng = random.Random(6)
    sentence = lambda n: " ".join(f"{rng.choice('abcdefg')}{rng.randrange(500)}" for _ in range(n))
    common = [sentence(4) for _ in range(5)]
    passages = ["\n".join(sentence(rng.randrange(3, 15)) for _ in range(4)) for _ in range(4)]
    rows = [(0, ""), (1, None), (2, "\n\n"), (3, "one"), (4, "one")]
    for d in range(5, 120):
        parts = [sentence(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))] + rng.sample(common, 2)
        if rng.random() < 0.6:
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        rows.append((d, "\n".join(parts)))
    rows += [(200 + k, rows[10][1]) for k in range(20)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, blocks string").repartition(3)
    for rare in (100, 2):
        got = {r["doc_id"]: r["clean_text"] for r in line_alignment.shared_blocks(docs, rare=rare).collect()}
        want = plain_clean(rows, rare=rare)
        assert got.pop(1) is None and want.pop(1) == ""
        assert got == want
    out = line_alignment.delete_shared(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


def plain_blocks(rows, min_words=20):
    """doc_id -> text without the runs of lines that any earlier document has: every pair of documents, every run."""
    out, before = {}, []
    for d, t in sorted(rows):
        raw = (t or "").split("\n")
        lines = [x.strip() for x in raw]
        gone = set()
        for other in before:
            for i in range(len(lines)):
                for j in range(len(other)):
                    k = 0
                    while i + k < len(lines) and j + k < len(other) and lines[i + k] == other[j + k]:
                        k += 1
                    if sum(len(x.split()) for x in lines[i:i + k]) >= min_words:
                        gone |= set(range(i, i + k))
        before.append(lines)
        out[d] = "\n".join(x for i, x in enumerate(raw) if i not in gone)
    return out


def cleaned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["clean_text"] for r in line_alignment.shared_blocks(docs).collect()}


def test_frequent_block_goes(spark):
    """Four short lines in 150 documents, half of which share a rarer line with a document that has nothing else."""
    header = "\n".join(" ".join(f"h{i}x{k}" for k in range(8)) for i in range(4))
    rows = [(d, f"rare {d}\nnothing else in {d}") for d in range(75)]
    rows += [(100 + d, f"{header}\nbody {d} of its own" + (f"\nrare {d // 2}" if d % 2 else "")) for d in range(150)]
    got = cleaned(spark, rows)
    assert header in got[100] and all("h0x0" not in got[100 + d] for d in range(1, 150)) and got == plain_blocks(rows)


def test_repeated_passage_goes(spark):
    """A passage that stands twice in the earlier document, or twice in the later one."""
    p, q = ("\n".join(" ".join(f"{c}{i}x{k}" for k in range(8)) for i in range(4)) for c in "pq")
    rows = [(1, f"x\n{p}\ny\n{p}\nz"), (2, f"b0\n{p}\nb1"), (3, q), (4, f"c0\n{q}\nc1\n{q}\nc2"), (5, f"{q}\nd\n{p}")]
    got = cleaned(spark, rows)
    assert got == {1: rows[0][1], 2: "b0\nb1", 3: q, 4: "c0\nc1\nc2", 5: "d"} == plain_blocks(rows)


def test_block_of_lines_seen_apart_goes(spark):
    """The lines of the block stand first in different documents, none of which has the block."""
    lines = [" ".join(f"l{i}x{k}" for k in range(8)) for i in range(3)]
    rows = [(i, f"start {i}\n{x}\nend {i}") for i, x in enumerate(lines)] + [(10, "b\n" + "\n".join(lines)), (11, "\n".join(lines) + "\nc")]
    got = cleaned(spark, rows)
    assert got[10] == rows[3][1] and got[11] == "c" and got == plain_blocks(rows)


def test_blocks_against_all_pairs(spark):
    rng = random.Random(7)
    lines = ["", " "] + [" ".join(f"{rng.choice('abc')}{rng.randrange(99)}" for _ in range(rng.choice((1, 3, 7, 12, 19, 20, 25)))) for _ in range(12)]
    for min_words in (1, 20):
        for _ in range(200):
            words = [rng.choice((0, 0, 1, 3, 9, 25)) for _ in range(rng.randrange(0, 12))]
            runs = line_alignment.short_runs(words, min_words)
            for a in range(len(words)):
                for b in range(a + 1, len(words) + 1):
                    inside = {k for x, y in runs if a <= x and y <= b for k in range(x, y)}
                    assert inside == (set(range(a, b)) if sum(words[a:b]) >= min_words else set())
    rows = [(d, "\n".join(rng.choice(lines) if rng.random() < 0.8 else f"own {d} {k}" for k in range(rng.randrange(0, 14)))) for d in range(120)]
    assert cleaned(spark, rows) == plain_blocks(rows)


def test_runs_are_aligned(spark, monkeypatch):
    """Every block comes from an alignment of two documents; equal hashes of runs alone take nothing."""
    a, b = list("xpqrypqrz"), list("0pqr1zxp")
    runs = [(1, 4, 1), (1, 4, 5), (5, 6, 8), (6, 8, 0), (0, 2, 0), (4, 7, 2)]  # the last two stand for equal hashes of other lines
    assert line_alignment.aligned_runs(a, b, runs) == [(1, 4), (1, 4), (5, 6), (6, 8)]
    labels, held = [], line_alignment.keep
    monkeypatch.setattr(line_alignment, "keep", lambda df, label: (labels.append(label), held(df, label))[1])
    monkeypatch.setattr(line_alignment, "SPREAD", 2)
    body = "\n".join(" ".join(f"l{i}x{k}" for k in range(9)) for i in range(6))
    rows = [(d, f"own {d}\n" * (d % 3) + body + f"\nend {d}") for d in range(9)]
    assert cleaned(spark, rows) == plain_blocks(rows) and {"run-pairs", "aligned-runs"} <= set(labels)


def test_line_table_by_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    assert {d: t or "" for d, t in cleaned(spark, rows).items()} == plain_blocks(rows)


def test_line_dedup_edges(spark):
    schema = "doc_id long, text string, lang string"
    long = "\n".join(f"line {i} of a long text" for i in range(3000))
    assert line_alignment.shared_blocks(spark.createDataFrame([], schema)).collect() == []
    docs = spark.createDataFrame([(None, long, None), (1, long, None), (1, long, None), (2, "start\n" + long + "\nend", None), (2, "b", None)], schema)
    got = sorted((r["doc_id"] or 0, r["text"] == r["clean_text"], r["clean_text"][:9]) for r in line_alignment.shared_blocks(docs).collect())
    assert got == [(0, True, "line 0 of"), (1, True, "line 0 of"), (1, True, "line 0 of"), (2, False, "start\nend"), (2, True, "b")]


def test_line_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_clean(rows)
    for r in QUERIES["op3_line_dedup"](spark, SF).collect():
        assert r["kept_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()


def test_line_dedup_with_clashing_names(spark):
    """Columns named like the operator's own keep their values."""
    body = " ".join(f"w{i}" for i in range(25))
    names = ["_id", "_whole", "_n", "_partners", "_blocks", "row", "id", "whole", "first", "found"]
    rows = [(1, body, *range(10)), (2, f"own line\n{body}", *range(10, 20)), (None, None, *range(20, 30))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = {r["_id"]: r for r in line_alignment.shared_blocks(frame).collect()}
    assert [out[0]["clean_text"], out[10]["clean_text"], out[20]["clean_text"]] == [body, "own line", None]
    assert [tuple(out[k][n] for n in names) for k in (0, 10, 20)] == [r[2:] for r in rows]
    cut = line_alignment.delete_shared(frame)
    assert cut.columns == frame.columns and sorted(r["text"] or "" for r in cut.collect()) == ["", "own line", body]
