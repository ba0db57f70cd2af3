"""The byte network: gradients, whole texts, and accuracy on rows it was not fitted on."""

import random
import zlib

import numpy as np
import pytest

from wakeline.llm import byte_net, queries


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def junk(rng, n):
    return " ".join(w + rng.choice(["###", "$$$", "***"]) for w in words(rng, n).split())


@pytest.fixture(scope="module")
def net():
    rng = random.Random(5)
    texts = [(junk if k % 2 else words)(rng, rng.randint(30, 200)).encode() for k in range(200)]
    return byte_net.fit(texts, np.arange(200) % 2 ^ 1, updates=60)


def batch_of(texts):
    return byte_net.read_blocks(list(byte_net.stretches(texts)))


def test_gradients():
    rng = random.Random(1)
    net = byte_net.fresh(3, width=2, n_filters=3)
    for a in net.arrays():
        a += np.random.default_rng(4).normal(0, 0.1, a.shape).astype(np.float32)
    texts = [words(rng, 200).encode(), b"", b"ab", words(rng, 20).encode() * 3]
    y = np.array([1, 0, 1, 0])
    batch = batch_of(texts)
    _, grads = byte_net.gradients(net, *batch, y)
    wide = byte_net.Net(*[a.astype(np.float64) for a in net.arrays()])
    for a, g in zip(wide.arrays(), grads):
        for at in [np.unravel_index(k, a.shape) for k in np.argsort(-np.abs(g), axis=None)[:6]]:
            old, step = a[at], 1e-5
            a[at] = old + step
            up, _ = byte_net.gradients(wide, *batch, y)
            a[at] = old - step
            down, _ = byte_net.gradients(wide, *batch, y)
            a[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-5)


def test_every_byte_counts(net):
    """Pooled values are those of a direct walk over all windows."""
    rng = random.Random(2)
    text = words(rng, 2000).encode()
    blocks, equal, chunks, owner = batch_of([text])
    pooled = byte_net._pooled(byte_net._responses(net, byte_net._inputs(net, blocks, equal)), chunks)
    padded = b"\0" * 24 + text + b"\0" * 64
    n = -(-len(text) // 4)
    direct = []
    for w in range(n):
        total = np.zeros(len(net.bias))
        for j in range(byte_net.SPAN):
            at = 24 + 4 * (w + j)
            x = np.concatenate([net.code[padded[at + i]] for i in range(4)]
                               + [[sum(padded[at + i] == padded[at + i - lag] != 0 for i in range(4)) for lag in byte_net.LAGS]])
            total += x @ net.filters[j]
        direct.append(total)
    direct = [np.max(direct[a:a + byte_net.CHUNK], axis=0) for a in range(0, n, byte_net.CHUNK)]
    assert np.allclose(pooled, direct, atol=1e-4)


def test_stretches_do_not_show(net, monkeypatch):
    rng = random.Random(3)
    texts = [words(rng, k).encode() for k in (0, 1, 3000, 700)] + [b"x" * 4096, b"", b"y" * 4097]
    whole = byte_net.scores(net, texts)
    monkeypatch.setattr(byte_net, "STRETCH", byte_net.BLOCK * byte_net.CHUNK * 2)
    assert np.allclose(byte_net.scores(net, texts, room=3000), whole, atol=1e-5)
    assert np.allclose([byte_net.scores(net, [t])[0] for t in texts], whole, atol=1e-5)


def test_junk_at_any_place_of_a_long_text(net):
    rng = random.Random(4)
    clean = words(rng, 20_000)
    for share in (0, 0.5, 1):
        cut = int(len(clean) * share)
        assert byte_net.scores(net, [(clean[:cut] + junk(rng, 20_000) + clean[cut:]).encode()])[0] < byte_net.scores(net, [clean.encode()])[0]


def test_one_kind_of_label():
    assert all((a == b).all() for a, b in zip(byte_net.fit([b"a"], np.array([1])).arrays(), byte_net.fresh().arrays()))
    assert byte_net.scores(byte_net.fresh(), []).tolist() == []


def test_rows(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, (junk if i % 2 else words)(rng, 60)) for i in range(120)]
    odd = [(None, "null id"), (200, None), (201, ""), (3, "again"), (3, "again"), (202, "é" * 9000)]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows + odd], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(120)] + [(None, 1), (5, None), (200, 1), (7, 2), (999, 1)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op13_quality_net"](spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows + odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[200] == pytest.approx(by[201], abs=1e-6)
    assert all((by[i] >= 0.5) == (i % 2 == 0) for i in range(120) if i != 3)
    # a label that is held out changes nothing
    held = next(i for i in range(120) if zlib.crc32(str(i).encode()) % 3 == 1)
    other = labels.filter(f"doc_id <> {held}").unionByName(spark.createDataFrame([(held, held % 2)], "doc_id long, quality int"))
    again = byte_net.quality_scores(docs.filter("doc_id <> 3"), other).collect()
    assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({i: p for i, p in by.items() if i not in (3, None)}, abs=1e-6)
    assert byte_net.quality_scores(docs.limit(0), labels).collect() == []
    assert byte_net.quality_scores(docs, labels.limit(0)).count() == len(rows + odd)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = queries.QUERIES["op13_quality_net"](spark, sf).filter("held_out").join(labels, "doc_id").collect()
    for quality in (0, 1):
        right = [r["predicted"] == quality for r in rows if r["quality"] == quality]
        assert len(right) > 10 and sum(right) / len(right) > 0.9
