"""The pipeline, stage by stage, against plain Python."""

import pytest

import corpus_pipeline
from tests.llm.test_near import plain_set, roots
from tests.llm.test_packing_mixing import plain_mix
from tests.llm.test_repeats import plain_clean
from tests.llm.test_text_scans import plain_facts
from wakeline.llm.store import keep

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer
    from wakeline.llm import packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    after = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF), name)
        assert docs.columns == columns
        after.append(docs.collect())
    # no line is frequent in so few documents: only the text rules reject
    texts = {d: t for d, t in texts.items() if not plain_facts(t)[-1]}
    assert {r["doc_id"]: r["text"] for r in after[0]} == texts
    texts = plain_clean(list(texts.items()))
    assert {r["doc_id"]: r["text"] for r in after[1]} == texts
    sets = {d: plain_set(t, 5) for d, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots(sets, links)
    texts = {d: t for d, t in texts.items() if root[d] == d}
    assert {r["doc_id"]: r["text"] for r in after[2]} == texts
    want = {d: taken for d, _, _, _, taken in plain_mix([(d, t, source[d]) for d, t in texts.items()])}
    got = dict.fromkeys(want, 0)
    for r in after[3]:
        got[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and r["text"].split() == texts[r["doc_id"]].split()[:len(r["text"].split())]
    assert got == want
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(p["length"] for p in pieces) == sum(len(whole.encode(r["text"], add_special_tokens=False).ids) + 1 for r in after[3])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.count() == len(pieces)


def test_empty(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
