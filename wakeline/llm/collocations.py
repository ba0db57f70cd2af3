"""Phrase collocations: frequent phrases of neighbouring words, counted in tiles, level by level.

The texts are coded once, in chunks of bounded size.  A chunk never sees the whole vocabulary: its
distinct words, and later its distinct phrases, are merged with those of the other chunks, and what comes back
are the numbers of the frequent ones it holds.  Numbers rank by frequency, so frequent pairs fall into few
tiles of the square of numbers; tiles with many pairs are counted by one ``bincount`` over their own addresses, the
others as sorted coordinates.  Counted words and pairs travel sorted, one packed message for each chunk and bucket.
Frequent pairs get ranks of their own and are the phrases of the next level; a phrase of k + 1 words is the pair of
the phrases of k words at its first and second word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.hashes import mixed, span, sums
from wakeline.llm.store import keep
from wakeline.llm.words import parts, split

SPACES = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Bytes of text in a chunk, and places in a chunk of one longer text.
CHUNK_BYTES = 1 << 23
CHUNK_PLACES = 1 << 21
#: Width of a tile, and the pairs that make a tile dense.
TILE = 256
DENSE = TILE * TILE // 4
#: Words of the corpus for each bucket of pairs, which has at most as many counted pairs on average, and bytes of
#: text for each bucket of words.
BUCKET_WORDS = 1 << 21
BUCKET_BYTES = 1 << 26

_CODED = ("chunk long, own int, places binary, numbers binary, messages array<struct<bucket:int,start:int,sizes:binary,words:binary,counts:binary>>, "
          "names array<string>, totals array<long>")
_PAIRS = "chunk long, own int, places binary, messages array<struct<bucket:int,start:int,left:binary,right:binary,counts:binary>>"
_FOUND = "held_in long, locals binary, ids binary"


def _message(*fields: str) -> pa.DataType:
    return pa.list_(pa.struct([("bucket", pa.int32()), ("start", pa.int32()), *((f, pa.binary()) for f in fields)]))


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes as the largest needs, bytes of the same weight side by side, compressed."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    raw = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def _unpacked(cell: bytes) -> np.ndarray:
    n, width = int.from_bytes(cell[:8], "little"), cell[8]
    raw = np.frombuffer(pa.decompress(cell[9:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").ravel().astype(np.int64)


def _ascending(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=0))


def _summed(cell: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(cell))


def _runs(bucket: np.ndarray) -> list[tuple[int, int]]:
    starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    return list(zip(starts, starts[1:] + [len(bucket)]))


def _row(values: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([v], t) for k, (v, t) in values.items()})


_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())


# --- level one: words ---------------------------------------------------------------------------

def _coded(rows: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Codes of all words with -1 between pieces, and the language and word of each code."""
    langs = pc.fill_null(rows.column("lang").cast(pa.large_string()), "und").dictionary_encode()
    found = split(rows.column("text"), SPACES, BREAKS, lower=True)
    coded = found.words.dictionary_encode()
    doc = np.repeat(np.arange(rows.num_rows), np.diff(found.first))
    n = max(len(coded.dictionary), 1)
    pairs, codes = np.unique(langs.indices.to_numpy()[doc].astype(np.int64) * n + coded.indices.to_numpy(), return_inverse=True)
    cut = np.zeros(len(codes), np.int64)
    cut[1:] = (np.diff(doc) != 0) | (np.diff(found.piece) != 0)
    out = np.full(len(codes) + int(cut.sum()), -1, np.int32)
    out[np.arange(len(codes)) + np.cumsum(cut)] = codes
    return out, langs.dictionary.take(pa.array(pairs // n)), coded.dictionary.take(pa.array(pairs % n))


def _chunk_rows(codes: np.ndarray, langs: pa.Array, words: pa.Array, longest: int) -> Iterator[tuple]:
    """(own, codes, langs, words, counts) of stretches that own all their places but the last ones,
    which only continue phrases that begin before them."""
    for a in range(0, len(codes), CHUNK_PLACES):
        here = codes[a:a + CHUNK_PLACES + longest - 1]
        own = min(CHUNK_PLACES, len(here))
        held, local = np.unique(here, return_inverse=True)
        if len(held) and held[0] < 0:
            held, local = held[1:], local - 1
        mine = local[:own]
        counts = np.bincount(mine[mine >= 0], minlength=len(held))
        at = pa.array(held)
        yield own, local.astype(np.int32), langs.take(at), words.take(at), counts


def _word_messages(langs: pa.Array, words: pa.Array, counts: np.ndarray, buckets: int) -> tuple[np.ndarray, list[dict]]:
    """The words by bucket and in byte order, as places in the given arrays and as messages."""
    # a word holds no line end, so the last one ends the language
    keys = pc.binary_join_element_wise(langs, words, pa.scalar("\n", pa.large_string())).cast(pa.large_binary())
    if not len(keys):
        return np.zeros(0, np.int64), []
    keys = pa.concat_arrays([keys])
    ends = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset:keys.offset + len(keys) + 1]
    raw = np.frombuffer(keys.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    bucket = (span(sums(raw), ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)
    order = pc.sort_indices(keys).to_numpy().astype(np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    keys, counts, sizes = keys.take(pa.array(order)), counts[order], np.diff(ends)[order]
    out = []
    for x, y in _runs(bucket[order]):
        data = b"".join(keys.slice(x, y - x).to_pylist())
        out.append({"bucket": int(bucket[order[x]]), "start": x, "sizes": _packed(sizes[x:y]),
                    "words": _packed(np.frombuffer(data, np.uint8)), "counts": _packed(counts[x:y])})
    return order, out


def _chunks(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def done(gathered: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = pa.Table.from_batches(gathered).combine_chunks().to_batches()
            for one in rows:
                for own, codes, langs, words, counts in _chunk_rows(*_coded(one), longest):
                    totals = pa.table({"lang": langs, "n": counts}).group_by("lang").aggregate([("n", "sum")])
                    order, messages = _word_messages(langs, words, counts, buckets)
                    # frequent words get small numbers, which pack better
                    by_count = np.zeros(len(counts) + 1, np.int64)
                    by_count[np.argsort(-counts, kind="stable")] = np.arange(1, len(counts) + 1)
                    yield _row({"chunk": (number, pa.int64()), "own": (own, pa.int32()), "places": (_packed(by_count[codes]), pa.binary()),
                                "numbers": (_packed(by_count[order] - 1), pa.binary()),
                                "messages": (messages, _message("sizes", "words", "counts")),
                                "names": (totals["lang"].to_pylist(), _STRINGS), "totals": (totals["n_sum"].to_pylist(), _LONGS)})
                    number += 1

        gathered, held = [], 0
        for batch in batches:
            for rows in parts(batch, limit=CHUNK_BYTES):
                size = pc.sum(pc.binary_length(rows.column("text"))).as_py() or 0
                if gathered and held + size > CHUNK_BYTES:
                    yield from done(gathered)
                    gathered, held = [], 0
                gathered.append(rows)
                held += size
        if gathered:
            yield from done(gathered)

    return docs.select("lang", "text").mapInArrow(work, _CODED)


# --- counting pairs -----------------------------------------------------------------------------

def count_pairs(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) of the different pairs and the place of each given pair among them."""
    width = TILE
    while max(n_left, n_right) > width * 1024:  # keeps the list of tiles short
        width *= 2
    across = -(-n_right // width) or 1
    tile = left // width * across + right // width
    full = np.bincount(tile, minlength=1) >= DENSE
    slots = np.cumsum(full) - 1
    dense = full[tile]
    # dense tiles: one address per cell, tile behind tile
    cell = (left % width) * width + right % width
    address = slots[tile[dense]] * (width * width) + cell[dense]
    hits = np.bincount(address, minlength=1)
    taken = np.flatnonzero(hits)
    rank = np.cumsum(hits > 0) - 1
    home = np.flatnonzero(full)[taken // (width * width)] if len(taken) else taken
    inner = taken % (width * width)
    # the others: sorted coordinates
    keys, where, times = np.unique(left[~dense] * n_right + right[~dense], return_inverse=True, return_counts=True)
    place = np.empty(len(left), np.int64)
    place[dense] = rank[address]
    place[~dense] = where + len(taken)
    return (np.concatenate((home // across * width + inner // width, keys // max(n_right, 1))),
            np.concatenate((home % across * width + inner % width, keys % max(n_right, 1))),
            np.concatenate((hits[taken], times)), place)


def _counted(chunk: int, own: int, heads: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Pairs of frequent phrases that begin at neighbouring words.

    Places from ``own`` on belong to the next chunk: their pairs are listed but not counted.
    """
    # of the places that hold nothing, one behind each phrase keeps it from its next
    near = heads >= 0
    near[1:] |= heads[:-1] >= 0
    own = int(near[:own].sum())
    heads = heads[near]
    at = np.flatnonzero((heads[:-1] >= 0) & (heads[1:] >= 0))
    left, right, _, place = count_pairs(heads[at], heads[at + 1], len(ids), len(ids))
    counts = np.bincount(place[at < own], minlength=len(left))
    left, right = ids[left], ids[right]
    bucket = (mixed(mixed(left.astype(np.uint64)) + right.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    # pairs are numbered in the order in which they are sent, so that a message says where its first one stands and no more
    order = np.lexsort((right, left, bucket))
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.arange(1, len(order) + 1)
    places = np.zeros(len(heads), np.int64)
    places[at] = numbers[place]
    left, right, counts, bucket = left[order], right[order], counts[order], bucket[order]
    messages = [{"bucket": int(bucket[x]), "start": x, "left": _ascending(left[x:y]), "right": _packed(right[x:y]), "counts": _packed(counts[x:y])}
                for x, y in _runs(bucket)]
    return _row({"chunk": (chunk, pa.int64()), "own": (own, pa.int32()), "places": (_packed(places), pa.binary()),
                 "messages": (messages, _message("left", "right", "counts"))})


def _given_words(rows: pa.Table) -> tuple[list[int], np.ndarray, pa.Array, pa.Array]:
    """Size of each message, number of each of its words among all in byte order, and these: languages and words."""
    sizes = [_unpacked(x) for x in rows["sizes"].to_pylist()]
    data = b"".join(_unpacked(x).astype(np.uint8).tobytes() for x in rows["words"].to_pylist())
    ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    both = [k.decode().rpartition("\n") for k in coded.dictionary.take(pa.array(order)).to_pylist()]
    return [len(x) for x in sizes], number[coded.indices.to_numpy()], pa.array([x for x, _, _ in both]), pa.array([y for _, _, y in both])


def _given_pairs(rows: pa.Table) -> tuple[list[int], np.ndarray, pa.Array, pa.Array]:
    """Size of each message, number of each of its pairs among all sorted, and these: left and right."""
    lefts = [_summed(x) for x in rows["left"].to_pylist()]
    left, right = np.concatenate(lefts), np.concatenate([_unpacked(x) for x in rows["right"].to_pylist()])
    order = np.lexsort((right, left))
    new = (np.diff(left[order], prepend=-1) != 0) | (np.diff(right[order], prepend=-1) != 0)
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    return [len(x) for x in lefts], where, pa.array(left[order[new]]), pa.array(right[order[new]])


def _merged(messages: DataFrame, least: int, given, kind: str) -> DataFrame:
    """Sums of each bucket's items: one row of the frequent ones (chunk null), and one for each chunk of which of its items these are."""
    items = pa.list_(pa.string() if kind == "string" else pa.int64())
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("left", items), ("right", items), ("counts", _LONGS),
                        ("locals", pa.binary()), ("hits", pa.binary())])

    def work(rows: pa.Table) -> pa.Table:
        sizes, where, left, right = given(rows)
        total = np.zeros(len(left), np.int64)
        np.add.at(total, where, np.concatenate([_unpacked(x) for x in rows["counts"].to_pylist()]))
        frequent = total >= least
        number = np.cumsum(frequent) - 1
        bucket, end = rows["bucket"][0].as_py(), 0
        kept = pa.array(frequent)
        out = [(bucket, None, left.filter(kept).to_pylist(), right.filter(kept).to_pylist(), total[frequent], None, None)]
        for chunk, start, n in zip(rows["chunk"].to_pylist(), rows["start"].to_pylist(), sizes):
            here = where[end:end + n]
            end += n
            hit = np.flatnonzero(frequent[here])
            if len(hit):
                out.append((bucket, chunk, None, None, None, _ascending(start + hit), _ascending(number[here[hit]])))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return messages.groupBy("bucket").applyInArrow(
        work, f"bucket int, chunk long, left array<{kind}>, right array<{kind}>, counts array<long>, locals binary, hits binary")


def _replies(hits: pa.Table, ranks: pa.Table) -> pa.Table:
    """Ranks of the frequent items of a bucket, for each chunk that holds some."""
    ids = np.zeros(ranks.num_rows, np.int64)
    ids[ranks["hit"].to_numpy()] = ranks["id"].to_numpy()
    given = [_packed(ids[_summed(x)]) for x in hits["hits"].to_pylist()]
    return pa.table({"held_in": hits["chunk"], "locals": hits["locals"], "ids": pa.array(given, pa.binary())})


def _renumbered(places: np.ndarray, local: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places as numbers of the frequent items held here, in order of rank (-1: not frequent), and their ids."""
    by_rank = np.argsort(ids)
    # the last entry is for places that hold nothing
    table = np.full(max(int(places.max(initial=-1)), int(local.max(initial=-1))) + 2, -1, np.int64)
    table[local[by_rank]] = np.arange(len(ids))
    return table[places], ids[by_rank]


def _next_level(chunks: DataFrame, found: DataFrame, buckets: int) -> DataFrame:
    """Count the pairs of frequent items in chunks, given which of their items are frequent."""
    def work(held: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        if held.num_rows and found.num_rows:
            row = {c: held[c][0].as_py() for c in held.column_names}
            local = np.concatenate([_summed(x) for x in found["locals"].to_pylist()])
            if "numbers" in row:
                local = _unpacked(row["numbers"])[local]
            ids = np.concatenate([_unpacked(x) for x in found["ids"].to_pylist()])
            out.append(_counted(row["chunk"], row["own"], *_renumbered(_unpacked(row["places"]) - 1, local, ids), buckets))
        empty = pa.schema([("chunk", pa.int64()), ("own", pa.int32()), ("places", pa.binary()), ("messages", _message("left", "right", "counts"))])
        return pa.Table.from_batches(out, empty)

    columns = [c for c in ("chunk", "own", "places", "numbers") if c in chunks.columns]
    return chunks.select(*columns).groupBy("chunk").cogroup(found.groupBy("held_in")).applyInArrow(work, _PAIRS)


def ranked(items: DataFrame, *order) -> DataFrame:
    """``items`` with ``id``, their places from 0 in the order given, which must tell all of them apart: a
    range sort, and one number per partition for what lies before it."""
    rows = keep(items.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    before = rows.groupBy(part.alias("_part")).count().select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return rows.withColumn("_part", part).join(before, "_part").withColumn(
        "id", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_before")


# --- phrases and scores -------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of one to ``longest`` words that occur ``least`` times in a language,
    and (lang, n) with the words of each language."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = keep(_chunks(docs, longest, size // BUCKET_BYTES + 1), "coded")
    n = chunks.select(F.inline(F.arrays_zip("names", "totals"))).groupBy(F.col("names").alias("lang")).agg(F.sum("totals").alias("n"))
    buckets = (n.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS + 1
    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        messages = chunks.select("chunk", F.inline("messages"))
        merged = keep(_merged(messages, least, *((_given_words, "string") if k == 1 else (_given_pairs, "long"))), f"merged-{k}")
        counted = merged.filter("chunk is null").select("bucket", F.posexplode(F.arrays_zip("left", "right", "counts")).alias("hit", "c")).select(
            "bucket", "hit", "c.left", "c.right", F.col("c.counts").alias("f"))
        items = keep(ranked(counted, F.desc("f"), "left", "right"), f"frequent-{k}")
        if k == 1:
            level = items.select("id", F.col("left").alias("lang"), F.col("right").alias("phrase"), "f")
        else:
            heads = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"))
            words = levels[-1].select(F.col("id").alias("right"), F.substring_index("phrase", " ", -1).alias("word"))
            level = keep(items.join(heads, "left").join(words, "right").select("id", "lang", F.concat_ws(" ", "head", "word").alias("phrase"), "f"),
                         f"phrases-{k}")
        levels.append(level)
        if k < longest:
            found = merged.filter("chunk is not null").select("bucket", "chunk", "locals", "hits").groupBy("bucket").cogroup(
                items.select("bucket", "hit", "id").groupBy("bucket")).applyInArrow(_replies, _FOUND)
            chunks = keep(_next_level(chunks, found, buckets), f"pairs-{k + 1}")
    phrases = None
    for k, level in enumerate(levels, 1):
        level = level.select("lang", "phrase", F.lit(k).alias("k"), "f")
        phrases = level if phrases is None else phrases.unionByName(level)
    return phrases, n


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these into words at
    spaces and tabs.  A phrase of 2 to ``longest`` words that occurs a >= ``least`` times in the pieces of its
    language (null: ``und``) scores floor(1000 a n / (l r)), where n counts the language's words and l
    and r the occurrences of its two parts, at the cut with the lowest score (ties: the first).  A phrase is
    left out if a phrase with one word more that holds it occurs at least ``share`` per cent as often; a
    longer holder has such a one between.  Order: score, a (both descending), phrase in byte order.

    Null and empty texts have no words; equal rows all count; an empty table gives no rows; further
    columns are not read, whatever their names.  Nothing whole goes through one task: a chunk is 8 MB
    of text, or 2 ** 21 words of a longer one, and all counts are merged by (language, word) or pair.
    """
    phrases, n = frequent_phrases(docs, least, longest)
    words = F.split("phrase", " ")
    candidates = phrases.filter("k > 1")
    joined = lambda w: F.concat_ws(" ", w)
    cuts = candidates.withColumn("w", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut", joined(F.expr("slice(w, 1, cut)")).alias("head"),
        joined(F.expr("slice(w, cut + 1, k)")).alias("tail"))
    side = lambda part, count: phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
    whole = "CAST({} AS decimal(20,0))"
    # exact beyond 64 bits: decimal products, integral division
    score = f"(1000 * {whole.format('a')} * {whole.format('n')}) div ({whole.format('l')} * {whole.format('r')})"
    scored = (cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(n, "lang")
              .select("lang", "phrase", "a", "n", F.struct(F.expr(score).alias("score"), "cut", "l", "r").alias("c"))
              .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("c").alias("c")))
    holders = candidates.filter("k > 2").withColumn("w", words).select("lang", "f", F.explode(F.array(
        joined(F.expr("slice(w, 1, k - 1)")), joined(F.expr("slice(w, 2, k - 1)")))).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("f").alias("around"))
    left = scored.join(holders, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("around") < share * F.col("a"), F.lit(True)))
    best = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    return left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score")
