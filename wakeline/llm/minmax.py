"""Near-duplicate texts: min-max hashing of word shingles, exact check on full sets, components.

Each permutation gives two values, the least and the greatest hash of the set; both agree between
two sets with the chance of their similarity.  Groups of values are bucket keys.  Texts with equal
sets are one class, and only classes are compared: first each with the smallest of its family (the
texts that buckets join), then, where that leaves a family in parts, the parts with one another in
pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import hashes
from wakeline.llm.store import components, keep, text

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text of lower-cased bytes."""
    factor = hashes.mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for a, b in hashes.chunks(texts):
        raw = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", np.uint8)
        starts, ends = hashes.word_ends(raw, _WORD)
        word = hashes.span(hashes.sums(raw), starts, ends) if len(starts) else np.zeros(0, np.uint64)
        whole = np.zeros(max(0, len(word) - width + 1), np.uint64)
        for k in range(width):
            whole += word[k:k + len(whole)] * factor[k]
        whole = hashes.mixed(whole)
        at = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts[a:b]])).tolist()
        for x, y in zip(at, at[1:]):
            if y - x >= width:
                yield np.unique(whole[x:y - width + 1])
            elif y > x:  # the whole sequence as one shingle
                yield hashes.mixed((word[x:y] * factor[:y - x]).sum(dtype=np.uint64, keepdims=True) + np.uint64(y - x))
            else:
                yield np.zeros(0, np.uint64)


def min_max(sets: list[np.ndarray], permutations: int, seed: int) -> np.ndarray:
    """(sets, 2 * permutations) least and greatest value of each non-empty set."""
    rng = np.random.Generator(np.random.PCG64(seed))
    scale = rng.integers(0, 1 << 62, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
    flat, at = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets])[:-1]
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    for k in range(permutations):
        value = flat * scale[k] + shift[k]
        value ^= value >> np.uint64(31)  # the upper bits decide the order; the lower ones take part
        value *= np.uint64(0x9E3779B97F4A7C15)
        out[:, 2 * k] = np.minimum.reduceat(value, at)
        out[:, 2 * k + 1] = np.maximum.reduceat(value, at)
    return out


def _sign(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int, seed: int) -> Iterator[pa.RecordBatch]:
    mix = hashes.mixed(np.arange(1, rows + 1, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
    for batch in batches:
        texts = [(t or "").encode().translate(_LOWER) for t in batch.column(1).to_pylist()]
        for first in range(0, len(texts), 500):
            part = texts[first:first + 500]
            sets = list(shingle_sets(part, width))
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                values = min_max([sets[i] for i in full], bands * rows // 2, seed).reshape(len(full), bands, rows)
                banded = hashes.mixed((values * mix).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).astype(np.int64)
                for i, row in zip(full, banded):
                    keys[i] = row
            digest = [[int(s.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(hashes.mixed(s)).astype(np.int64))]
                      if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, len(part)), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digest, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n", "digest", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode().translate(_LOWER) for t in batch.column(1).to_pylist()]
        for first in range(0, len(texts), 500):
            part = texts[first:first + 500]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array(
                [s.tobytes() for s in shingle_sets(part, width)], pa.binary())], names=["id", "members"])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Of two sorted sets: 100 * shared >= percent * joint."""
    low, high = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(low) < percent * len(high):
        return False
    at = np.minimum(np.searchsorted(high, low), len(high) - 1)
    shared = int((high[at] == low).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _check_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ok = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(left, right)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])


def block_links(sets: list[np.ndarray], side: np.ndarray, part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links, as places, that connect what all links between two blocks (sides 1 and 2) or within
    one (side 0) do; pairs of one part are connected already."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, column, spread = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared_only = spread[column] > 1
    column, owner = column[shared_only], owner[shared_only]
    used, column = np.unique(column, return_inverse=True)
    shared = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2 ** 24 are exact
    for first in range(0, len(used), 4096):
        here = (column >= first) & (column < first + 4096)
        m = np.zeros((len(sets), min(4096, len(used) - first)), np.float32)
        m[owner[here], column[here] - first] = 1
        shared += m @ m.T
    joint = sizes[:, None] + sizes[None, :] - shared
    near = 100.0 * shared.astype(np.float64) >= percent * joint.astype(np.float64)
    near &= part[:, None] != part[None, :]
    if (side > 0).any():
        near &= side[:, None] != side[None, :]
    root = list(range(len(sets)))
    out = []
    for a, b in np.argwhere(np.triu(near, 1)).tolist():
        x, y = a, b
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _check_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    def solve(rows: list[dict]) -> pa.RecordBatch:
        links = block_links([np.frombuffer(r["members"], np.uint64) for r in rows], np.array([r["side"] for r in rows]),
                            np.array([r["part"] for r in rows]), percent)
        return pa.RecordBatch.from_arrays([pa.array([rows[a]["id"] for a, _ in links], pa.int64()),
                                           pa.array([rows[b]["id"] for _, b in links], pa.int64())], names=["a", "b"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["cell"] != row["cell"]:
                yield solve(held)
                held = []
            held.append(row)
    if held:
        yield solve(held)


def near_texts(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, block: int = 128,
               stars: int = 2, seed: int = 11, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links, itself
    included) and kept.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct shingles of ``width``
    words, or the whole sequence if it is shorter.  Two texts are linked if
    100 * shared >= percent * joint shingles, checked on full sets.  With 32 groups of 4 values a pair at
    0.8 is not compared with a chance of 5 in 100 million, at 0.85 of 6 in 100 billion.  Null and blank texts have
    no shingles and no links; a null id gets no links; equal ids share one component; other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), text(text_column).alias("text"))
    signed = keep(source.mapInArrow(lambda b: _sign(b, width, bands, rows, seed),
                                    "doc_id long, n long, digest array<long>, bands array<long>"), "set-signs")
    full = signed.filter("n > 0 and doc_id is not null")
    classes = keep(full.groupBy("digest", "n").agg(F.min("doc_id").alias("class"), F.first("bands").alias("bands")), "set-classes")
    member = full.select("doc_id", "digest", "n").join(classes.select(
        F.col("digest").alias("c_digest"), F.col("n").alias("c_n"), "class"), F.expr("digest = c_digest and n = c_n"))
    member = keep(member.select("doc_id", "class").distinct(), "set-members")

    # families: classes that buckets join, each with the smallest of its bucket
    cells = classes.select("class", F.explode("bands").alias("key"))
    heads = keep(cells.groupBy("key").agg(F.min("class").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n"), "set-buckets")
    families = keep(components(spark, cells.join(heads, "key").filter("class <> head")
                               .select(F.col("class").alias("a"), F.col("head").alias("b")).distinct()), "set-families")

    wanted = families.select(F.col("node").alias("w_id"))
    sets = source.join(wanted, F.col("doc_id") == F.col("w_id"))
    sets = keep(sets.select("doc_id", "text").mapInArrow(lambda b: _sets(b, width), "id long, members binary"), "sets")

    links, parts = None, families.select(F.col("node").alias("id"), F.col("component").alias("family"), F.col("node").alias("part"))
    for _ in range(stars):
        # each part but the family's first is tried against the first part's head, by all its members
        heads = keep(parts.groupBy("family").agg(F.min("part").alias("head")) if links is None else
                     parts.filter("part <> family").groupBy("family").agg(F.min("part").alias("head")), "family-heads")
        tries = parts.join(heads, "family").filter("part <> head").select("id", "head", "family")
        tries = keep(tries, "tries")
        if tries.isEmpty():
            break
        own = tries.join(sets, "id").select("id", "head", "members")
        both = own.join(sets.select(F.col("id").alias("h_id"), F.col("members").alias("h_members")), F.col("head") == F.col("h_id"))
        new = keep(both.select(F.col("id").alias("a"), F.col("head").alias("b"), "members", "h_members")
                   .mapInArrow(lambda b: _check_pairs(b, percent), "a long, b long"), "star-links")
        links = new if links is None else links.unionByName(new)
        parts = _parts(spark, families, links)
        if parts.filter("part <> family").isEmpty():
            break
    open_ = keep(parts.groupBy("family", "part").agg(F.count("*").alias("size")), "family-parts")
    several = keep(open_.groupBy("family").agg(F.count("*").alias("parts"), F.sum("size").alias("members"),
                                               F.sum(F.when(F.col("size") < block, F.col("size")).otherwise(0)).alias("small"))
                   .filter("parts > 1"), "open-families")
    if not several.isEmpty():
        links = links.unionByName(_block_pairs(spark, parts, open_, several, sets, block, percent, seed))
        parts = _parts(spark, families, links)
    found = keep(parts.select(F.col("id").alias("p_class"), "part"), "set-parts")
    found = keep(member.join(found, F.col("class") == F.col("p_class"), "left").groupBy(F.col("doc_id").alias("m_id")).agg(
        F.min(F.coalesce("part", "class")).alias("component_id")), "set-results")
    out = signed.select("doc_id", "n").join(found, F.col("doc_id") == F.col("m_id"), "left")
    return out.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))


def _parts(spark, families: DataFrame, links: DataFrame) -> DataFrame:
    """(id, family, part): what the links have connected within each family so far."""
    roots = keep(components(spark, links), "roots").withColumnRenamed("node", "r_id")
    out = families.join(roots.withColumnRenamed("component", "root"), F.col("node") == F.col("r_id"), "left")
    return keep(out.select(F.col("node").alias("id"), F.col("component").alias("family"), F.coalesce("root", "node").alias("part")), "parts")


def _block_pairs(spark, parts: DataFrame, open_: DataFrame, several: DataFrame, sets: DataFrame, block: int,
                 percent: int, seed: int) -> DataFrame:
    """Links between the parts of families.  A large part has blocks of its own, small ones share
    blocks; blocks of one large part are not paired with each other."""
    sized = open_.join(several, "family").select(F.col("family").alias("f"), F.col("part").alias("p"), "size", "small")
    rows = parts.join(sized, (F.col("family") == F.col("f")) & (F.col("part") == F.col("p")))
    large = F.col("size") >= block
    rows = rows.withColumn("group", F.when(large, F.col("part")).otherwise(F.lit(-1)))
    rows = rows.withColumn("number", F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(
        F.when(large, F.col("size")).otherwise(F.col("small")) / block)).cast("int"))
    rows = keep(rows.select("id", "family", "part", "group", "number"), "blocks")
    blocks = keep(rows.select("family", "group", "number").distinct(), "block-list")
    one, two = (blocks.select("family", *[F.col(c).alias(f"{c}{k}") for c in ("group", "number")]) for k in (1, 2))
    # the pairs of blocks of a family: its members over the block size, squared
    pairs = one.join(two, "family").filter(
        "(group1 < group2 or (group1 = group2 and number1 <= number2)) and (group1 <> group2 or group1 = -1)")
    pairs = pairs.withColumn("cell", F.xxhash64("family", "group1", "number1", "group2", "number2"))
    alone = (F.col("group1") == F.col("group2")) & (F.col("number1") == F.col("number2"))
    sides = pairs.select("family", "cell", F.explode(F.when(alone, F.array(F.struct(
        F.col("group1").alias("group"), F.col("number1").alias("number"), F.lit(0).alias("side")))).otherwise(F.array(
            F.struct(F.col("group1").alias("group"), F.col("number1").alias("number"), F.lit(1).alias("side")),
            F.struct(F.col("group2").alias("group"), F.col("number2").alias("number"), F.lit(2).alias("side"))))).alias("s"))
    sides = keep(sides.select("family", "cell", "s.*"), "block-pairs")
    placed = rows.join(sides, ["family", "group", "number"]).select("id", "part", "cell", "side").join(sets, "id")
    return keep(placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        lambda b: _check_blocks(b, percent), "a long, b long"), "block-links")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents that ``near_texts`` keeps: one of each group, columns as in ``docs``.  Of rows
    with equal ids all or none stay; rows with a null id stay."""
    gone = near_texts(docs, id_column=id_column, **options).filter("not kept").select(F.col(id_column).alias("_gone")).distinct()
    return docs.join(gone, F.col(id_column) == F.col("_gone"), "left_anti")
