"""Line dedup: a later document loses the blocks of lines it shares with an earlier one.

A block is a run of consecutive lines with enough words.  Every block is covered by its shortest runs with
enough words, at most two a line; each has a hash and an earliest holder.  A document is paired with the holders of
its runs only, so that a run that thousands carry makes one pair each, and the two are aligned by patience diff over
the stretch that their runs span; a run that the alignment leaves out (a passage that stands twice or in another
order) is an anchor of its own.  With ``rare`` set, documents are instead aligned in pairs
with the owners (earliest documents) of their lines, which misses blocks; see ``shared_blocks``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.store import keep, text


def _matches(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of the lines that stand once in either stretch, in the longest order common to both."""
    one, two = Counter(a[a0:a1]), Counter(b[b0:b1])
    where = {b[j]: j for j in range(b0, b1) if two[b[j]] == 1}
    pairs = [(i, where[a[i]]) for i in range(a0, a1) if one[a[i]] == 1 and a[i] in where]
    tails: list[int] = []  # least last place in b of a chain of each length
    chain: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(tails, j)
        back.append(chain[n - 1] if n else -1)
        if n == len(tails):
            tails.append(j)
            chain.append(k)
        else:
            tails[n], chain[n] = j, k
    out, k = [], chain[-1] if chain else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of two lists of lines, increasing in both."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _matches(a, b, a0, a1, b0, b1)
        for i, j in anchors:
            work.append((a0, i, b0, j))
            out.append((i, j))
            a0, b0 = i + 1, j + 1
        if anchors:
            work.append((a0, a1, b0, b1))
    return sorted(out)


def common_blocks(a: list, b: list, words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, end) of the blocks of b, aligned with neighbouring lines of a, of ``min_words`` words or more."""
    out: list[list[int]] = []
    before = None
    for i, j in patience(a, b):
        if before == (i - 1, j - 1):
            out[-1][1] = j + 1
        else:
            out.append([j, j + 1])
        before = (i, j)
    return [(x, y) for x, y in out if sum(words[x:y]) >= min_words]


def aligned_runs(a: list, b: list, runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(first, end) of the runs (first and end in b, first in a) that lie in one block of the alignment of a and b.

    A run outside of it (no line of it stands once, or it crosses an aligned one) is compared line by line at its two places.
    """
    blocks = common_blocks(a, b, [0] * len(b), 0)
    firsts = [x for x, _ in blocks]
    out = []
    for first, end, at in runs:
        k = bisect_right(firsts, first) - 1
        if (k >= 0 and end <= blocks[k][1]) or b[first:end] == a[at:at + end - first]:
            out.append((first, end))
    return out


def short_runs(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, end) of the shortest runs of lines with ``min_words`` words from each line on and up to each line.

    A longer run with that many words is the union of those inside it.
    """
    out, n, end, total = set(), len(words), 0, 0
    for first in range(n):
        while end < n and (total < min_words or end <= first):
            total += words[end]
            end += 1
        if total < min_words:
            break
        out.add((first, end))
        total -= words[first]
    first, total = n, 0
    for end in range(n, 0, -1):
        while first > 0 and (total < min_words or first >= end):
            first -= 1
            total += words[first]
        if total < min_words:
            break
        out.add((first, end))
        total -= words[end - 1]
    return sorted(out)


_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


def run_hashes(lines: list[int], runs: list[tuple[int, int]]) -> list[int]:
    """Polynomial hashes of runs of line hashes, from sums up to each line: long runs cost no more than short ones."""
    sums, powers = [0], [1]
    for x in lines:
        sums.append((sums[-1] * _BASE + x % _PRIME + 1) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    return [(sums[b] - sums[a] * powers[b - a]) % _PRIME for a, b in runs]


def _runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, totals, ends, places, found, lines = [], [], [0], [], [], []
        for t in batch.column(1).to_pylist():
            parts = t.split("\n")
            words = [len(p.split()) for p in parts]
            runs = short_runs(words, min_words)
            hashes = [xxhash.xxh3_64_intdigest(p.strip()) for p in parts] if runs else []
            if runs:
                found += run_hashes(hashes, runs)
                places += runs
            lines.append([x - (1 << 63) for x in hashes])
            n_lines.append(len(parts))
            totals.append(sum(words))
            ends.append(len(places))
        runs = pa.StructArray.from_arrays([pa.array(found, pa.int64()), pa.array([x for x, _ in places], pa.int32()), pa.array(
            [y for _, y in places], pa.int32())], names=["run", "first", "end"])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n_lines, pa.int32()), pa.array(totals, pa.int64()),
                                          pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs), pa.array(lines, pa.list_(pa.int64()))],
                                         names=["id", "whole", "n", "total", "runs", "lines"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching runs become one block."""
    for batch in batches:
        blocks = []
        for runs in batch.column(2).to_pylist():
            out: list[dict] = []
            for r in sorted(runs, key=lambda r: (r["first"], r["end"])):
                if out and r["first"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], r["end"])
                else:
                    out.append(r)
            blocks.append(out)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            blocks, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), batch.column(3)],
            names=["id", "whole", "found", "partners"])


def _align_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair: the runs that its alignment confirms, with places in the whole document."""
    for batch in batches:
        blocks = []
        for low, a_low, runs, b, a in zip(*[batch.column(k).to_pylist() for k in range(2, 7)]):
            found = aligned_runs(a, b, [(r["first"] - low, r["end"] - low, r["at"] - a_low) for r in runs])
            blocks.append([{"first": x + low, "end": y + low} for x, y in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            blocks, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))], names=["id", "whole", "blocks"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, words = [], []
        for t in batch.column(1).to_pylist():
            parts = t.split("\n")
            lines.append([xxhash.xxh3_64_intdigest(p.strip()) - (1 << 63) for p in parts])
            words.append([len(p.split()) for p in parts])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lines, pa.list_(pa.int64())),
                                          pa.array(words, pa.list_(pa.int32()))], names=["id", "whole", "lines", "words"])


def _align(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = [[{"first": x, "end": y} for x, y in common_blocks(a, b, w, min_words)]
                  for a, b, w in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            blocks, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))], names=["id", "whole", "blocks"])


def _digest(text_column: str):
    return F.md5(F.encode(text(text_column), "UTF-8"))


BLOCKS = "array<struct<first:int,end:int>>"
#: documents aligned with one copy of an owner
SPREAD = 512


def shared_blocks(docs: DataFrame, min_words: int = 20, rare: int | None = None, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """``docs`` with n_lines, partners (earlier documents that a block was found in), ``blocks`` (first, end: lines
    that go) and ``clean_text``.

    Lines are compared without white space around them.  A line goes if it is in a run of consecutive
    lines with ``min_words`` words or more that an earlier document also has, at any place and whatever
    the number of documents that have it.  A document with the text of an earlier one loses all its lines,
    if they make a block.  Null texts are empty, stay null and lose nothing; rows with a null id stay as
    they are; of rows with equal ids and different texts the order of the texts' digests counts; equal rows
    are both the first; result columns replace columns of the same name; an empty table gives no rows.

    A number for ``rare`` asks for patience alignments in place of runs, and these miss blocks: only with
    the owners of single lines, and only of pairs that share a line of at most ``rare`` documents, a line that
    makes a block alone, or the rarest shared line of the later one.  Partners are then the documents aligned
    with and blocks may overlap.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "partners", "blocks", "clean_text")]
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text(text_column).alias("text"), _digest(text_column)
                       .alias("whole")).filter("id is not null")
    fates = keep(_run_fates(rows, min_words) if rare is None else _aligned_fates(rows, min_words, rare), "line-fates")
    return _attach(docs.select(*names), fates, id_column, text_column)


def _with_first(lined: DataFrame) -> DataFrame:
    """With ``first``, the smallest id of the row's text."""
    firsts = keep(lined.groupBy("whole").agg(F.min("id").alias("first")), "first-texts").withColumnRenamed("whole", "f_whole")
    return keep(lined.join(firsts, F.col("whole") == F.col("f_whole")).drop("f_whole"), "lines-by-text")


def _fates(lined: DataFrame, found: DataFrame, n_lines: Column, total: Column, min_words: int) -> DataFrame:
    all_lines = F.array(F.struct(F.lit(0).alias("first"), n_lines.alias("end"))).cast(BLOCKS)
    return lined.dropDuplicates(["id", "whole"]).join(found, ["id", "whole"], "left").select(
        F.col("id").alias("_id"), F.col("whole").alias("_whole"), n_lines.alias("_n"),
        F.when(F.col("id") == F.col("first"), F.coalesce("partners", F.lit(0))).otherwise(1).alias("_partners"),
        F.when(F.col("id") == F.col("first"), F.col("found")).when(total >= min_words, all_lines).alias("_blocks"))


def _run_fates(rows: DataFrame, min_words: int) -> DataFrame:
    lined = _with_first(keep(rows.mapInArrow(
        lambda b: _runs(b, min_words), "id long, whole string, n int, total long, runs array<struct<run:long,first:int,end:int>>, lines array<long>"), "runs"))
    texts = lined.filter("id = first").dropDuplicates(["id", "whole"])
    listed = texts.select("id", "whole", F.explode("runs").alias("r")).select("id", "whole", "r.*")
    holders = keep(listed.groupBy("run").agg(F.count("*").alias("n"), F.min(F.struct("id", "whole", "first")).alias("holder"))
                   .filter("n > 1").select(F.col("run").alias("h_run"), F.struct("holder.id", "holder.whole").alias("owner"),
                                           F.col("holder.first").alias("at")), "run-holders")
    shared = listed.join(holders, F.col("run") == F.col("h_run"))
    shared = shared.filter((F.col("owner.id") != F.col("id")) | (F.col("owner.whole") != F.col("whole")))
    pairs = keep(shared.groupBy("id", "whole", "owner").agg(
        F.min("first").alias("low"), F.max("end").alias("high"), F.min("at").alias("a_low"), F.max(F.expr("at + end - first")).alias("a_high"),
        F.collect_list(F.struct("first", "end", "at")).alias("runs")), "run-pairs")
    # an owner of many pairs is copied, so that its alignments go to several tasks
    asked = keep(pairs.groupBy("owner").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("copies")), "pair-owners")
    slim = texts.select(F.col("id").alias("t_id"), F.col("whole").alias("t_whole"), "lines")
    stretch = lambda low, high: F.slice("lines", F.col(low) + 1, F.col(high) - F.col(low))
    mine = pairs.join(asked, "owner").withColumn("copy", F.pmod(F.xxhash64("id", "whole"), "copies").cast("int"))
    mine = mine.join(slim, (F.col("id") == F.col("t_id")) & (F.col("whole") == F.col("t_whole"))).withColumn("lines", stretch("low", "high"))
    theirs = asked.select(F.col("owner.id").alias("a_id"), F.col("owner.whole").alias("a_whole"),
                          F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("a_copy"))
    theirs = theirs.join(slim, (F.col("a_id") == F.col("t_id")) & (F.col("a_whole") == F.col("t_whole"))).select(
        "a_id", "a_whole", "a_copy", F.col("lines").alias("a_lines"))
    both = mine.join(theirs, (F.col("owner.id") == F.col("a_id")) & (F.col("owner.whole") == F.col("a_whole")) & (F.col("copy") == F.col("a_copy")))
    aligned = both.select("id", "whole", "low", "a_low", "runs", "lines", F.slice("a_lines", F.col("a_low") + 1, F.col("a_high") - F.col("a_low"))
                          .alias("a_lines")).mapInArrow(_align_runs, f"id long, whole string, blocks {BLOCKS}")
    found = keep(aligned.filter("size(blocks) > 0").groupBy("id", "whole").agg(
        F.flatten(F.collect_list("blocks")).alias("found"), F.count("*").alias("partners")), "aligned-runs")
    found = keep(found.mapInArrow(_merge, f"id long, whole string, found {BLOCKS}, partners long"), "line-blocks")
    return _fates(lined.drop("runs", "lines"), found, F.col("n"), F.col("total"), min_words)


def _aligned_fates(rows: DataFrame, min_words: int, rare: int) -> DataFrame:
    lined = _with_first(keep(rows.mapInArrow(_lines, "id long, whole string, lines array<long>, words array<int>"), "lines"))
    texts = lined.filter("id = first").dropDuplicates(["id", "whole"])
    listed = texts.select("id", "whole", F.explode(F.array_distinct(F.filter(F.arrays_zip("lines", "words"), lambda x: x["words"] > 0))).alias("l"))
    listed = listed.select("id", "whole", F.col("l.lines").alias("line"), F.col("l.words").alias("n"))
    owners = listed.groupBy("line").agg(F.count("*").alias("df"), F.min(F.struct("id", "whole")).alias("owner")).filter("df > 1")
    # an owner whose lines many documents carry is copied, so that its alignments go to several tasks
    copies = F.ceil(F.max("df").over(Window.partitionBy("owner")) / SPREAD).cast("int")
    owners = keep(owners.withColumn("copies", copies), "line-owners")
    shared = listed.join(owners.withColumnRenamed("line", "o_line"), F.col("line") == F.col("o_line"))
    shared = shared.filter((F.col("owner.id") != F.col("id")) | (F.col("owner.whole") != F.col("whole")))
    pairs = keep(shared.groupBy("id", "whole", "owner").agg(F.min("df").alias("df"), F.max("n").alias("n"),
                                                             F.max("copies").alias("copies")), "line-pairs")
    rarest = keep(pairs.groupBy("id", "whole").agg(F.min("df").alias("least")), "rarest-lines")
    pairs = pairs.join(rarest, ["id", "whole"]).filter((F.col("df") <= rare) | (F.col("n") >= min_words) | (F.col("df") == F.col("least")))
    slim = texts.select("id", "whole", "lines", "words")
    mine = pairs.select("id", "whole", "owner", F.pmod(F.xxhash64("id", "whole"), "copies").cast("int").alias("copy")).join(slim, ["id", "whole"])
    asked = owners.groupBy("owner").agg(F.max("copies").alias("copies")).select(
        F.col("owner.id").alias("a_id"), F.col("owner.whole").alias("a_whole"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("a_copy"))
    theirs = slim.select(F.col("id").alias("a_id"), F.col("whole").alias("a_whole"), F.col("lines").alias("a_lines")).join(asked, ["a_id", "a_whole"])
    both = mine.join(theirs, (F.col("owner.id") == F.col("a_id")) & (F.col("owner.whole") == F.col("a_whole")) & (F.col("copy") == F.col("a_copy")))
    aligned = both.select("id", "whole", "a_lines", "lines", "words").mapInArrow(
        lambda b: _align(b, min_words), f"id long, whole string, blocks {BLOCKS}")
    aligned = keep(aligned.groupBy("id", "whole").agg(F.flatten(F.collect_list("blocks")).alias("found"),
                                                      F.count("*").alias("partners")), "line-blocks")
    total = F.aggregate("words", F.lit(0), lambda n, w: n + w)
    return _fates(lined, aligned, F.size("lines"), total, min_words)


def _attach(docs: DataFrame, fates: DataFrame, id_column: str, text_column: str) -> DataFrame:
    # the given columns go as one, so that none can be taken for a column of the fates
    given = F.col("row")[text_column]
    body = F.coalesce(given, F.lit(""))
    joined = docs.select(F.struct(*docs.columns).alias("row")).join(
        fates, (F.col("row")[id_column].cast("long") == F.col("_id")) & (F.md5(F.encode(body, "UTF-8")) == F.col("_whole")), "left")
    gone = lambda i: F.exists("_blocks", lambda b: (b["first"] <= i) & (i < b["end"]))
    left = F.array_join(F.filter(F.split(body, "\n", -1), lambda x, i: ~gone(i)), "\n")
    return joined.select(
        "row", F.coalesce("_n", F.lit(0)).alias("n_lines"), F.coalesce("_partners", F.lit(0)).cast("long").alias("partners"),
        F.coalesce("_blocks", F.array().cast(BLOCKS)).alias("blocks"), F.when(F.size("_blocks") > 0, left).otherwise(given).alias("clean_text")
    ).select("row.*", "n_lines", "partners", "blocks", "clean_text")


def delete_shared(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` with the shared blocks cut out of the text; columns as before."""
    out = shared_blocks(docs, text_column=text_column, **options)
    return out.withColumn(text_column, F.col("clean_text")).select(docs.columns)
