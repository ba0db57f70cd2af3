"""Mixing sources to target weights by weighted fair queueing, from built-in functions.

The documents of a source queue in a fixed shuffled order, again and again.  A copy finishes at the
virtual time (words of its source up to its end) / (target words of its source).  At time 1 every
source has given its target and all of them the budget; sorting by finish time interleaves them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.quality import words
from wakeline.llm.store import keep, text

#: First hexadecimal digits of the shuffle key that name a stretch of a source's queue; a stretch is
#: the unit that one task orders, and a source has 16 ** STRETCH of them.
STRETCH = 3


def prefix(rows: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """``rows`` with, for every name in ``sums``, the total of its column over all rows before, in an order that
    tells all rows apart: a range sort, running totals inside each range and one row per range for what lies before it."""
    ranged = keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {**{f"_of_{name}": column for name, column in sums.items()}, "_at": F.monotonically_increasing_id()}), label)
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    ranges = ranged.groupBy("_range").agg(*[F.sum(f"_of_{name}").alias(f"_all_{name}") for name in sums])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    starts = ranges.select("_range", *[F.coalesce(F.sum(f"_all_{name}").over(earlier), none).alias(f"_all_{name}") for name in sums])
    return ranged.join(starts, "_range").select(*rows.columns, *[
        (F.col(f"_all_{name}") + F.coalesce(F.sum(f"_of_{name}").over(inside), none)).alias(name) for name in sums])


def source_targets(sizes: DataFrame, max_repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets per source from (source, size): source, weight, source_size, target.

    Weights repeat over the sources in code point order, null last.  A target stops at
    ``max_repeats`` times the source's size and the excess is shared again by weight: with the sources
    ordered by size over weight, those up to some place stop and the rest share what is left.  One
    row per source takes part, whatever the number of documents, and no task holds all sources.
    """
    by_name = F.col("source").asc_nulls_last()
    place = (F.col("_before") % len(weights) + 1).cast("int")
    common = math.prod(weights)
    ranked = prefix(sizes.select("source", F.col("size").alias("source_size")), [by_name], {"_before": F.lit(1).cast("long")}, "source-names")
    ranked = ranked.select("source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), place).cast("long").alias("weight"),
                           # size over weight, as an integer
                           (F.col("source_size") * F.element_at(F.array(*[F.lit(common // w) for w in weights]), place)).alias("_ratio"))
    ranked = keep(prefix(ranked, [F.col("_ratio").asc(), by_name], {
        "_n": F.lit(1).cast("long"), "_sizes": F.col("source_size"), "_lighter": F.col("weight")}, "source-ratios"), "source-order")
    whole = ranked.agg(F.struct(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))).scalar()
    ranked = ranked.withColumns({"_left": whole["size"] - max_repeats * F.col("_sizes"), "_weights": whole["weight"] - F.col("_lighter")})
    stops = max_repeats * F.col("source_size") * F.col("_weights") <= F.col("weight") * F.col("_left")
    # the first source that does not stop gives the rest's share
    first = ranked.filter(~stops).agg(F.min(F.struct("_n", "_left", "_weights"))).scalar()
    share = (F.col("weight") * first["_left"]).cast("double") / first["_weights"].cast("double")
    return ranked.select("source", "weight", "source_size", F.when(F.col("_n") >= first["_n"], share)
                         .otherwise((max_repeats * F.col("source_size")).cast("double")).alias("target"))


def _placed(rows: DataFrame, max_repeats: int, weights: tuple[int, ...], seed: str, id_column: str, source: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with ``size``) and source_size, target, ``ahead`` (words of its source before it in the queue) and its place as
    (_source, _stretch, _nth); and the targets."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_column).cast("string")))
    rows = rows.withColumns({"_source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")), "_key": key})
    rows = rows.withColumn("_stretch", F.conv(F.substring("_key", 1, STRETCH), 16, 10).cast("int"))
    stretches = keep(rows.groupBy("_source", "_stretch").agg(F.sum("size").alias("_sum")), "stretches")
    named = F.when(F.col("_source") != "", F.substring("_source", 2, 2 ** 31 - 1))
    targets = source_targets(stretches.groupBy("_source").agg(F.sum("_sum").alias("size")).select(named.alias("source"), "size"), max_repeats, weights)
    targets = keep(targets.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"), "source_size", "target"), "targets")
    up_to = Window.partitionBy("_source").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.withColumn("_start", F.coalesce(F.sum("_sum").over(up_to), F.lit(0))).join(targets, "_source").drop("_sum")
    within = Window.partitionBy("_source", "_stretch").orderBy("_key", id_column, "size")
    rows = rows.drop("source_size", "target", "ahead").withColumns({
        "_nth": F.row_number().over(within),
        "_here": F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")})
    # there may be as many stretches as documents: not for a broadcast, and the rows lie by stretch already
    placed = rows.join(keep(starts, "stretch-starts").hint("merge"), ["_source", "_stretch"])
    return placed.withColumn("ahead", F.col("_start") + F.col("_here")).drop("_key", "_here", "_start"), targets


def serve(docs: DataFrame, max_repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix",
          id_column: str = "doc_id", text_column: str = "text", source: str = "source") -> DataFrame:
    """What the mix takes of each document, one row per row of ``docs``: the id, size, source_size, target, taken.

    Every turn of a document, up to ``max_repeats`` of them, has the virtual time at which it finishes.  The turns of all
    sources are sorted by that time over the whole cluster and taken until the budget, the whole words of all targets, is
    used up.  The turn in which a source reaches its target is cut there: its first part finishes at time 1, its
    second part after it.  Running totals per range of the sort find the place of the budget.

    Null texts have size 0 and take nothing; null sources are one source; null and repeated ids are kept, a row each; other
    columns are not read; an empty table gives no rows.  Reruns agree.
    """
    sized = keep(docs.select(F.col(id_column).alias("_id"), F.col(source).alias("_name"), F.size(words(text(text_column))).cast("long").alias("size")), "sizes")
    placed, targets = _placed(sized, max_repeats, weights, seed, "_id", "_name")
    begin = lambda c: c * F.col("source_size") + F.col("ahead")
    before = lambda c: F.greatest(F.lit(0), F.least("size", F.floor("target") - begin(c)))
    finish = lambda c: F.try_divide((begin(c) + F.col("size")).cast("double"), F.col("target"))

    def part(c: Column, over: bool) -> Column:
        first = F.least(finish(c), F.lit(1.0))
        return F.struct(c.alias("copy"), F.lit(over).alias("over"), (finish(c) if over else first).alias("finish"),
                        (F.col("size") - before(c) if over else before(c)).alias("words"))

    copies = F.sequence(F.lit(0).cast("long"), F.lit(max_repeats - 1).cast("long"))
    parts = F.concat(F.transform(copies, lambda c: part(c, False)), F.transform(copies, lambda c: part(c, True)))
    # a document without words keeps one part
    parts = F.filter(parts, lambda x: (x["words"] > 0) | ((F.col("size") == 0) & (x["copy"] == 0) & ~x["over"]))
    place = ["_source", "_stretch", "_nth"]
    turns = placed.select("_id", *place, "size", "source_size", "target", F.explode(parts).alias("_turn")).select("*", "_turn.*").drop("_turn")
    line = prefix(turns, [F.col(c).asc() for c in ("finish", "over", *place, "copy")], {"_served": F.col("words")}, "turns")
    budget = targets.agg(F.sum(F.floor("target")).alias("budget")).scalar()
    taken = F.greatest(F.lit(0), F.least("words", budget - F.col("_served")))
    return line.groupBy(*place).agg(F.first("_id").alias(id_column), *[F.first(c).alias(c) for c in ("size", "source_size", "target")],
                                    F.sum(taken).alias("taken")).drop(*place)


def queue(docs: DataFrame, max_repeats: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix",
          id_column: str = "doc_id", text_column: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size (words), source_size, target, ``ahead`` (words of its source before it in
    the queue) and ``copies``: one (copy, finish, taken) for each of the document's turns before time 1.

    The turn that crosses time 1 is cut there, so a source gives its target to the word.  Null texts
    have size 0 and no turns; null sources are one source; null and repeated ids are kept; result
    columns replace columns of the same name; an empty table gives no rows.  The order
    depends on the seed and the ids alone, so reruns agree.
    """
    rows = docs.drop("copies").withColumn("size", F.size(words(text(text_column))).cast("long"))
    placed, _ = _placed(rows, max_repeats, weights, seed, id_column, source)
    turn = lambda c: F.struct(
        c.alias("copy"),
        F.try_divide((c * F.col("source_size") + F.col("ahead") + F.col("size")).cast("double"), F.col("target")).alias("finish"),
        F.greatest(F.lit(0), F.least("size", F.floor("target") - c * F.col("source_size") - F.col("ahead"))).alias("taken"))
    copies = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(max_repeats - 1).cast("long")), turn),
                      lambda x: x["taken"] > 0)
    return placed.withColumn("copies", copies).drop("_source", "_stretch", "_nth")


def mix(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The mixed corpus, one row per turn in order of finish time: ``docs``' columns with the text cut
    where the budget ends, and copy, finish, taken, size."""
    turns = queue(docs, text_column=text_column, **options)
    turns = turns.withColumn("_c", F.explode("copies")).select("*", "_c.*").drop("_c", "copies", "ahead", "source_size", "target")
    head = _first_words(F.col(text_column), F.col("taken"))
    turns = turns.withColumn(text_column, F.when(F.col("taken") < F.col("size"), head).otherwise(F.col(text_column)))
    return turns.orderBy("finish", options.get("id_column", "doc_id"), "copy")


def _first_words(body, n):
    """The first ``n`` words of a text, joined by single spaces."""
    return F.array_join(F.slice(words(body), F.lit(1), n.cast("int")), " ")
