"""Quality rules from built-in functions: counts within a text, and line frequency across documents.

Lines are normalised and hashed; a line that many different documents of one host carry is removed,
and a document that has little else is rejected.  Copies of one document are not different
documents: texts are told apart by the hash of the whole text, so a copied document does not make its
own lines look like boilerplate, and does not hide the boilerplate of others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.store import keep, text

SYMBOLS = "#*$%&|<>"


def words(body: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D."""
    # other white space becomes a blank first: splitting at one plain character needs no pattern
    for space in "\t\n\x0b\x0c\r":
        body = F.replace(body, F.lit(space), F.lit(" "))
    return F.filter(F.split(body, " "), lambda w: w != "")


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _covered(starts: Column, width: int) -> Column:
    """Places covered by windows of ``width`` at the sorted ``starts``."""
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + s + width - F.greatest(a["to"], s)).alias("n"), (s + width).alias("to")),
        lambda a: a["n"])


def window_hashes(w: Column) -> Column:
    """Hashes of the windows of five words, at their first word; ``w`` has five words or more."""
    windows = lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, 5)]))
    return F.slice(bind(F.transform(w, lambda x: F.xxhash64(x)), windows), F.lit(1), F.size(w) - 4)


def repeat_words(w: Column) -> Column:
    """Words inside windows of five words that stand in the text twice or more."""
    def few(h: Column, again: Column) -> Column:
        places = F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i))
        return _covered(F.filter(places, lambda i: i.isNotNull()), 5)

    def many(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = lambda s: F.transform(F.filter(s, lambda x, k: (
            (F.get(s, k + 1)["h"] == x["h"]) | (F.get(s, k - 1)["h"] == x["h"]))), lambda x: x["i"])
        return bind(ordered, lambda s: _covered(F.sort_array(places(s)), 5))

    def repeated(h: Column) -> Column:
        again = bind(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: x == F.get(s, k + 1))))
        # the same places, by search in a short list or by order
        return bind(again, lambda a: F.when(F.size(a) <= 32, few(h, a)).otherwise(many(h)))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h))

    return F.when(F.size(w) <= 5, F.lit(0)).otherwise(bind(window_hashes(w), count))


def _line_hash(joined: Column) -> Column:
    """Of a line whose white space is folded: in lower case, with runs of digits alike."""
    low = F.lower(joined)
    return F.xxhash64(F.when(low.rlike("[0-9]"), F.regexp_replace(low, "[0-9]+", "0")).otherwise(low))


def _lines(body: Column) -> Column:
    """(raw, line, chars, words) of each line with a word: hash as it is, hash when normalised,
    code points in its words, the words."""
    split = F.transform(F.split(body, "\n", -1), lambda x: F.struct(x.alias("x"), words(x).alias("words")))
    split = F.transform(F.filter(split, lambda x: F.size(x["words"]) > 0), lambda x: F.struct(
        F.xxhash64(x["x"]).alias("raw"), F.array_join(x["words"], " ").alias("x"), x["words"].alias("words")))
    return F.transform(split, lambda x: F.struct(
        x["raw"].alias("raw"), _line_hash(x["x"]).alias("line"),
        (F.length(x["x"]) - F.size(x["words"]) + 1).alias("chars"), x["words"].alias("words")))


def text_facts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and
    ``text_lines``: (line, words) of each line, hash and number of words."""
    body = text(text_column)
    out = docs.withColumn("_lines", _lines(body)).withColumn("_w", F.flatten(F.col("_lines.words")))
    symbols = sum((F.octet_length(body) - F.octet_length(F.replace(body, F.lit(s), F.lit("")))) for s in SYMBOLS)
    out = out.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.aggregate("_lines", F.lit(0), lambda n, x: n + x["chars"]).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct(F.col("_lines.raw")))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_w")).cast("long"),
        "text_lines": F.transform("_lines", lambda x: F.struct(x["line"].alias("line"), F.size(x["words"]).alias("words")))})
    return out.drop("_w", "_lines").withColumn("base_failed", (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def frequent_lines(facts: DataFrame, max_documents: int) -> DataFrame:
    """(host, line) that more than ``max_documents`` different documents of the host carry.

    Copies of a text are folded first, map side; then a line of a third of all texts costs one row per task.
    """
    texts = facts.select("host", "text_hash", F.array_distinct("text_lines.line").alias("lines")).distinct()
    lines = texts.select("host", F.explode("lines").alias("line"))
    return lines.groupBy("host", "line").agg(F.count("*").alias("texts")) \
        .filter(F.col("texts") > max_documents).select("host", "line")


FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def verdicts(docs: DataFrame, max_documents: int = 50, min_left: float = 0.5, min_words: int = 10,
             id_column: str = "doc_id", text_column: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, text_hash, host, the columns of ``FACTS``, removed_lines (hashes of its
    frequent lines, null if none), left_words (words outside them) and kept.

    A document is rejected if a text rule fails, or if removing frequent lines leaves fewer than
    ``min_words`` words or less than the share ``min_left`` of its words.  Null texts are empty; null
    hosts are one host; null and repeated ids are kept, and equal rows get equal results; blank lines
    never count; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), text(text_column).alias("text"), F.col(host).alias("host"))
    facts = keep(text_facts(rows).select(
        "id", F.xxhash64("text").alias("text_hash"), "host", *FACTS, "text_lines"), "text-facts")
    frequent = keep(frequent_lines(facts, max_documents), "frequent-lines")
    # equal rows are folded before their lines are listed, so that sums count each once
    lines = facts.select("id", "text_hash", "host", "text_lines").distinct().select(
        "id", "text_hash", "host", F.explode("text_lines").alias("_l")).select("id", "text_hash", "host", "_l.*")
    hit = lines.join(frequent.withColumnRenamed("host", "f_host").withColumnRenamed("line", "f_line"),
                     F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")))
    removed = keep(hit.groupBy("id", "text_hash", "host").agg(
        F.collect_set("line").alias("removed_lines"), F.sum("words").alias("removed_words")), "removed-lines")
    removed = removed.select(*[F.col(c).alias(f"r_{c}") for c in ("id", "text_hash", "host")], "removed_lines", "removed_words")
    same = F.lit(True)
    for c in ("id", "text_hash", "host"):
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    out = facts.drop("text_lines").join(removed, same, "left").withColumn(
        "left_words", F.col("n_words") - F.coalesce("removed_words", F.lit(0)))
    depleted = F.col("removed_lines").isNotNull() & (
        (F.col("left_words") < min_words) | (F.col("left_words") < min_left * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).select(
        "id", "text_hash", "host", *FACTS, "removed_lines", "left_words", "kept")


def clean(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host: str = "source",
          **limits) -> DataFrame:
    """The documents that ``verdicts`` keeps, with their frequent lines cut out of the text; columns as
    in ``docs``."""
    found = verdicts(docs, id_column=id_column, text_column=text_column, host=host, **limits).select(
        "id", "text_hash", F.col("host").alias("_host"), "removed_lines", "kept").distinct()
    found = found.filter("kept").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "_host",
                                        F.col("removed_lines").alias("_removed"))
    same = docs[id_column].eqNullSafe(F.col("_id")) & (F.xxhash64(text(text_column)) == F.col("_hash")) & (
        docs[host].eqNullSafe(F.col("_host")))
    left = F.filter(F.split(text(text_column), "\n", -1), lambda x: bind(words(x), lambda w: (F.size(w) == 0) | ~F.coalesce(
        F.array_contains("_removed", _line_hash(F.array_join(w, " "))), F.lit(False))))
    out = docs.join(found, same)
    return out.withColumn(text_column, F.when(F.col("_removed").isNull(), F.col(text_column))
                          .otherwise(F.array_join(left, "\n"))).select(docs.columns)
