"""Secret scan from built-in functions: known shapes, and strings of high entropy.

The entropy of a candidate string slides over it in a window whose character counts are changed by
the character that enters and the one that leaves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.quality import bind
from wakeline.llm.store import text

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# a run of 16 (32) or more characters holds every match that is long enough, and no other
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Strings that look random but are no secrets: samples, counting runs, identifiers in 8-4-4-4-12 form,
#: digests of named algorithms.
ALLOWED = (r"(?i)example|sample|placeholder|changeme|your[_-]|x{6,}|0{6,}", "(?i)0123456789|abcdefghij",
           "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", "(?i)^(sha1|sha256|sha384|sha512|md5)-")
#: Window length; bits of entropy that a window of hexadecimal, or of other, characters must reach.
WINDOW, HEX_BITS, BITS = 20, 3.0, 3.7

#: Bits of a character's count in the window, and items that are walked through at once.
BITS_PER_COUNT, GROUP = 5, 256

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _scan(items: Column, step) -> Column:
    """The int states after each item, from 0 on.  An array that grows by one is copied each time, so items are taken in groups:
    first what each group starts with, then the states inside each."""
    ints = F.array().cast("array<int>")
    last = F.floor((F.size(items) - 1) / GROUP).cast("int")
    grouped = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(items, k * GROUP + 1, F.lit(GROUP)))

    def inside(group: Column, start: Column) -> Column:
        return F.aggregate(group, F.struct(start.alias("at"), ints.alias("out")), lambda a, x: F.struct(
            step(a["at"], x).alias("at"), F.array_append(a["out"], step(a["at"], x)).alias("out")), lambda a: a["out"])

    def walk(groups: Column) -> Column:
        starts = F.aggregate(groups, F.struct(F.lit(0).alias("at"), ints.alias("out")), lambda a, g: F.struct(
            F.aggregate(g, a["at"], step).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(groups, starts, inside))

    return bind(grouped, walk)


def _spans(body: Column, pattern: str, kind: int, passes) -> Column:
    """Spans of the matches that pass: the pieces between matches and the matches give the places."""
    found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))

    def walk(m: Column) -> Column:
        gaps = F.slice(F.split(body, pattern, -1), 1, F.size(m))
        both = F.zip_with(gaps, m, lambda g, x: F.struct((F.length(g) + F.length(x)).alias("step"), x.alias("m")))
        return bind(both, lambda b: bind(_scan(b, lambda at, x: at + x["step"]), lambda ends: F.filter(
            F.zip_with(b, ends, lambda x, end: F.when(passes(x["m"]), F.struct(
                (end - F.length(x["m"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end")))), F.isnotnull).cast(_SPANS)))

    return bind(found, walk)


def window_entropy(s: Column, width: int = WINDOW) -> Column:
    """The greatest Shannon entropy, in bits, of ``width`` neighbouring characters of an ASCII string;
    of the whole string if it is shorter.

    The counts of the window's characters are kept as ``BITS_PER_COUNT`` bits each, some in a long, so that a step changes a
    few longs, whatever the length of the string.
    """
    if width >= 1 << BITS_PER_COUNT:
        raise ValueError(f"width must be below {1 << BITS_PER_COUNT}")
    per_long = 63 // BITS_PER_COUNT
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 1)])
    one = F.lit(1).cast("long")

    def walk(codes: Column) -> Column:
        full = F.least(F.size(codes), F.lit(width))
        slot = lambda c: F.floor(c / per_long).cast("int")
        place = lambda c: (c % per_long * BITS_PER_COUNT).cast("int")

        def entry(code: Column, i: Column) -> Column:
            gone = F.when(i >= width, codes[i - width]).otherwise(F.lit(-1))
            return F.struct(i.alias("i"), slot(code).alias("in"), place(code).alias("in_at"),
                            slot(gone).alias("out"), place(gone).alias("out_at"))

        def step(a: Column, x: Column) -> Column:
            leaves = x["out"] >= 0
            count = lambda at, bit: F.call_function("shiftright", a["n"][at], bit).bitwiseAND((1 << BITS_PER_COUNT) - 1)
            # what leaves goes first; a character that leaves and comes at once changes nothing
            gone = F.when(leaves, count(x["out"], x["out_at"])).otherwise(F.lit(0))
            held = count(x["in"], x["in_at"]) - F.when((x["out"] == x["in"]) & (x["out_at"] == x["in_at"]), 1).otherwise(0)
            total = a["sum"] - F.when(leaves, term[gone.cast("int")] - term[gone.cast("int") - 1]).otherwise(0.0) \
                - term[held.cast("int")] + term[held.cast("int") + 1]
            come_bit, go_bit = (F.call_function("shiftleft", one, x[f"{way}_at"]) for way in ("in", "out"))
            counts = F.transform(a["n"], lambda n, k: n + F.when(k == x["in"], come_bit).otherwise(0) - F.when(k == x["out"], go_bit).otherwise(0))
            return F.struct(counts.alias("n"), total.alias("sum"), F.least(a["least"], F.when(x["i"] + 1 >= full, total)).alias("least"))

        zero = F.struct(F.array_repeat(F.lit(0).cast("long"), 128 // per_long + 1).alias("n"), F.lit(0.0).alias("sum"),
                        F.lit(None).cast("double").alias("least"))
        # the entropy is greatest where the sum of n log n is least
        least = F.aggregate(F.transform(codes, entry), zero, step, lambda a: a["least"])
        return F.log2(full.cast("double")) - least / full

    return F.when(F.length(s) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), bind(F.transform(F.split(s, ""), F.ascii), walk)))


def _random(m: Column) -> Column:
    hexadecimal = m.rlike("^[0-9a-fA-F]+$")
    mixed = m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | m.rlike(pattern)
    return ((hexadecimal & m.rlike("[0-9]") & m.rlike("[a-fA-F]")) | mixed) & ~allowed & (
        window_entropy(m) >= F.when(hexadecimal, HEX_BITS).otherwise(BITS))


def secret_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``secret_spans``: arrays of (start, kind, end) in code points,
    end exclusive, kind as a place in ``KINDS``, ordered by start, then kind.

    Base spans are the matches of the three known shapes; a random-looking string is added where
    no base span holds it and the allow-list does not name it.  A null text is empty; nothing else of a row
    matters, and every row is kept.
    """
    body = text(text_column)
    none = F.array().cast(_SPANS)
    assign = F.when(body.rlike("(?i)passw|secret|token|api_?key"), _spans(
        body, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8)).otherwise(none)
    access = F.when(F.contains(body, F.lit("AKIA")), _spans(body, ACCESS, 1, lambda m: F.lit(True))).otherwise(none)
    hexes = F.when(body.rlike(HEX), _spans(body, HEX, 2, lambda m: F.lit(True))).otherwise(none)
    entropy = F.when(body.rlike(CANDIDATE), _spans(body, CANDIDATE, 3, _random)).otherwise(none)
    out = docs.withColumn("base_spans", F.sort_array(F.concat(assign, access, hexes))).withColumn("_more", entropy)
    # of spans in order of start, base spans first, one that no base span before it reaches over is free
    tagged = lambda spans, tag: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(tag).alias("tag"), x["kind"].alias("kind"), x["end"].alias("end")))
    free = bind(F.sort_array(F.concat(tagged("base_spans", 0), tagged("_more", 1))), lambda line: F.filter(F.zip_with(
        line, _scan(line, lambda reach, x: F.when(x["tag"] == 0, F.greatest(reach, x["end"])).otherwise(reach)),
        lambda x, reach: F.when((x["tag"] == 1) & (reach < x["end"]), F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))),
        F.isnotnull).cast(_SPANS))
    return out.withColumn("secret_spans", F.sort_array(F.concat("base_spans", free))).drop("_more")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["end"])), ",")


def redact(docs: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` of ``secret_spans`` with every span's characters replaced; spans that overlap give one mark."""
    def step(a: Column, x: Column) -> Column:
        fresh = x["start"] >= a["at"]
        gap = F.substring(text(text_column), a["at"] + 1, F.greatest(x["start"] - a["at"], F.lit(0)))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"),
                        F.when(fresh, F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    tail = lambda a: F.concat(a["out"], F.substring(text(text_column), a["at"] + 1, F.length(text(text_column))))
    return docs.withColumn(text_column, F.when(F.size("secret_spans") > 0, F.aggregate("secret_spans", zero, step, tail))
                           .otherwise(F.col(text_column)))
