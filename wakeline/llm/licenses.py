"""Licence scan: ordered signature rules behind a keyword filter, with priorities and containment."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import hashes
from wakeline.llm.store import text

#: What may stand between two words of a pattern: white space, line ends with comment marks around them.
GAP = r"(?>(?:[^\S\n]+|(?:[#*%;|]+[^\S\n]*)?\n[^\S\n]*(?:[#*%;!>|]+|//+|--+|(?:dnl|rem)\b)?)+)"

#: (label, keyword of the name, name, SPDX identifiers, keyword of the address, address).  All in lower
#: case; a space stands for a ``GAP``; a keyword stands in every text its pattern can match, gaps made one space.
FAMILIES = (
    ("mit", "mit", r"\b(?:the )?mit (?:open source )?licen[sc]e\b|\bmit/expat\b", "mit", "licenses/mit", r"opensource\.org/licenses/mit\b"),
    ("mit-0", "mit", r"\bmit no attribution\b", "mit-0", "mit-0", r"github\.com/aws/mit-0\b"),
    ("apache", "apache", r"\bapache (?:software )?licen[sc]e(?:,? version (?:1\.[01]|2(?:\.0)?))?", r"apache-(?:1\.[01]|2\.0)", "apache.org", r"apache\.org/licenses/license-(?:1\.[01]|2\.0)"),
    ("gpl", "gpl", r"\bgplv?[ -]?[123](?:\.0)?\b", r"gpl-[123]\.0(?:-only|-or-later|\+)?", "licenses/gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "lgpl", r"\blgplv?[ -]?(?:2(?:\.[01])?|3(?:\.0)?)\b", r"lgpl-[23]\.[01](?:-only|-or-later|\+)?", "licenses/lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "agpl", r"\bagplv?[ -]?[13](?:\.0)?\b", r"agpl-[13]\.0(?:-only|-or-later|\+)?", "licenses/agpl", r"gnu\.org/licenses/agpl"),
    ("bsd-2-clause", "bsd", r"\b(?:2-clause|two-clause|simplified|freebsd) bsd(?: licen[sc]e)?\b|\bbsd 2-clause\b", "bsd-2-clause", "bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"\b(?:3-clause|three-clause|new|modified|revised) bsd(?: licen[sc]e)?\b|\bbsd 3-clause\b", "bsd-3-clause", "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"\b(?:4-clause|four-clause|original) bsd(?: licen[sc]e)?\b|\bbsd 4-clause\b", "bsd-4-clause", "bsd-4-clause", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", r"\bzero[- ]clause bsd\b", "0bsd", "0bsd", r"opensource\.org/licenses/0bsd"),
    ("bsd", "bsd", r"\bbsd(?:-style)? licen[sc]e\b", "bsd", "bsd-license", r"opensource\.org/licenses/bsd-license"),
    ("isc", "isc", r"\bisc licen[sc]e\b", "isc", "licenses/isc", r"opensource\.org/licenses/isc"),
    ("mpl-1.1", "mozilla", r"\bmozilla public licen[sc]e,? (?:version |v\.? ?)?1\.[01]", r"mpl-1\.[01]", "mpl/1", r"mozilla\.org/(?:en-us/)?mpl/1\.[01]"),
    ("mpl-2.0", "mozilla", r"\bmozilla public licen[sc]e(?:,? (?:version |v\.? ?)?2(?:\.0)?)?\b", "mpl-2.0", "mpl/2", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl", "eclipse", r"\beclipse public licen[sc]e\b", r"epl-[12]\.0", "epl-v", r"eclipse\.org/legal/epl-v[12]0"),
    ("edl", "eclipse", r"\beclipse distribution licen[sc]e\b", r"edl-1\.0", "edl-v10", r"eclipse\.org/org/documents/edl-v10"),
    ("cddl", "common development", r"\bcommon development and distribution licen[sc]e\b", r"cddl-1\.[01]", "licenses/cddl", r"opensource\.org/licenses/cddl"),
    ("cpl", "common public", r"\bcommon public licen[sc]e\b", r"cpl-1\.0", "licenses/cpl", r"opensource\.org/licenses/cpl1"),
    ("ipl", "ibm public", r"\bibm public licen[sc]e\b", r"ipl-1\.0", "licenses/ibmpl", r"opensource\.org/licenses/ibmpl"),
    ("artistic", "artistic", r"\bartistic licen[sc]e(?: 2\.0)?\b", r"artistic-[12]\.0", "artistic-license", r"opensource\.org/licenses/artistic-license"),
    ("boost", "boost", r"\bboost software licen[sc]e\b", r"bsl-1\.0", "license_1_0", r"boost\.org/license_1_0"),
    ("zlib", "zlib", r"\bzlib(?:/libpng)? licen[sc]e\b", "zlib", "licenses/zlib", r"opensource\.org/licenses/zlib"),
    ("libpng", "libpng", r"\blibpng licen[sc]e\b", r"libpng(?:-2\.0)?", "libpng.org", r"libpng\.org/pub/png/src/libpng-license"),
    ("unlicense", "unlicen", r"\bthe unlicen[sc]e\b", "unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"\bwtfpl\b", "wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("cc0", "cc0", r"\bcc0(?: 1\.0)?(?: universal)?\b", r"cc0-1\.0", "publicdomain/zero", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by", "cc by", r"\bcc by(?: [1-4]\.[0-5])?(?![ -](?:nc|nd|sa))", r"cc-by-[1-4]\.[0-5]", "licenses/by/", r"creativecommons\.org/licenses/by/[1-4]\.[0-5]"),
    ("cc-by-sa", "by-sa", r"\bcc[ -]by-sa(?: [1-4]\.[0-5])?\b", r"cc-by-sa-[1-4]\.[0-5]", "licenses/by-sa/", r"creativecommons\.org/licenses/by-sa/[1-4]\.[0-5]"),
    ("cc-by-nd", "by-nd", r"\bcc[ -]by-nd(?: [1-4]\.[0-5])?\b", r"cc-by-nd-[1-4]\.[0-5]", "licenses/by-nd/", r"creativecommons\.org/licenses/by-nd/[1-4]\.[0-5]"),
    ("cc-by-nc", "by-nc", r"\bcc[ -]by-nc(?: [1-4]\.[0-5])?(?!-)", r"cc-by-nc-[1-4]\.[0-5]", "licenses/by-nc/", r"creativecommons\.org/licenses/by-nc/[1-4]\.[0-5]"),
    ("cc-by-nc-sa", "by-nc-sa", r"\bcc[ -]by-nc-sa(?: [1-4]\.[0-5])?\b", r"cc-by-nc-sa-[1-4]\.[0-5]", "licenses/by-nc-sa/", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[0-5]"),
    ("cc-by-nc-nd", "by-nc-nd", r"\bcc[ -]by-nc-nd(?: [1-4]\.[0-5])?\b", r"cc-by-nc-nd-[1-4]\.[0-5]", "licenses/by-nc-nd/", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[0-5]"),
    ("gfdl", "free documentation", r"\bgnu free documentation licen[sc]e\b", r"gfdl-1\.[123](?:-only|-or-later)?", "gnu.org", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("odbl", "open database", r"\bopen database licen[sc]e\b", r"odbl-1\.0", "licenses/odbl", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", "open data commons", r"\bopen data commons attribution licen[sc]e\b", r"odc-by-1\.0", "opendatacommons.org", r"opendatacommons\.org/licenses/by"),
    ("pddl", "public domain dedication", r"\bpublic domain dedication and licen[sc]e\b", r"pddl-1\.0", "licenses/pddl", r"opendatacommons\.org/licenses/pddl"),
    ("eupl", "european union public", r"\beuropean union public licen[sc]e\b", r"eupl-1\.[012]", "eupl", r"joinup\.ec\.europa\.eu/\S{0,60}eupl"),
    ("cecill", "cecill", r"\bcecill(?:-[bc])?(?: licen[sc]e)?\b", r"cecill(?:-[bc]|-2\.[01])?", "cecill.info", r"cecill\.info/licen[sc]"),
    ("ms-pl", "microsoft public", r"\bmicrosoft public licen[sc]e\b", "ms-pl", "licenses/ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", "microsoft reciprocal", r"\bmicrosoft reciprocal licen[sc]e\b", "ms-rl", "licenses/ms-rl", r"opensource\.org/licenses/ms-rl"),
    ("ofl", "open font", r"\b(?:sil )?open font licen[sc]e\b", r"ofl-1\.[01]", "scripts.sil.org", r"scripts\.sil\.org/ofl"),
    ("python", "python software", r"\bpython software foundation licen[sc]e\b", r"(?:python|psf)-2\.0", "python.org", r"python\.org/(?:psf/)?license"),
    ("php", "php", r"\bphp licen[sc]e\b", r"php-3\.0[01]?", "php.net/license", r"php\.net/license"),
    ("ruby", "ruby", r"\bruby licen[sc]e\b", "ruby", "ruby-lang.org", r"ruby-lang\.org/\S{0,20}license"),
    ("openssl", "openssl", r"\bopenssl licen[sc]e\b", "openssl", "openssl.org", r"openssl\.org/source/license"),
    ("postgresql", "postgresql", r"\bpostgresql licen[sc]e\b", "postgresql", "licenses/postgresql", r"opensource\.org/licenses/postgresql"),
    ("sspl", "server side public", r"\bserver side public licen[sc]e\b", r"sspl-1\.0", "server-side-public", r"mongodb\.com/licensing/server-side-public-license"),
    ("busl", "business source", r"\bbusiness source licen[sc]e\b", r"busl-1\.1", "bsl11", r"mariadb\.com/bsl11"),
    ("elastic", "elastic", r"\belastic licen[sc]e\b", r"elastic-2\.0", "elastic-license", r"elastic\.co/licensing/elastic-license"),
    ("osl", "open software", r"\bopen software licen[sc]e\b", r"osl-[123]\.[01]", "licenses/osl", r"opensource\.org/licenses/osl"),
    ("afl", "academic free", r"\bacademic free licen[sc]e\b", r"afl-[123]\.[01]", "licenses/afl", r"opensource\.org/licenses/afl"),
    ("ncsa", "ncsa", r"\b(?:university of illinois/)?ncsa open source licen[sc]e\b", "ncsa", "ncsa", r"opensource\.org/licenses/(?:uoi-)?ncsa"),
    ("upl", "universal permissive", r"\buniversal permissive licen[sc]e\b", r"upl-1\.0", "licenses/upl", r"oss\.oracle\.com/licenses/upl"),
    ("w3c", "w3c", r"\bw3c software (?:notice and )?licen[sc]e\b", "w3c", "consortium/legal", r"w3\.org/consortium/legal"),
    ("x11", "x11", r"\bx11 licen[sc]e\b", "x11", "x.org/", r"x\.org/\S{0,30}licen[sc]e"),
    ("vim", "vim", r"\bvim licen[sc]e\b", "vim", "vimdoc", r"vimdoc\.sourceforge\.net/\S{0,30}license"),
    ("blueoak", "blue oak", r"\bblue oak model licen[sc]e\b", r"blueoak-1\.0\.0", "blueoakcouncil", r"blueoakcouncil\.org/license"),
    ("beerware", "beer-ware", r"\bbeer-ware licen[sc]e\b", "beerware", "beerware", r"people\.freebsd\.org/\S{0,20}beerware"),
)

#: (label, keyword, pattern, weight) of sentences in licence texts and notices.
NOTICES = (
    ("mit", "free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy", 1.0),
    ("isc", "with or without fee", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", 1.0),
    ("apache", "version 2.0", r"licensed under the apache licen[sc]e,? version 2\.0", 1.0),
    ("apache", "except in compliance", r"you may not use this file except in compliance with the licen[sc]e", 0.9),
    ("gpl", "free software", r"this program is free software[:;] you can redistribute it and/or modify\s+it under the terms of the gnu general public licen[sc]e", 1.0),
    ("gpl", "gnu general", r"\bgnu general public licen[sc]e(?:,? (?:version|v\.?) ?[123])?", 0.95),
    ("lgpl", "lesser general", r"\b(?:gnu )?lesser general public licen[sc]e\b", 0.95),
    ("lgpl", "library general", r"\b(?:gnu )?library general public licen[sc]e\b", 0.95),
    ("agpl", "affero", r"\b(?:gnu )?affero general public licen[sc]e\b", 0.95),
    ("bsd", "source and binary", r"redistribution and use in source and binary forms, with or without\s+modification, are permitted", 0.9),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software", 0.9),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", 1.0),
    ("boost", "boost software", r"distributed under the boost software licen[sc]e, version 1\.0", 1.0),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty", 0.9),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public\s+licen[sc]e, v\. 2\.0", 1.0),
    ("epl", "eclipse", r"made available under the terms of the eclipse public licen[sc]e", 1.0),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "public domain", r"\b(?:released into|dedicated to|placed in|in) the public domain\b", 0.7),
    ("cc0", "waived all copyright", r"to the extent possible under law, [\s\S]{1,80} has waived all copyright", 0.8),
    ("cc-by", "creative commons", r"\bcreative commons attribution(?: [1-4]\.[0-5])?(?: international)?(?: licen[sc]e)?(?!-)", 0.9),
    ("cc-by-sa", "sharealike", r"\bcreative commons attribution-sharealike\b", 0.95),
    ("cc-by-nc", "noncommercial", r"\bcreative commons attribution-noncommercial\b(?!-)", 0.95),
    ("cc-by-nc-sa", "noncommercial", r"\bcreative commons attribution-noncommercial-sharealike\b", 0.95),
    ("cc-by-nc-nd", "noncommercial", r"\bcreative commons attribution-noncommercial-noderiv\w*", 0.95),
    ("cc-by-nd", "noderiv", r"\bcreative commons attribution-noderiv\w*", 0.95),
    ("wtfpl", "what the", r"do what the f\w+ you want to public licen[sc]e", 1.0),
    ("proprietary", "all rights", r"\ball rights reserved\b", 0.4),
    ("proprietary", "proprietary", r"\bproprietary and confidential\b", 0.8),
    ("proprietary", "unauthori", r"\bunauthori[sz]ed (?:copying|reproduction|distribution|use)\b", 0.7),
    ("warranty-disclaimer", "as is", r"\b(?:is )?provided \"?as is\"?,? without (?:any )?warrant(?:y|ies)", 0.3),
)

#: Base phrases and their labels.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))


def _wrapped(pattern: str) -> str:
    """``pattern`` with gaps for its spaces."""
    for one, alone in ((r"\s+", " "), ("[ -]", "(?: |-)"), ("[- ]", "(?: |-)")):
        pattern = pattern.replace(one, alone)
    return pattern.replace(" ", GAP)


def _rules() -> list[tuple[int, str, str, re.Pattern, float]]:
    """(priority, label, keyword, pattern, weight), highest priority first: tags, then addresses,
    notices, names after "licensed under", plain names."""
    out = []
    for label, word, name, tag, place, address in FAMILIES:
        out += [(5, label, "spdx-license-identifier", rf"spdx-license-identifier:\s*\(?(?:{tag})(?![\w.+-])", 1.0),
                (4, label, place, address, 0.95),
                (2, label, word, rf"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:{name})", 0.9),
                (1, label, word, name, 0.7)]
    out += [(3, label, word, pattern, weight) for label, word, pattern, weight in NOTICES]
    return [(p, label, word, re.compile(_wrapped(pattern)), weight) for p, label, word, pattern, weight in sorted(out, key=lambda r: -r[0])]


RULES = _rules()
_GAPS = re.compile(GAP)


def folded(low: str) -> str:
    """``low`` with each gap between words made one space, as the keywords have it."""
    return _GAPS.sub(" ", low)


#: A tag with a whole expression behind it, and the names in one; what follows "with" is an exception to a licence.
EXPRESSION = re.compile(r"spdx-license-identifier:\s*([( \t]*[\w.+-]+[) \t]*(?:(?<=[) \t])(?:or|and|with)(?=[( \t])[( \t]*[\w.+-]+[) \t]*)*)")
_NAMES = re.compile(r"[\w.+-]+")
_TAGS = [(label, re.compile(tag)) for label, _, _, tag, _, _ in FAMILIES]


def _expressions(low: str) -> Iterator[tuple]:
    """Detections of the names in tagged expressions; that of the first one begins with its tag, as in the tag rules."""
    for m in EXPRESSION.finditer(low):
        before = None
        for name in _NAMES.finditer(m[1]):
            if before in (None, "or", "and"):
                label = next((label for label, tag in _TAGS if tag.fullmatch(name[0])), None)
                if label:
                    start, end = m.start() if before is None else m.start(1) + name.start(), m.start(1) + name.end()
                    yield -5, start - end, start, end, label, 1.0
            before = name[0]


def settled(found: list[tuple]) -> list[tuple[int, int, str, float]]:
    """(start, end, label, weight) of those (-priority, -length, start, end, label, weight) that are neither inside nor around one
    that comes before them.

    No kept one lies in another, so their ends have the order of their starts: of those that begin at or before a place
    the last one reaches farthest, of those that begin there or later the first one ends first.
    """
    starts: list[int] = []
    kept: list[tuple[int, int, str, float]] = []
    for _, _, start, end, label, weight in sorted(found):
        at = bisect_right(starts, start)
        if at and kept[at - 1][1] >= end:
            continue
        at = bisect_left(starts, start)
        if at < len(kept) and kept[at][1] <= end:
            continue
        starts.insert(at, start)
        kept.insert(at, (start, end, label, weight))
    return kept


def detect(low: str, keywords: set[str]) -> list[tuple[int, int, str, float]]:
    """(start, end, label, weight) in a lower-cased text: of two detections, one inside the other,
    only that of the rule that comes first stays; of one rule's equals the longer.  Of a tag with an expression, every
    licence it names is a detection."""
    found = [(-p, m.start() - m.end(), m.start(), m.end(), label, weight) for p, label, word, pattern, weight in RULES
             if word in keywords for m in pattern.finditer(low) if m.end() > m.start()]
    if "spdx-license-identifier" in keywords:
        found += _expressions(low)
    return settled(found)


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, detections array<struct<start:int,end:int,label:string,weight:double>>")


def _base(low: str) -> tuple[list[int], set[str]]:
    words, starts, labels = _WORD(low), [], set()
    for at, word in enumerate(words):
        if word == "license":
            for phrase, label in PHRASES:
                first = at - len(phrase) + 1
                if first >= 0 and tuple(words[first:at + 1]) == phrase:
                    starts.append(first)
                    labels.add(label)
    return sorted(starts), labels


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: number of words, places of the base phrases (count, smallest and
    largest first word), their labels, all labels, a score and the kept detections (in the text with A-Z
    lower-cased, end exclusive).

    The score is the chance that at least one detection holds, their weights being independent
    chances.  A null text is empty, with no words, null places, empty labels and score 0; null and repeated
    ids are kept; other columns are ignored; an empty table gives no rows.  Only texts that hold a
    rule's keyword meet that rule's pattern.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        gate = ahocorasick.Automaton()
        for word in {r[2] for r in RULES} | {"license"}:
            gate.add_word(word, word)
        gate.make_automaton()
        for batch in batches:
            texts = [(t or "").encode().translate(_LOWER) for t in batch.column(1).to_pylist()]
            counts = []
            for a, b in hashes.chunks(texts):
                raw = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", np.uint8)
                starts, _ = hashes.word_ends(raw, _WORD_BYTE)
                bounds = np.cumsum([0] + [len(t) + 1 for t in texts[a:b]])
                counts += np.diff(np.searchsorted(starts, bounds)).tolist()
            rows = []
            for n, raw_text in zip(counts, texts):
                low = raw_text.decode()
                words = {w for _, w in gate.iter(folded(low))}
                # a keyword that ends inside or equals the end of another is found as well; none is lost
                found = detect(low, words) if words else []
                starts, labels = _base(low) if "license" in words else ([], set())
                miss = 1.0
                for *_, weight in found:
                    miss *= 1.0 - weight
                if labels:
                    miss = min(miss, 0.3)
                rows.append((n, len(starts), starts[0] if starts else None, starts[-1] if starts else None,
                             ",".join(sorted(labels)), ",".join(sorted(labels | {f[2] for f in found})), 1.0 - miss,
                             [dict(zip(("start", "end", "label", "weight"), f)) for f in found]))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("weight", pa.float64())]))]
            columns = list(zip(*rows)) or [()] * len(types)
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text(text_column).alias("text")).mapInArrow(scan, SCHEMA)
