"""License scan: ordered signature rules behind a keyword gate, resolved by priority and interval containment.

A rule is a regular expression over the words of a text (lower case, joined by one blank) with one anchor word marked ``|``.
Only texts that pass the keyword gate are searched, only around anchor words, and only with that word's rules. At one place
the first matching rule in priority order is the detection; a detection whose words lie inside those of another detection
of at least its priority is suppressed. SPDX expressions are taken apart into their identifiers. Everything happens inside the row, in built-in expressions: no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import PLAIN_WORD, beside, lowered

#: Base phrases and labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label and how the license's name may be written, as words.
NAMES = [
    ("mit", "mit|expat"),
    ("mit-0", "mit 0|mit no attribution"),
    ("apache-1.1", "apache( software)? 1 1|apache software( license)? version 1 1"),
    ("apache-2", "apache 2( 0)?|apache version 2( 0)?|apache v2( 0)?|asl 2( 0)?"),
    ("bsd-2-clause", "bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd"),
    ("bsd-3-clause", "bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-4-clause", "bsd 4 clause|4 clause bsd|original bsd"),
    ("0bsd", "0bsd|bsd zero clause|zero clause bsd"),
    ("gpl-1", "gpl 1( 0)?|gplv1|gnu general public license version 1"),
    ("gpl-2", "gpl 2( 0)?|gplv2|gnu general public license( as published by the free software foundation)? version 2"),
    ("gpl-3", "gpl 3( 0)?|gplv3|gnu general public license( as published by the free software foundation)? version 3"),
    ("gpl", "gpl|gnu general public"),
    ("lgpl-2", "lgpl 2( 0)?(?! 1)|lgplv2|gnu library general public license version 2"),
    ("lgpl-2.1", "lgpl 2 1|lgplv2 1|gnu lesser general public license version 2 1"),
    ("lgpl-3", "lgpl 3( 0)?|lgplv3|gnu lesser general public license version 3"),
    ("lgpl", "lgpl|gnu lesser general public|gnu library general public"),
    ("agpl-3", "agpl 3( 0)?|agplv3|gnu affero general public license version 3"),
    ("agpl", "agpl|gnu affero general public|affero general public"),
    ("gfdl", "gfdl|gnu free documentation"),
    ("mpl-1.1", "mpl 1 1|mozilla public license version 1 1|mozilla public 1 1"),
    ("mpl-2", "mpl 2( 0)?|mozilla public license version 2( 0)?|mozilla public 2( 0)?"),
    ("epl-1", "epl 1( 0)?|eclipse public license version 1( 0)?|eclipse public 1( 0)?"),
    ("epl-2", "epl 2( 0)?|eclipse public license version 2( 0)?|eclipse public 2( 0)?"),
    ("cddl-1", "cddl( 1)?( 0)?|common development and distribution"),
    ("cpl-1", "cpl 1( 0)?|common public license version 1( 0)?|common public"),
    ("isc", "isc|internet systems consortium"),
    ("zlib", "zlib|zlib libpng"),
    ("boost-1", "bsl 1( 0)?|boost software"),
    ("artistic-1", "artistic 1( 0)?|original artistic"),
    ("artistic-2", "artistic 2( 0)?|artistic license version 2( 0)?"),
    ("python-2", "python 2( 0)?|python software foundation|psf"),
    ("postgresql", "postgresql"),
    ("openssl", "openssl"),
    ("wtfpl", "wtfpl|do what the fuck you want to public"),
    ("unlicense", "unlicense"),
    ("ofl-1.1", "ofl( 1 1)?|sil open font"),
    ("ecl-2", "ecl 2( 0)?|educational community"),
    ("eupl-1.2", "eupl( 1 2)?|european union public"),
    ("ms-pl", "ms pl|microsoft public"),
    ("odbl", "odbl( 1 0)?|open database"),
    ("cc0", "cc0( 1 0)?|cc0 1 0 universal|creative commons zero"),
    ("cc-by", "cc by( [1-4] 0)?|creative commons attribution( [1-4] 0)?"),
    ("cc-by-sa", "cc by sa( [1-4] 0)?|creative commons attribution share ?alike( [1-4] 0)?"),
    ("cc-by-nc", "cc by nc( [1-4] 0)?|creative commons attribution non ?commercial( [1-4] 0)?"),
    ("cc-by-nd", "cc by nd( [1-4] 0)?|creative commons attribution no ?derivatives( [1-4] 0)?"),
    ("cc-by-nc-sa", "cc by nc sa( [1-4] 0)?|creative commons attribution non ?commercial share ?alike( [1-4] 0)?"),
    ("cc-by-nc-nd", "cc by nc nd( [1-4] 0)?|creative commons attribution non ?commercial no ?derivatives( [1-4] 0)?"),
]

#: Sentences in which a name ({n}) declares a license: anchor, pattern, priority, confidence.
SENTENCES = [
    ("spdx", r"\|spdx license identifier ({n})", 95, 0.99),
    ("licensed", r"\|licensed under( the)?( terms of)?( the)? ({n})( licen[sc]e)?", 80, 0.95),
    ("released", r"\|released under( the)?( terms of)?( the)? ({n})( licen[sc]e)?", 80, 0.95),
    ("distributed", r"\|distributed under( the)?( terms of)?( the)? ({n})( licen[sc]e)?", 80, 0.95),
    ("license", r"(under|by)( the)?( terms of)?( the)? ({n}) \|license", 75, 0.9),
    ("license", r"({n}) \|license", 60, 0.8),
    ("licence", r"({n}) \|licence", 60, 0.8),
    ("license", r"\|license( is)? ({n})", 50, 0.7),
]

#: Rules of one license only: label, anchor, pattern, priority, confidence (fixed values).
SINGLE = [
    ("apache-2", "apache", r"\|apache license( version)? 2( 0)?", 85, 0.95),
    ("mit", "permission", r"\|permission is hereby granted free of charge to any person obtaining a copy", 90, 0.97),
    ("isc", "permission", r"\|permission to use copy modify and or distribute this software for any purpose", 90, 0.97),
    ("bsd", "redistributions", r"\|redistributions of source code must retain the above copyright notice", 70, 0.6),
    ("gpl", "general", r"gnu \|general public license", 55, 0.8),
    ("lgpl", "lesser", r"gnu \|lesser general public license", 65, 0.85),
    ("agpl", "affero", r"gnu \|affero general public license", 65, 0.85),
    ("gpl-2", "gplv2", r"\|gplv2", 45, 0.7),
    ("gpl-3", "gplv3", r"\|gplv3", 45, 0.7),
    ("cc-by-nc-sa", "cc", r"\|cc by nc sa( [1-4] 0)?", 72, 0.9),
    ("cc-by-nc-nd", "cc", r"\|cc by nc nd( [1-4] 0)?", 72, 0.9),
    ("cc-by-nc", "cc", r"\|cc by nc( [1-4] 0)?", 70, 0.9),
    ("cc-by-sa", "cc", r"\|cc by sa( [1-4] 0)?", 70, 0.9),
    ("cc-by-nd", "cc", r"\|cc by nd( [1-4] 0)?", 70, 0.9),
    ("cc-by", "cc", r"\|cc by( [1-4] 0)?", 65, 0.8),
    ("cc0", "cc0", r"\|cc0( 1 0)?( universal)?", 65, 0.8),
    ("proprietary", "rights", r"all \|rights reserved", 20, 0.4),
    ("public-domain", "domain", r"(in|into|to) the public \|domain", 30, 0.6),
    ("copyleft", "copyleft", r"\|copyleft", 10, 0.3),
]

#: Notices and texts whose wording says which license and which version it is: label, anchor, pattern, priority, confidence (fixed values).
NOTICES = [
    ("gpl-2", "version", r"(under( the)?( terms of)?( the)? )?gnu general public license( as published by the free software foundation)? either \|version 2", 92, 0.97),
    ("gpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu general public license( as published by the free software foundation)? either \|version 3", 92, 0.97),
    ("lgpl-2", "version", r"(under( the)?( terms of)?( the)? )?gnu (library|lesser) general public license( as published by the free software foundation)? either \|version 2", 92, 0.95),
    ("lgpl-2.1", "version", r"(under( the)?( terms of)?( the)? )?gnu lesser general public license( as published by the free software foundation)? either \|version 2 1", 93, 0.97),
    ("lgpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu lesser general public license( as published by the free software foundation)? either \|version 3", 92, 0.97),
    ("agpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu affero general public license( as published by the free software foundation)? either \|version 3", 92, 0.97),
    ("gpl-2", "version", r"\|version 2 of the gnu general public license", 90, 0.95),
    ("gpl-3", "version", r"\|version 3 of the gnu general public license", 90, 0.95),
    ("lgpl-2.1", "version", r"\|version 2 1 of the gnu lesser general public license", 90, 0.95),
    ("lgpl-3", "version", r"\|version 3 of the gnu lesser general public license", 90, 0.95),
    ("gpl-2", "version", r"(under( the)?( terms of)?( the)? )?gnu general public license( as published by the free software foundation)? \|version 2", 88, 0.95),
    ("gpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu general public license( as published by the free software foundation)? \|version 3", 88, 0.95),
    ("lgpl-2.1", "version", r"(under( the)?( terms of)?( the)? )?gnu lesser general public license( as published by the free software foundation)? \|version 2 1", 89, 0.95),
    ("lgpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu lesser general public license( as published by the free software foundation)? \|version 3", 88, 0.95),
    ("agpl-3", "version", r"(under( the)?( terms of)?( the)? )?gnu affero general public license( as published by the free software foundation)? \|version 3", 88, 0.95),
    ("gfdl", "documentation", r"gnu free \|documentation license", 85, 0.95),
    ("or-later", "later", r"version [1-3]( [0-9])?( of the license)? or( at your option)? any \|later version", 60, 0.9),
    ("mpl-2", "mozilla", r"\|mozilla public license( v| version)? 2( 0)?", 88, 0.97),
    ("mpl-1.1", "mozilla", r"\|mozilla public license( v| version)? 1 1", 89, 0.97),
    ("epl-1", "eclipse", r"\|eclipse public license (v1|v 1|version 1|1)( 0)?", 88, 0.97),
    ("epl-2", "eclipse", r"\|eclipse public license (v2|v 2|version 2|2)( 0)?", 88, 0.97),
    ("cddl-1", "cddl", r"common development and distribution license( the license)? \|cddl", 85, 0.95),
    ("cc-by", "creative", r"\|creative commons attribution [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc-by-sa", "creative", r"\|creative commons attribution share ?alike [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc-by-nd", "creative", r"\|creative commons attribution no ?deriv(ative)?s [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc-by-nc", "creative", r"\|creative commons attribution non ?commercial [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc-by-nc-sa", "creative", r"\|creative commons attribution non ?commercial share ?alike [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc-by-nc-nd", "creative", r"\|creative commons attribution non ?commercial no ?deriv(ative)?s [1-4] [05]( international| unported| generic)?( public)? licen[sc]e", 88, 0.97),
    ("cc0", "neighboring", r"waived all copyright and related or \|neighboring rights", 85, 0.95),
    ("zlib", "implied", r"provided as is without any express or \|implied warranty in no event will the authors", 90, 0.97),
    ("bsd-2-clause", "distribution", r"materials provided with the \|distribution this software is provided by", 90, 0.97),
    ("bsd-3-clause", "distribution", r"materials provided with the \|distribution( 3| c)? neither the names? of", 90, 0.97),
    ("bsd-4-clause", "advertising", r"all \|advertising materials mentioning features or use of this software", 91, 0.97),
    ("unlicense", "unencumbered", r"this is free and \|unencumbered software released into the public domain", 92, 0.97),
    ("artistic-2", "artistic", r"\|artistic license( version)? 2( 0)?", 85, 0.95),
    ("artistic-1", "artistic", r"\|artistic license( version)? 1( 0)?", 85, 0.95),
    ("boost-1", "boost", r"\|boost software license( version)? 1( 0)?", 88, 0.97),
    ("apache-1.1", "apache", r"\|apache software license version 1 1", 89, 0.97),
    ("ofl-1.1", "font", r"sil open \|font license( version)? 1 1", 88, 0.97),
    ("eupl-1.2", "eupl", r"european union public licen[sc]e( the)? \|eupl( v 1 2| v1 2| 1 2)?", 88, 0.97),
    ("ms-pl", "microsoft", r"\|microsoft public license( ms pl)?", 85, 0.95),
    ("wtfpl", "want", r"do what the fuck you \|want to public license", 88, 0.97),
]

#: Identifiers of the SPDX list as words, and their labels (fixed values).
SPDX = {
    "mit": "mit", "mit 0": "mit-0", "apache 2 0": "apache-2", "apache 1 1": "apache-1.1", "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause", "bsd 4 clause": "bsd-4-clause", "0bsd": "0bsd", "gpl 1 0": "gpl-1", "gpl 2 0": "gpl-2",
    "gpl 2 0 only": "gpl-2", "gpl 2 0 or later": "gpl-2,or-later", "gpl 3 0": "gpl-3", "gpl 3 0 only": "gpl-3", "gpl 3 0 or later": "gpl-3,or-later",
    "lgpl 2 0": "lgpl-2", "lgpl 2 0 only": "lgpl-2", "lgpl 2 0 or later": "lgpl-2,or-later", "lgpl 2 1": "lgpl-2.1", "lgpl 2 1 only": "lgpl-2.1",
    "lgpl 2 1 or later": "lgpl-2.1,or-later", "lgpl 3 0": "lgpl-3", "lgpl 3 0 only": "lgpl-3", "lgpl 3 0 or later": "lgpl-3,or-later",
    "agpl 3 0": "agpl-3", "agpl 3 0 only": "agpl-3", "agpl 3 0 or later": "agpl-3,or-later", "gfdl 1 3": "gfdl", "mpl 1 1": "mpl-1.1", "mpl 2 0": "mpl-2",
    "epl 1 0": "epl-1", "epl 2 0": "epl-2", "cddl 1 0": "cddl-1", "cpl 1 0": "cpl-1", "isc": "isc", "zlib": "zlib", "bsl 1 0": "boost-1",
    "artistic 1 0": "artistic-1", "artistic 2 0": "artistic-2", "python 2 0": "python-2", "postgresql": "postgresql", "openssl": "openssl", "wtfpl": "wtfpl",
    "unlicense": "unlicense", "ofl 1 1": "ofl-1.1", "ecl 2 0": "ecl-2", "eupl 1 2": "eupl-1.2", "ms pl": "ms-pl", "odbl 1 0": "odbl", "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "cc by nd 4 0": "cc-by-nd", "cc by nc sa 4 0": "cc-by-nc-sa", "cc by nc nd 4 0": "cc-by-nc-nd",
    "classpath exception 2 0": "classpath-exception", "llvm exception": "llvm-exception", "gcc exception 3 1": "gcc-exception", "linux syscall note": "linux-syscall-note",
}
SPDX_LINE = "spdx license identifier"

#: Words looked at before and after an anchor; no rule is longer on either side.
REACH = 20
BASE_CONFIDENCE, SPDX_CONFIDENCE = 0.95, 0.99


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, anchor, pattern, priority, confidence) in the order in which they are tried."""
    made = [(label, a, s.replace("{n}", n), p, c) for label, n in NAMES for a, s, p, c in SENTENCES]
    # A longer name goes first at equal priority, so that "cc by nc sa" is not taken for "cc by".
    return sorted(made + SINGLE + NOTICES, key=lambda r: (-r[3], -len(r[2]), r[0], r[2]))


def expression_labels(words: str):
    """Labels of the identifiers in SPDX expressions: one, or several joined by and, or, with."""
    known = "|".join(sorted(SPDX, key=lambda x: (-len(x), x)))
    line = f"(?<![^ ]){SPDX_LINE} ((?:{known})(?: (?:or|and|with) (?:{known}))*)(?![^ ])"
    found = F.flatten(F.transform(F.regexp_extract_all(words, F.lit(line), F.lit(1)), lambda e: F.regexp_extract_all(e, F.lit(f"(?<![^ ])({known})(?![^ ])"), F.lit(1))))
    label = F.create_map(*[F.lit(x) for pair in SPDX.items() for x in pair])
    each = F.flatten(F.transform(found, lambda x: F.split(label[x], ",")))
    return F.when(F.contains(words, F.lit(SPDX_LINE)), each).otherwise(F.array().cast("array<string>"))


@beside("text")
def scan(docs: DataFrame, rule_list: list | None = None) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score and ``detections``.

    ``labels`` also has those of whole SPDX expressions, and ``or-later``. ``detections`` is an array of (label, start, length, priority, confidence), in words. Null and empty texts have no
    words and no detection. Other columns pass
    through, whatever their names; rows are independent, so repeated rows are scanned each.
    """
    rule_list = rules() if rule_list is None else rule_list
    anchors = sorted({r[1] for r in rule_list})
    docs = docs.withColumn("_words", F.regexp_extract_all(lowered(F.col("text")), F.lit(PLAIN_WORD), 0))
    docs = docs.withColumn("_joined", F.array_join("_words", " ")).withColumn("n_words", F.size("_words").cast("long"))

    # Base phrases: a text is cut at each place of a phrase; the words before the first and after the last cut are counted.
    count = lambda x: F.regexp_count(x, F.lit("[^ ]+")).cast("long")
    for k, phrase in enumerate(PHRASES):
        pieces = F.split("_joined", f"(?<![^ ]){phrase}(?![^ ])", -1)
        docs = docs.withColumn(f"_p{k}", F.when(F.contains("_joined", F.lit(phrase)), pieces).otherwise(F.array("_joined")))
    each = [(f"_p{k}", p, label) for k, (p, label) in enumerate(PHRASES.items())]
    firsts = [F.when(F.size(c) > 1, count(F.get(c, F.lit(0)))) for c, _, _ in each]
    lasts = [F.when(F.size(c) > 1, F.col("n_words") - len(p.split()) - count(F.element_at(c, -1))) for c, p, _ in each]
    found = [F.when(F.size(c) > 1, F.lit(label)) for c, _, label in each]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    docs = docs.withColumns(
        {
            "n_base": sum((F.size(c) - 1 for c, _, _ in each), F.lit(0)).cast("long"),
            "first_word": F.least(*firsts),
            "last_word": F.greatest(*lasts),
            "_base": base,
        }
    )

    # Gate, then the rules of each anchor word, over the words around it.
    gate = F.regexp_like("_joined", F.lit(f"(?<![^ ])({'|'.join(anchors)})(?![^ ])"))
    keys = F.array(*[F.lit(a) for a in anchors])
    places = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.array_contains(keys, F.get("_words", i)))
    docs = docs.withColumn("_places", F.when((F.col("n_words") > 0) & gate, places))
    by_anchor = {}
    for label, anchor, pattern, priority, confidence in rule_list:
        entry = F.struct(
            F.lit(label).alias("label"), F.lit(f"(?<![^ ]){pattern}(?![^ ])").alias("pattern"),
            F.lit(priority).alias("priority"), F.lit(confidence).alias("confidence"),
        )
        by_anchor.setdefault(anchor, []).append(entry)
    rules_of = F.create_map(*[x for a, entries in by_anchor.items() for x in (F.lit(a), F.array(*entries))])

    def around(i):
        before = F.array_join(F.slice("_words", F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH))), " ")
        after = F.array_join(F.slice("_words", i + 1, REACH + 1), " ")
        return F.concat(before, F.when(i > 0, " ").otherwise(""), F.lit("|"), after)

    def first_rule(i):
        matched = F.filter(rules_of[F.get("_words", i)], lambda r: F.regexp_like(around(i), r["pattern"]))
        return F.struct(i.alias("place"), F.get(matched, F.lit(0)).alias("rule"), around(i).alias("words"))

    def detection(h):
        hit = F.regexp_substr(h["words"], h["rule"]["pattern"])
        left = F.length(F.regexp_replace(F.substring_index(hit, "|", 1), "[^ ]", ""))
        length = F.size(F.split(hit, " "))
        return F.struct(
            h["rule"]["label"].alias("label"), (h["place"] - left).alias("start"), length.alias("length"),
            h["rule"]["priority"].alias("priority"), h["rule"]["confidence"].alias("confidence"),
        )

    hits = F.filter(F.transform("_places", first_rule), lambda h: h["rule"].isNotNull())
    docs = docs.withColumn("_hits", F.transform(hits, detection))

    def suppressed(x, i):
        # One detection per place and REACH words at most on either side: only so many neighbours can contain this one.
        near = F.slice("_hits", F.greatest(i - 2 * REACH, F.lit(0)) + 1, 4 * REACH + 1)
        end = lambda d: d["start"] + d["length"]
        return F.exists(
            near,
            lambda y: (y["start"] <= x["start"]) & (end(y) >= end(x)) & (y["priority"] >= x["priority"])
            & ((y["length"] > x["length"]) | (y["priority"] > x["priority"])),
        )

    docs = docs.withColumn("detections", F.coalesce(F.filter("_hits", lambda x, i: ~suppressed(x, i)), F.filter("_hits", lambda x: F.lit(False)), F.array().cast("array<struct<label:string,start:int,length:int,priority:int,confidence:double>>")))
    docs = docs.withColumn("_spdx", expression_labels("_joined"))
    labels = F.array_sort(F.array_distinct(F.concat("_base", "_spdx", F.transform("detections", lambda d: d["label"]))))
    sure = F.when(F.size("_spdx") > 0, 1 - SPDX_CONFIDENCE).when(F.size("_base") > 0, 1 - BASE_CONFIDENCE).otherwise(1.0)
    doubt = F.aggregate("detections", sure, lambda a, d: F.least(a, 1 - d["confidence"]))
    docs = docs.withColumns({"base_labels": F.array_join("_base", ","), "labels": F.array_join(labels, ","), "score": 1 - doubt})
    return docs.drop("_words", "_joined", "_base", "_spdx", "_places", "_hits", *[c for c, _, _ in each])
