"""License scans by ordered signature rules, with built-in functions only.

Every rule is a regular expression with a label, a priority and a keyword that all its matches hold. Only the rules run
whose keyword the text contains. The detections of a text, with their places, are then resolved: a detection is
suppressed if one of a higher priority overlaps it, or one of the same priority contains it, so that ``CC BY-NC 4.0``
does not also report ``CC BY``.

Rules are composed from the tables below: names of licenses, the ways to write their versions, and the notices that
mention them, a few hundred expressions in all. They run on a text in lower case with single blanks.

The base phrases are found word by word, independent of the rules, and their labels are never suppressed.

Everything happens inside the row: no exchange, so no key can be hot. Nulls: a null text is an empty one, with no
words. Repeated rows and ties of detections get equal results: at equal places and priority all labels stay. Other
columns are not needed. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.llm.words import PLAIN_WORD, lower_ascii

# Phrases and labels. Fixed values.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Words of license notices. No gate: ``apache 2.0`` holds none of them.
ANCHORS = (
    "licen copyright domain rights spdx cc0 commons permission redistribution unencumbered proprietary (c)".split()
    + ["under", "subject to", "covered by", "governed by", "cc by", "cc-by", "cc\nby"]
)

# Label, keyword, name as an expression, versions.
FAMILIES = (
    ("apache", "apache", r"apache(?: software)?", ("1.0", "1.1", "2.0")),
    ("agpl", "affero", r"(?:gnu )?affero general public", ("1.0", "3.0")),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", ("2.1", "3.0")),
    ("lgpl", "library general", r"(?:gnu )?library general public", ("2.0",)),
    ("gpl", "general public", r"(?:gnu )?general public", ("1", "2", "2.0", "3", "3.0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", ("1.1", "1.2", "1.3")),
    ("mit", "mit", r"mit", ()),
    ("bsd", "bsd", r"bsd", ()),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd[ -]?2[ -]clause|2[ -]clause bsd)", ()),
    ("bsd-3-clause", "bsd", r"(?:(?:new|modified) bsd|bsd[ -]?3[ -]clause|3[ -]clause bsd)", ()),
    ("mpl", "mozilla", r"mozilla public", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", r"eclipse public", ("1.0", "2.0")),
    ("cddl", "common development", r"common development and distribution", ("1.0", "1.1")),
    ("cpl", "common public", r"common public", ("1.0",)),
    ("artistic", "artistic", r"artistic", ("1.0", "2.0")),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?:/libpng)?", ()),
    ("boost", "boost", r"boost software", ("1.0",)),
    ("unlicense", "unlicense", r"unlicense", ()),
    ("wtfpl", "do what the", r"do what the f\S{1,4} you want to public", ("1", "2")),
    ("openssl", "openssl", r"openssl", ()),
    ("php", "php", r"php", ("3.0", "3.01")),
    ("psf", "python", r"python(?: software foundation)?", ("2", "2.0")),
    ("ruby", "ruby", r"ruby", ()),
    ("ofl", "open font", r"(?:sil )?open font", ("1.0", "1.1")),
    ("eupl", "european union", r"european union public", ("1.1", "1.2")),
    ("ms-pl", "microsoft public", r"microsoft public", ()),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal", ()),
    ("odbl", "open database", r"(?:odc )?open database", ("1.0",)),
    ("odc-by", "open data commons", r"open data commons attribution", ("1.0",)),
    ("osl", "open software", r"open software", ("2.0", "2.1", "3.0")),
    ("afl", "academic free", r"academic free", ("2.0", "2.1", "3.0")),
    ("cecill", "cecill", r"cecill(?:-[abc])?", ("1.0", "2.0", "2.1")),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", ()),
    ("vim", "vim", r"vim", ()),
    ("upl", "universal permissive", r"universal permissive", ("1.0",)),
    ("blueoak", "blue oak", r"blue oak model", ("1.0.0",)),
    ("busl", "business source", r"business source", ("1.1",)),
    ("sspl", "server side public", r"server side public", ("1",)),
    ("agpl", "agpl", r"(?:gnu )?agpl-?", ("1.0", "3", "3.0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl-?", ("2", "2.0", "2.1", "3", "3.0")),
    ("gpl", "gpl", r"(?:gnu )?gpl-?", ("1", "2", "2.0", "3", "3.0")),
    ("gfdl", "fdl", r"(?:gfdl|gnu fdl)-?", ("1.1", "1.2", "1.3")),
    ("mpl", "mpl", r"mpl-?", ("1.0", "1.1", "2.0")),
    ("epl", "epl", r"epl-?", ("1.0", "2.0")),
    ("cddl", "cddl", r"cddl-?", ("1.0", "1.1")),
    ("eupl", "eupl", r"eupl-?", ("1.1", "1.2")),
)
# Notices; the name takes the braces. The second number is the priority, the third whether "license" must follow.
NOTICES = (
    (r"(?:re)?(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?{}", 4, False),
    (r"(?:subject to|covered by|governed by) (?:the )?(?:terms of (?:the )?)?{}", 3, True),
    (r"license: ?{}", 3, False),
    (r"{}", 2, True),
)
# Creative Commons elements, long names and versions.
CC_CODES = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_NAMES = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?", "nc": "non-?commercial"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
SPDX = {
    "apache": ("apache-2.0", "apache-1.1"),
    "mit": ("mit", "mit-0"),
    "gpl": ("gpl-2.0", "gpl-3.0"),
    "lgpl": ("lgpl-2.1", "lgpl-3.0"),
    "agpl": ("agpl-3.0",),
    "bsd-2-clause": ("bsd-2-clause",),
    "bsd-3-clause": ("bsd-3-clause",),
    "mpl": ("mpl-2.0",),
    "isc": ("isc",),
    "unlicense": ("unlicense",),
    "epl": ("epl-2.0", "epl-1.0"),
    "cc0": ("cc0-1.0",),
}
# Label, keyword, expression, priority: notices that name no license.
PLAIN = (
    ("copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d", 1),
    ("copyright", "copyright", r"copyright (?:by|notice|holders?)", 1),
    ("copyright", "(c)", r"\(c\) (?:19|20)\d\d", 1),
    ("reserved", "all rights", r"all rights reserved", 2),
    ("reserved", "some rights", r"some rights reserved", 1),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 4),
    ("public-domain", "public domain", r"(?:is|are) in the public domain", 3),
    ("cc0", "cc0", r"cc0(?: ?1\.0)?", 3),
    ("cc0", "creative commons", r"creative commons (?:zero|cc0)(?: ?1\.0)?", 4),
    ("cc", "creative commons", r"creative commons license", 1),
    ("proprietary", "proprietary", r"proprietary (?:license|and confidential)", 3),
    ("no-reuse", "permission", r"may not be (?:reproduced|copied|distributed)[^.]{0,80} without [^.]{0,40}permission", 3),
    ("mit", "permission", r"permission is hereby granted, free of charge, to any person", 4),
    ("isc", "permission", r"permission to use, copy, modify, and(?:/or)? distribute this software", 4),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms", 4),
    ("unlicense", "unencumbered", r"this is free and unencumbered software", 4),
)
# How sure a detection of a priority is; the base phrases count as 0.6.
CERTAINTY = {1: 0.3, 2: 0.6, 3: 0.8, 4: 0.95}
BASE_CERTAINTY = 0.6


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    expression: str
    priority: int


def _versioned(version: str) -> str:
    return rf",? ?(?:version |v\.? ?)?{version.replace('.', chr(92) + '.')}"


def _bounded(expression: str) -> str:
    return rf"(?<![\p{{L}}\p{{N}}]){expression}(?![\p{{L}}\p{{N}}])"


def rules() -> list[Rule]:
    found = [Rule(label, keyword, _bounded(x), p) for label, keyword, x, p in PLAIN]
    for label, keyword, name, versions in FAMILIES:
        for notice, priority, needs in NOTICES:
            said = notice.format(name)
            found.append(Rule(label, keyword, _bounded(said + (" licen[cs]e" if needs else "(?: licen[cs]e)?")), priority))
            found += [
                Rule(f"{label}-{v}", keyword, _bounded(said + "(?: licen[cs]e)?" + _versioned(v)), priority)
                for v in versions
            ]
    for code in CC_CODES:
        long_name = "[ -]".join(CC_NAMES[part] for part in code.split("-"))
        shorts = [(f"cc{mark}by", rf"cc{mark}{code.replace('-', '[ -]')}") for mark in " -"]
        long_form = rf"creative commons {long_name}"
        found += [Rule(f"cc-{code}", keyword, _bounded(short), 2) for keyword, short in shorts]
        found.append(Rule(f"cc-{code}", "creative commons", _bounded(long_form), 2))
        for v in CC_VERSIONS:
            found += [Rule(f"cc-{code}-{v}", keyword, _bounded(short + _versioned(v)), 3) for keyword, short in shorts]
            tail = "(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"
            found.append(Rule(f"cc-{code}-{v}", "creative commons", _bounded(long_form + _versioned(v) + tail), 3))
    for label, codes in SPDX.items():
        for code in codes:
            named = code.replace(".", r"\.")
            found.append(Rule(label, "spdx", _bounded(rf"spdx-license-identifier: ?{named}(?:-only|-or-later)?"), 4))
    return found


def _places(text: Column, rule: Column) -> Column:
    """Start, end, priority and label of all matches of a rule."""
    hits = F.regexp_extract_all(text, rule["expression"], F.lit(0))
    gaps = F.split(text, rule["expression"], -1)
    lengths = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(h), F.lit(0)).alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,back:int,rank:int,label:string>>").alias("found"))
    return F.aggregate(
        lengths,
        start,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"),
            F.when(
                x["hit"] > 0,
                F.concat(
                    acc["found"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (-(acc["at"] + x["gap"] + x["hit"])).alias("back"),
                            (-rule["priority"]).alias("rank"),
                            rule["label"].alias("label"),
                        )
                    ),
                ),
            ).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: acc["found"],
    )


def _resolved(detections: Column) -> Column:
    """Labels of the detections that stay, and how many stay of each priority.

    Two passes over the detections in order of start, longest first. The first goes backwards and marks what a later
    one of a higher priority overlaps; the second goes forwards and drops what an earlier one of a higher priority
    overlaps or one of the same priority contains.
    """
    top = max(CERTAINTY)
    far = 2**31 - 1
    numbers = "array<int>"

    def mark(acc: Column, d: Column) -> Column:
        end, priority = -d["back"], -d["rank"]
        # starts[p - 1]: the nearest start, among those seen, with priority p or higher.
        above = F.when(priority < top, F.element_at(acc["starts"], F.least(priority + 1, F.lit(top))) < end)
        marked = F.struct(
            d["start"].alias("start"), end.alias("end"), priority.alias("priority"), d["label"].alias("label"),
            F.coalesce(above, F.lit(False)).alias("over"),
        )
        starts = F.transform(acc["starts"], lambda s, i: F.when(i < priority, F.least(s, d["start"])).otherwise(s))
        return F.struct(starts.alias("starts"), F.concat(F.array(marked), acc["marked"]).alias("marked"))

    empty = F.array().cast("array<struct<start:int,end:int,priority:int,label:string,over:boolean>>")
    begin = F.struct(F.array(*(F.lit(far) for _ in range(top))).cast(numbers).alias("starts"), empty.alias("marked"))
    marked = F.aggregate(F.reverse(F.sort_array(detections)), begin, mark, lambda acc: acc["marked"])

    def step(acc: Column, d: Column) -> Column:
        priority = d["priority"]
        same = (d["start"] == acc["start"]) & (d["end"] == acc["end"]) & (priority == acc["priority"])
        # ends[p - 1]: the furthest end of the detections before with priority p; over: with a higher one.
        inside = d["end"] <= F.element_at(acc["ends"], priority)
        higher = F.array_max(F.transform(acc["ends"], lambda e, i: F.when(i >= priority, e).otherwise(F.lit(-1))))
        kept = F.when(same, acc["kept"]).otherwise(~inside) & ~(d["over"] | (d["start"] < higher))
        ends = F.transform(
            acc["ends"], lambda e, i: F.when(i == priority - 1, F.greatest(e, d["end"])).otherwise(e)
        )
        counts = F.transform(acc["counts"], lambda c, i: F.when(kept & (i == priority - 1), c + 1).otherwise(c))
        labels = F.when(kept, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"])
        return F.struct(
            ends.alias("ends"), d["start"].alias("start"), d["end"].alias("end"), priority.alias("priority"),
            F.when(same, acc["kept"]).otherwise(~inside).alias("kept"), labels.alias("labels"), counts.alias("counts"),
        )

    first = F.struct(
        F.array(*(F.lit(-1) for _ in range(top))).cast(numbers).alias("ends"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.lit(0).alias("priority"), F.lit(False).alias("kept"),
        F.array().cast("array<string>").alias("labels"),
        F.array(*(F.lit(0) for _ in range(top))).cast(numbers).alias("counts"),
    )
    return F.aggregate(marked, first, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["counts"].alias("counts")))


def _phrase_starts(words: Column, phrase: str) -> Column:
    """Places, from 0, where the words of a phrase stand consecutively."""
    parts = phrase.split()
    places = F.when(F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts))).otherwise(
        F.array().cast("array<int>")
    )

    def stands(i: Column) -> Column:
        found = F.element_at(words, i + 1) == parts[0]
        for k, part in enumerate(parts[1:], 2):
            found = found & (F.element_at(words, i + k) == part)
        return found

    return F.filter(places, stands)


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per document."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", text.alias("text"), F.lower(text).alias("low"))
    own = own.withColumn("n_words", F.regexp_count("text", F.lit(PLAIN_WORD)).cast("bigint"))
    # The full lower case contains all that the lower case of A-Z does.
    base_gate = F.lit(False)
    for phrase, _ in BASE:
        all_words = F.lit(True)
        for word in phrase.split():
            all_words = all_words & F.contains("low", F.lit(word))
        base_gate = base_gate | all_words
    none = F.array().cast("array<string>")
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(PLAIN_WORD), F.lit(0))
    own = own.withColumn("words", F.when(base_gate, words).otherwise(none))
    for k, (phrase, _) in enumerate(BASE):
        own = own.withColumn(f"at{k}", F.when(base_gate, _phrase_starts(F.col("words"), phrase)))
    starts = F.flatten(F.array(*(F.coalesce(f"at{k}", F.array().cast("array<int>")) for k in range(len(BASE)))))
    labels = F.array(*(F.when(F.size(f"at{k}") > 0, label) for k, (_, label) in enumerate(BASE)))
    labels = F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull())))
    by_keyword: dict[str, list[Rule]] = {}
    for rule in rules():
        by_keyword.setdefault(rule.keyword, []).append(rule)
    every = F.array(
        *(
            F.struct(
                F.lit(keyword).alias("keyword"),
                F.array(
                    *(
                        F.struct(
                            F.lit(r.label).alias("label"), F.lit(r.expression).alias("expression"),
                            F.lit(r.priority).alias("priority"),
                        )
                        for r in own_rules
                    )
                ).alias("rules"),
            )
            for keyword, own_rules in by_keyword.items()
        )
    )
    own = own.withColumn("flat", F.regexp_replace("low", r"\s+", " "))
    chosen = F.filter(every, lambda g: F.contains("flat", g["keyword"]))
    chosen = F.flatten(F.transform(chosen, lambda g: g["rules"]))
    own = own.withColumn("chosen", chosen)
    detections = F.flatten(F.transform("chosen", lambda r: _places(F.col("flat"), r)))
    own = own.withColumn("method", F.when(F.size("chosen") > 0, _resolved(detections)))
    own = own.select("doc_id", "n_words", starts.alias("starts"), labels.alias("base"), "method")
    doubt = F.pow(F.lit(1 - BASE_CERTAINTY), F.size("starts"))
    for priority, certainty in CERTAINTY.items():
        doubt = doubt * F.pow(F.lit(1 - certainty), F.coalesce(F.element_at("method.counts", priority), F.lit(0)))
    both = F.array_sort(F.array_union("base", F.coalesce("method.labels", none)))
    return own.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").cast("bigint").alias("first_word"),
        F.array_max("starts").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        (1 - doubt).alias("score"),
    )
