"""License scans: ordered signature rules over normalised words, with SQL functions alone.

A text becomes a line of lower-case words. Rules are regular expressions over that line; each
has a keyword that every match contains, a label, a priority and a confidence. A document is
joined to the rules of those keywords that its line contains, so the expressions run on few
documents only. Detections are intervals of words. One that lies within another of higher
priority (or of the same priority and longer) is suppressed; the three base phrases never are.

Defined results for odd input: null and empty texts have no words and no detection; very long
texts are scanned whole; equal rows get equal results each; an empty table gives an empty table.
Only id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.llm.common import row_key
from followgraph.llm.native_words import count_words, word_line


class Rule(NamedTuple):
    label: str
    pattern: str
    keyword: str
    priority: int
    confidence: float
    base: bool = False


#: Base phrases: always reported, never suppressed.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def _base_rules() -> list[Rule]:
    return [Rule(label, phrase, phrase, 1, 0.6, True) for phrase, label in BASE.items()]


def _creative_commons() -> list[Rule]:
    """Every variant and version of the licences, by their long and their short names."""
    variants = {
        "by": "attribution",
        "by-sa": "attribution share ?alike",
        "by-nc": "attribution non ?commercial",
        "by-nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
        "by-nc-sa": "attribution non ?commercial share ?alike",
        "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
    }
    versions = ["1 0", "2 0", "2 5", "3 0", "4 0"]
    rules = []
    for (short, long), version in product(variants.items(), versions):
        label = f"cc-{short}-{version.replace(' ', '.')}"
        words = short.replace("-", " ")
        rules.append(Rule(label, f"cc {words} {version}", "cc by", 9, 0.99))
        rules.append(Rule(label, f"creative commons {long} {version}", "creative commons", 9, 0.99))
        rules.append(Rule(label, f"creativecommons org licenses {words} {version}", "creativecommons", 9, 1.0))
    for short, long in variants.items():
        words = short.replace("-", " ")
        rules.append(Rule(f"cc-{short}", f"cc {words}", "cc by", 6, 0.85))
        rules.append(Rule(f"cc-{short}", f"creative commons {long}", "creative commons", 6, 0.9))
    rules.append(Rule("cc0-1.0", "cc0(?: 1 0)?(?: universal)?", "cc0", 8, 0.95))
    rules.append(Rule("creative-commons", "creative commons(?: licen[cs]es?)?", "creative commons", 2, 0.5))
    return rules


def _gnu() -> list[Rule]:
    """General, lesser and Affero licences by version, named in full or by letters."""
    families = {
        "gpl": ("(?:gnu )?general public licen[cs]e", "general public", ["1", "2", "3"]),
        "lgpl": ("(?:gnu )?(?:lesser|library) general public licen[cs]e", "general public", ["2", "2 1", "3"]),
        "agpl": ("(?:gnu )?affero general public licen[cs]e", "affero", ["1", "3"]),
    }
    rules = []
    for name, (full, keyword, versions) in families.items():
        for version in versions:
            dotted = version.replace(" ", ".")
            zero = "" if " " in version else "(?: 0)?"
            label = f"{name}-{dotted if '.' in dotted else dotted + '.0'}"
            tail = f"(?: v| version| v ersion)? ?{version}{zero}"
            rules += [
                Rule(label, f"{full}{tail}", keyword, 8, 0.98),
                Rule(f"{label}-or-later", f"{full}{tail} or(?: at your option)?(?: any)? later(?: version)?", keyword, 9, 0.98),
                Rule(f"{label}-or-later", f"{full} either{tail} of the licen[cs]e or(?: at your option)?(?: any)? later", keyword, 9, 0.99),
                Rule(label, f"{name} ?v?{version}{zero}(?: only)?", name, 8, 0.93),
                Rule(f"{label}-or-later", f"{name} ?v?{version}{zero} or later", name, 9, 0.95),
            ]
        rules.append(Rule(name, f"(?:gnu )?{name}(?: licen[cs]ed?)?", name, 3, 0.7))
        rules.append(Rule(name, full, keyword, 5, 0.8))
    return rules


def _named() -> list[Rule]:
    """Other licences: each name under the customary phrases around it."""
    names = {
        "apache-2.0": ("apache(?: software)?(?: licen[cs]e)?(?: version)? v?2(?: 0)?", "apache"),
        "apache-1.1": ("apache(?: software)? licen[cs]e(?: version)? 1 1", "apache"),
        "apache-1.0": ("apache(?: software)? licen[cs]e(?: version)? 1 0", "apache"),
        "apache": ("apache(?: software)? licen[cs]e", "apache"),
        "mit": ("(?:the )?mit(?: x11)? licen[cs]e", "mit licen|mit x11"),
        "x11": ("x11 licen[cs]e", "x11"),
        "bsd-2-clause": ("(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd licen[cs]e", "bsd"),
        "bsd-3-clause": ("(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd", "bsd"),
        "bsd-4-clause": ("(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd", "bsd"),
        "bsd": ("bsd(?: style)? licen[cs]e", "bsd"),
        "isc": ("isc licen[cs]e", "isc licen"),
        "mpl-2.0": ("mozilla public licen[cs]e(?: version)? v?2(?: 0)?|mpl 2 0", "mpl 2|mozilla"),
        "mpl-1.1": ("mozilla public licen[cs]e(?: version)? v?1 1|mpl 1 1", "mpl 1|mozilla"),
        "mpl": ("mozilla public licen[cs]e", "mozilla"),
        "epl-2.0": ("eclipse public licen[cs]e(?: version)? v?2(?: 0)?", "eclipse"),
        "epl-1.0": ("eclipse public licen[cs]e(?: version)? v?1(?: 0)?", "eclipse"),
        "cddl-1.1": ("common development and distribution licen[cs]e(?: version)? 1 1", "common development"),
        "cddl-1.0": ("common development and distribution licen[cs]e(?: version)?(?: 1 0)?", "common development"),
        "eupl-1.2": ("european union public licen[cs]e(?: v| version)? ?1 2", "european union"),
        "eupl": ("european union public licen[cs]e", "european union"),
        "artistic-2.0": ("artistic licen[cs]e(?: version)? 2(?: 0)?", "artistic"),
        "artistic": ("artistic licen[cs]e", "artistic"),
        "zlib": ("zlib(?: libpng)? licen[cs]e", "zlib"),
        "bsl-1.0": ("boost software licen[cs]e", "boost"),
        "ofl-1.1": ("(?:sil )?open font licen[cs]e", "open font"),
        "psf-2.0": ("python software foundation licen[cs]e", "python software"),
        "postgresql": ("postgresql licen[cs]e", "postgresql"),
        "php-3.01": ("php licen[cs]e", "php licen"),
        "ruby": ("ruby licen[cs]e", "ruby"),
        "unlicense": ("(?:the )?unlicense", "unlicense"),
        "wtfpl": ("wtfpl|do what the fuck you want to public licen[cs]e", "wtfpl|do what the"),
        "odbl": ("open database licen[cs]e", "open database"),
        "gfdl": ("(?:gnu )?free documentation licen[cs]e", "free documentation"),
        "ms-pl": ("microsoft public licen[cs]e", "microsoft"),
        "ms-rl": ("microsoft reciprocal licen[cs]e", "microsoft"),
        "cecill": ("cecill(?: b| c)?", "cecill"),
        "bsl-1.1": ("business source licen[cs]e", "business source"),
        "sspl-1.0": ("server side public licen[cs]e", "server side"),
        "elastic-2.0": ("elastic licen[cs]e", "elastic"),
        "public-domain": ("(?:in|into|to) the public domain|public domain", "public domain"),
    }
    around = [
        ("", 5, 0.8),
        ("licen[cs]ed under(?: the terms of)?(?: the| a)? ", 7, 0.97),
        ("released under(?: the terms of)?(?: the| a)? ", 7, 0.97),
        ("(?:distributed|available|published|provided) under(?: the terms of)?(?: the| a)? ", 7, 0.95),
        ("spdx licen[cs]e identifier ", 9, 1.0),
    ]
    rules = []
    for (label, (name, keywords)), (before, priority, confidence) in product(names.items(), around):
        exact = 1 if any(c.isdigit() for c in label) else 0
        for keyword in keywords.split("|"):
            rules.append(Rule(label, f"{before}(?:{name})", keyword, priority + exact, confidence))
    return rules


def _statements() -> list[Rule]:
    """Sentences of licence texts, and statements of ownership."""
    found = [
        ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 9, 1.0),
        ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission to use", 9, 1.0),
        ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 8, 0.97),
        ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors", "neither the name", 9, 0.95),
        ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 9, 1.0),
        ("zlib", "this software is provided as is without any express or implied warranty", "express or implied", 6, 0.7),
        ("gpl", "this program is free software you can redistribute it and or modify it", "free software", 7, 0.9),
        ("proprietary", "proprietary and confidential|confidential and proprietary", "proprietary", 6, 0.9),
        ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori", 6, 0.85),
        ("copyright", "copyright(?: c)?(?: [12][0-9]{3})+", "copyright", 4, 0.6),
        ("copyright", "copyright", "copyright", 1, 0.3),
        ("reserved", "some rights reserved", "rights reserved", 4, 0.6),
    ]
    return [Rule(*x) for x in found]


def rules() -> list[Rule]:
    """All rules, the strongest first."""
    return sorted(
        _base_rules() + _creative_commons() + _gnu() + _named() + _statements(), key=lambda r: (-r.priority, r.label, r.pattern)
    )


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(docs: DataFrame, id_column: str = "doc_id", text: str = "text", use: list[Rule] | None = None) -> DataFrame:
    """Rows (key, label, first, last, priority, confidence, base): word places of every match,
    ends included, before suppression. `key` is the row_key of the document."""
    spark: SparkSession = docs.sparkSession
    use = rules() if use is None else use
    table = spark.createDataFrame(
        [(r.keyword, r.label, f"(?<= )(?:{r.pattern})(?= )", r.priority, r.confidence, r.base) for r in use],
        "keyword string, label string, pattern string, priority int, confidence double, base boolean",
    )
    keywords = sorted({r.keyword for r in use})
    lines = docs.select(row_key(F.col(id_column), F.col(text)).alias("key"), word_line(F.col(text)).alias("line"))
    # equal rows have one key and one line: their detections are the same and are counted once
    present = F.filter(F.array(*[F.when(F.contains("line", F.lit(k)), F.lit(k)) for k in keywords]), lambda k: k.isNotNull())
    gated = lines.select("key", "line", F.explode(present).alias("keyword"))
    matched = (
        gated.join(F.broadcast(table), "keyword")
        .select(
            "key", "label", "priority", "confidence", "base",
            F.regexp_extract_all("line", F.col("pattern"), 0).alias("found"),
            F.call_function("split", F.col("line"), F.col("pattern")).alias("gaps"),
        )
        .where(F.size("found") > 0)
    )
    # a match's first word: the blanks before it, less the one that opens the line
    before = F.transform("gaps", lambda g: _blanks(g))
    within = F.transform("found", lambda m: _blanks(m))

    def total(values: Column, n: Column) -> Column:
        return F.aggregate(F.slice(values, F.lit(1), n), F.lit(0), lambda a, v: a + v)

    places = F.transform(
        "found",
        lambda m, i: F.struct(
            (total(F.col("before"), i + 1) + total(F.col("within"), i) - 1).alias("first"), _blanks(m).alias("more")
        ),
    )
    return (
        matched.withColumns({"before": before, "within": within})
        .select("key", "label", "priority", "confidence", "base", F.explode(places).alias("at"))
        .select("key", "label", "priority", "confidence", "base", F.col("at.first").alias("first"), (F.col("at.first") + F.col("at.more")).alias("last"))
        .distinct()
    )


def _suppressed(d: Column, others: Column) -> Column:
    """Whether d lies within another detection of more priority, or of the same and longer."""
    return ~d["base"] & F.exists(
        others,
        lambda o: (o["first"] <= d["first"])
        & (o["last"] >= d["last"])
        & ((o["priority"] > d["priority"]) | ((o["priority"] == d["priority"]) & (o["last"] - o["first"] > d["last"] - d["first"]))),
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", use: list[Rule] | None = None) -> DataFrame:
    """id, n_words, detections (what is left after suppression) of every document."""
    fields = ["first", "last", "label", "priority", "confidence", "base"]
    found = (
        detections(docs, id_column, text, use)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("all"))
        .select("key", F.filter("all", lambda d: ~_suppressed(d, F.col("all"))).alias("detections"))
    )
    every = docs.select(
        F.col(id_column), row_key(F.col(id_column), F.col(text)).alias("key"), count_words(F.col(text)).alias("n_words")
    )
    return every.join(found, "key", "left").select(id_column, "n_words", "detections")
