"""License scan by ordered signature rules.

Rules are regular expressions over a text's words (lower-cased runs of letters and digits, a blank
before each). A rule is tried only on texts that hold its keyword, a word of its every match. A detection that lies within one
of the same or a better priority is suppressed; the base phrases are reported in any case. Spark's
own functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.matches import located

WORD = r"0-9A-Za-z\x{80}-\x{10FFFF}"
NULL_ID = -(1 << 63)
#: Priorities, the best first, and the confidence of a detection.
TAG, TITLE, MENTION = 0, 1, 2
CONFIDENCE = {TAG: 1.0, TITLE: 0.9, MENTION: 0.6}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


#: Phrases that are reported wherever their words stand.
BASE = (
    Rule("cc-by", "cc", "cc by", MENTION, True),
    Rule("gpl", "license", "general public license", MENTION, True),
    Rule("reserved", "reserved", "all rights reserved", MENTION, True),
)

#: Licences: label, words of the title as a pattern, name in a machine-readable tag as a pattern.
LICENSES = (
    ("apache-1.0", r"apache(?: software)? license(?: version)? 1 0", "apache 1 0"),
    ("apache-1.1", r"apache(?: software)? license(?: version)? 1 1", "apache 1 1"),
    ("apache-2.0", r"apache(?: software)? license(?: version)? (?:2 0|2|v2)", "apache 2 0"),
    ("mit", r"mit license", "mit"),
    ("mit-0", r"mit no attribution(?: license)?", "mit 0"),
    ("x11", r"x11 license", "x11"),
    ("isc", r"isc license", "isc"),
    ("0bsd", r"(?:zero clause|0 clause) bsd license|bsd zero clause license", "0bsd"),
    ("bsd-2-clause", r"(?:simplified|freebsd|2 clause|two clause)(?: bsd)? license|bsd 2 clause(?: license)?", "bsd 2 clause"),
    ("bsd-3-clause", r"(?:modified|revised|new|3 clause|three clause) bsd license|bsd 3 clause(?: license)?", "bsd 3 clause"),
    ("bsd-4-clause", r"(?:original|old|4 clause|four clause) bsd license|bsd 4 clause(?: license)?", "bsd 4 clause"),
    ("gpl-1.0", r"(?:gnu )?general public license(?: gpl)?(?: version| v)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", r"(?:gnu )?general public license(?: gpl)?(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", r"(?:gnu )?general public license(?: gpl)?(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", r"(?:gnu )?library general public license(?: version| v)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public license(?: version| v)? ?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", r"(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", r"(?:gnu )?free documentation license", "gfdl 1 [123](?: only| or later)?"),
    ("mpl-1.0", r"mozilla public license(?: version| v)? ?1 0", "mpl 1 0"),
    ("mpl-1.1", r"mozilla public license(?: version| v)? ?1 1", "mpl 1 1"),
    ("mpl-2.0", r"mozilla public license(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", r"eclipse public license(?: version| v)? ?1 0", "epl 1 0"),
    ("epl-2.0", r"eclipse public license(?: version| v)? ?2 0", "epl 2 0"),
    ("cpl-1.0", r"common public license(?: version| v)? ?1 0", "cpl 1 0"),
    ("ipl-1.0", r"ibm public license(?: version| v)? ?1 0", "ipl 1 0"),
    ("cddl-1.0", r"common development and distribution license(?: version| v)? ?1 0", "cddl 1 0"),
    ("cddl-1.1", r"common development and distribution license(?: version| v)? ?1 1", "cddl 1 1"),
    ("eupl-1.1", r"european union public licen[cs]e(?: version| v)? ?1 1", "eupl 1 1"),
    ("eupl-1.2", r"european union public licen[cs]e(?: version| v)? ?1 2", "eupl 1 2"),
    ("artistic-1.0", r"artistic license(?: version)? 1 0", "artistic 1 0"),
    ("artistic-2.0", r"artistic license(?: version)? 2 0", "artistic 2 0"),
    ("boost-1.0", r"boost software license(?: version)? 1 0", "bsl 1 0"),
    ("busl-1.1", r"business source license(?: version)? 1 1", "busl 1 1"),
    ("zlib", r"zlib license", "zlib"),
    ("libpng", r"libpng license", "libpng(?: 2 0)?"),
    ("unlicense", r"unlicense license|the unlicense", "unlicense"),
    ("wtfpl", r"do what the \S+ you want to public license", "wtfpl"),
    ("openssl", r"openssl license", "openssl"),
    ("php-3.01", r"php license(?: version)? 3 0(?:1)?", "php 3 0(?:1)?"),
    ("python-2.0", r"python software foundation license|psf license", "(?:python|psf) 2 0"),
    ("ruby", r"ruby license", "ruby"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("curl", r"curl license", "curl"),
    ("ms-pl", r"microsoft public license", "ms pl"),
    ("ms-rl", r"microsoft reciprocal license", "ms rl"),
    ("ofl-1.1", r"(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("odbl-1.0", r"open (?:data commons open )?database license", "odbl 1 0"),
    ("odc-by", r"open data commons attribution license", "odc by 1 0"),
    ("pddl-1.0", r"public domain dedication and license", "pddl 1 0"),
    ("sspl-1.0", r"server side public license", "sspl 1 0"),
    ("elastic-2.0", r"elastic license(?: 2 0)?", "elastic 2 0"),
    ("upl-1.0", r"universal permissive license", "upl 1 0"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? license", "ncsa"),
    ("afl-3.0", r"academic free license", "afl [123] [01]"),
    ("osl-3.0", r"open software license", "osl [123] [01]"),
    ("mulan-2.0", r"mulan permissive software license", "mulanpsl 2 0"),
    ("vim", r"vim license", "vim"),
    ("w3c", r"w3c software(?: notice)?(?: and)? license", "w3c"),
    ("openrail", r"(?:bigscience |creativeml )?open rail(?: m)? license", "(?:bigscience |creativeml )?openrail(?: m)?"),
    ("cc0-1.0", r"cc0 1 0(?: universal)?|creative commons zero(?: license)?", "cc0 1 0"),
)
#: Creative Commons: the parts of a name, with their words in a title.
ELEMENTS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ative works|s|atives)", "sa": "share ?alike"}
ATTRIBUTIONS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
ATTRIBUTION_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Turns of phrase that tell rights without a licence's name: label, keyword, pattern.
PHRASES = (
    ("public-domain", "domain", r"(?:released into|in|dedicated to) the public domain"),
    ("public-domain", "domain", r"public domain (?:work|dedication|mark)"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "prohibited", r"unauthori[sz]ed (?:copying|use|reproduction|distribution) (?:\S+ ){0,8}prohibited"),
    ("proprietary", "permission", r"(?:no part|may not be (?:copied|reproduced|distributed)) (?:\S+ ){0,12}without (?:\S+ ){0,4}permission"),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*"),
    ("copyright", "copyright", r"copyright holders?"),
    ("permissive", "permission", r"permission is hereby granted free of charge"),
    ("permissive", "redistribution", r"redistribution and use in source and binary forms"),
    ("permissive", "warranty", r"provided as is without (?:\S+ ){0,3}warranty"),
    ("copyleft", "copyleft", r"copyleft"),
    ("free-software", "software", r"this program is free software"),
    ("free-software", "redistribute", r"you can redistribute it and or modify it"),
    ("source-available", "source", r"source available license"),
    ("non-commercial", "commercial", r"for non commercial (?:use|purposes)(?: only)?"),
    ("non-commercial", "noncommercial", r"for noncommercial (?:use|purposes)(?: only)?"),
    ("attribution", "attribution", r"attribution (?:is )?required"),
    ("no-license", "license", r"no license (?:is )?granted"),
    ("licensed", "licensed", r"licensed under the terms of"),
    ("spdx", "spdx", r"spdx license identifier"),
)


def rules() -> list[Rule]:
    """All rules in their order."""
    found = list(BASE)
    for label, title, tag in LICENSES:
        spellings = [title.replace("licen[cs]e", w) for w in ("license", "licence")] if "licen[cs]e" in title else [title]
        found.append(Rule(label, "spdx", f"spdx license identifier (?:{tag})", TAG))
        found.append(Rule(label, "license", f"license (?:{tag})(?: license)?", MENTION))
        for spelling in spellings:
            for option in _alternatives(spelling):
                found.append(Rule(label, _keyword(option), option, TITLE))
        found.append(Rule(label, "licensed", f"licensed under (?:the )?(?:{'|'.join(spellings)})", TAG))
    for name in ATTRIBUTIONS:
        label = "cc-" + name.replace(" ", "-")
        title = " ".join(ELEMENTS[part] for part in name.split())
        found.append(Rule(label, "creative", f"creative commons {title}(?: (?:international|unported|license))*", TITLE))
        found.append(Rule(label, "cc", f"cc {name}", MENTION))
        for version in ATTRIBUTION_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            found.append(Rule(full, "spdx", f"spdx license identifier cc {name} {version}", TAG))
            found.append(Rule(full, "cc", f"cc {name} {version}", TITLE))
            found.append(Rule(full, "creative", f"creative commons {title} {version}(?: (?:international|unported|license))*", TAG))
            found.append(Rule(full, "creativecommons", f"creativecommons org licenses {name} {version}", TAG))
    found += [Rule(label, keyword, pattern, MENTION) for label, keyword, pattern in PHRASES]
    return found


def _alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between bars outside of groups."""
    parts, depth, own = [], 0, ""
    for sign in pattern:
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and not depth:
            parts.append(own)
            own = ""
        else:
            own += sign
    return [*parts, own]


def _keyword(pattern: str) -> str:
    """A word that stands by itself in every match: of those left without the optional parts, the
    licence or else the longest."""
    least, before = pattern, ""
    while least != before:
        before = least
        least = re.sub(r"\(\?:[^()]*\)(?:[?*]|\{0,[0-9]+\})", "", least)
        least = re.sub(r"\(\?:[^()]*\)(?![?*{])", "()", least)
    words = [w for w in re.sub(r"[^()]\?", "?", least).split() if re.fullmatch("[0-9a-z]+", w)]
    return next((w for w in words if w in ("license", "licence")), max(words, key=len))


def _gate(known: list[Rule]) -> str:
    """Matches every text that holds the keyword of some rule as a word."""
    words = sorted({rule.keyword for rule in known})
    return rf"(?i)(?<![{WORD}])(?:{'|'.join(words)})(?![{WORD}])"


def rule_table(spark: SparkSession, known: list[Rule]) -> DataFrame:
    rows = [
        (i, r.label, r.keyword, f" (?:{r.pattern})(?= |$)", r.priority, r.base, CONFIDENCE[r.priority])
        for i, r in enumerate(known)
    ]
    return spark.createDataFrame(
        rows, "rule int, label string, keyword string, pattern string, priority int, base boolean, confidence double"
    )


def word_line(text: Column) -> Column:
    """The words of a text, each with a blank before it."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parted = F.regexp_replace(F.translate(text, upper, lower), f"[^{WORD}]+", " ")
    return F.concat(F.lit(" "), F.trim(parted))


def _blanks(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def detections(docs: DataFrame, known: list[Rule]) -> DataFrame:
    """Rows (doc_id, mark, rule's columns, start, end in words, suppressed)."""
    words = "|".join(sorted({rule.keyword for rule in known}))
    held = (
        docs.filter(F.col("text").rlike(_gate(known)))
        .withColumn("line", word_line(F.col("text")))
        .withColumn("keyword", F.explode(F.array_distinct(
            F.regexp_extract_all("line", F.lit(f" ({words})(?= |$)"), F.lit(1))
        )))
        .select("doc_id", "mark", "line", "keyword")
    )
    # The rules are a fixed list of a few hundred rows.
    found = (
        held.join(F.broadcast(rule_table(docs.sparkSession, known)), "keyword")
        .filter(F.rlike("line", F.col("pattern")))
        .withColumn("gaps", F.split("line", F.col("pattern"), -1))
        .withColumn("hits", F.regexp_extract_all("line", F.col("pattern"), F.lit(0)))
        .withColumn("m", F.explode(located(F.col("gaps"), F.col("hits"), _blanks)))
        .select("doc_id", "mark", "rule", "label", "priority", "base", "confidence", "m.start", "m.end")
        .distinct()
    )
    order = Window.partitionBy("doc_id", "mark").orderBy("start", F.desc("end"), "priority", "rule")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for priority in sorted(CONFIDENCE):
        reach = F.max(F.when(F.col("priority") <= priority, F.col("end"))).over(earlier)
        inside = inside | ((F.col("priority") == priority) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return found.withColumn("suppressed", inside & ~F.col("base"))


def license_scan(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): words, base phrases, labels and a score.

    ``n_base``, ``first_word`` and ``last_word`` tell the number and the smallest and largest start
    (in words from 0) of the base phrases, ``base_labels`` and ``labels`` the distinct labels of
    them and of all detections, sorted and comma-joined, ``score`` the best confidence, else 0. A
    null text is empty, a null doc_id stays null, repeated rows stay, other columns are ignored.
    """
    known = rules()
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    base, live = F.col("base"), ~F.col("suppressed")
    found = detections(docs, known).groupBy("doc_id", "mark").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(base, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(live, F.col("label"))))).alias("labels"),
        F.max(F.when(live, F.col("confidence"))).alias("score"),
    )
    counted = docs.select("doc_id", "mark", F.regexp_count("text", F.lit(f"[{WORD}]+")).cast("long").alias("n_words"))
    return counted.join(found, ["doc_id", "mark"], "left").select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
