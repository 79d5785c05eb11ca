"""Operator 9: licence scans by ordered signature rules, with DataFrame functions only.

A rule is a regex over the words of a text, lower-cased and joined by single spaces. Rules
are grouped by a keyword that each of their matches contains. A text that contains a keyword is
searched for all regexes of that group at once, by one that is compiled once per task, and only
where that finds any are they tried one by one. A detection is the words from its first to its last; it is
suppressed where another of the same or a better priority contains it. Priorities: 1 an
identifier tag, 2 a sentence that grants a licence, 3 a licence's full name, 4 a hint.

The four base phrases are searched as they stand and their labels are never suppressed.

Defined results: a null text counts as empty and has no words; a null ``doc_id`` is kept;
repeated rows give repeated results; equal detections of equal priority count once, for the
rule that is first in the list; an empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import table, whole_text, written
from docintake.llm.license_texts import SIGNATURES

# What separates words, and the base phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# How sure a detection of each priority makes us.
SURENESS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.4}

LICENCE = "licen[cs]e"
VERSION = r"(?: version| v)?"
LATER = r"(?: or(?: at your option)? any later version| or later| only)?"

# Per licence: label, keyword, identifier words, regex of its name.
LICENCES = (
    ("gpl", "gpl", r"gpl(?: [123](?: 0)?)?(?: only| or later)?", rf"gpl(?:v[123]|{VERSION} [123](?: 0)?)"),
    ("gpl", "general public", r"gpl", rf"gnu general public {LICENCE}(?:{VERSION} [123](?: 0)?)?{LATER}"),
    ("lgpl", "lgpl", r"lgpl(?: [23](?: [01])?)?(?: only| or later)?", rf"lgpl(?:v[23](?: [01])?|{VERSION} [23](?: [01])?)"),
    ("lgpl", "lesser general", r"lgpl", rf"(?:gnu )?lesser general public {LICENCE}(?:{VERSION} [23](?: [01])?)?{LATER}"),
    ("lgpl", "library general", r"lgpl", rf"(?:gnu )?library general public {LICENCE}(?:{VERSION} 2(?: 0)?)?{LATER}"),
    ("agpl", "agpl", r"agpl(?: [13](?: 0)?)?(?: only| or later)?", rf"agpl(?:v3|{VERSION} [13](?: 0)?)"),
    ("agpl", "affero", r"agpl", rf"(?:gnu )?affero general public {LICENCE}(?:{VERSION} [13](?: 0)?)?{LATER}"),
    ("gfdl", "free documentation", r"gfdl(?: 1 [123])?", rf"gnu free documentation {LICENCE}(?:{VERSION} 1 [123])?"),
    ("apache", "apache", r"apache(?: [12] [01])?", rf"apache(?: software)? {LICENCE}(?:{VERSION} [12](?: [01])?)?"),
    ("mit", "mit", r"mit(?: 0)?", rf"mit {LICENCE}"),
    ("mit", "expat", r"expat", rf"expat(?: {LICENCE})"),
    ("mit", "x11", r"x11", rf"x11 {LICENCE}"),
    ("bsd-2", "bsd", r"bsd 2 clause", rf"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: {LICENCE})?"),
    ("bsd-3", "bsd", r"bsd 3 clause", rf"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)(?: {LICENCE})?"),
    ("bsd-4", "bsd", r"bsd 4 clause", rf"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)(?: {LICENCE})?"),
    ("bsd", "bsd", r"0bsd", rf"(?:zero clause bsd|0bsd|bsd)(?: style)? {LICENCE}"),
    ("mpl", "mpl", r"mpl(?: [12] [01])?", rf"mpl{VERSION} [12](?: [01])?"),
    ("mpl", "mozilla", r"mpl", rf"mozilla public {LICENCE}(?:{VERSION} [12](?: [01])?)?"),
    ("epl", "eclipse", r"epl(?: [12] 0)?", rf"eclipse (?:public|distribution) {LICENCE}(?:{VERSION} [12](?: 0)?)?"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?", rf"cddl(?:{VERSION} 1(?: [01])?)?"),
    ("cddl", "common development", r"cddl", rf"common development and distribution {LICENCE}(?:{VERSION} 1(?: [01])?)?"),
    ("cpl", "common public", r"cpl 1 0", rf"common public {LICENCE}(?:{VERSION} 1(?: 0)?)?"),
    ("ipl", "ibm public", r"ipl 1 0", rf"ibm public {LICENCE}(?:{VERSION} 1(?: 0)?)?"),
    ("eupl", "eupl", r"eupl(?: 1 [012])?", rf"eupl(?:{VERSION} 1(?: [012])?)?"),
    ("eupl", "european union public", r"eupl", rf"european union public {LICENCE}(?:{VERSION} 1(?: [012])?)?"),
    ("artistic", "artistic", r"artistic(?: [12] 0)?", rf"artistic {LICENCE}(?: [12](?: 0)?)?"),
    ("boost", "boost", r"bsl 1 0", rf"boost software {LICENCE}(?:{VERSION} 1(?: 0)?)?"),
    ("isc", "isc", r"isc", rf"isc {LICENCE}"),
    ("isc", "internet systems consortium", r"isc", rf"internet systems consortium {LICENCE}"),
    ("zlib", "zlib", r"zlib", rf"zlib(?: libpng)? {LICENCE}"),
    ("libpng", "libpng", r"libpng(?: 2 0)?", rf"libpng {LICENCE}"),
    ("unlicense", "unlicense", r"unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl(?: version 2)?"),
    ("openssl", "openssl", r"openssl", rf"openssl {LICENCE}"),
    ("php", "php", r"php 3 0[01]?", rf"php {LICENCE}(?:{VERSION} 3(?: 0[01]?)?)?"),
    ("python", "python", r"python 2 0", rf"python(?: software foundation)? {LICENCE}(?:{VERSION} 2)?"),
    ("python", "psf", r"psf 2 0", rf"psf {LICENCE}(?:{VERSION} 2)?"),
    ("ruby", "ruby", r"ruby", rf"ruby s? ?{LICENCE}"),
    ("perl", "perl", r"artistic 1 0 perl", r"same terms as perl(?: itself)?"),
    ("postgresql", "postgresql", r"postgresql", rf"postgresql {LICENCE}"),
    ("ncsa", "ncsa", r"ncsa", rf"(?:university of illinois )?ncsa(?: open source)? {LICENCE}"),
    ("ofl", "open font", r"ofl 1 [01]", rf"(?:sil )?open font {LICENCE}(?:{VERSION} 1(?: [01])?)?"),
    ("ms-pl", "microsoft", r"ms pl", rf"microsoft public {LICENCE}"),
    ("ms-rl", "microsoft", r"ms rl", rf"microsoft reciprocal {LICENCE}"),
    ("osl", "open software", r"osl 3 0", rf"open software {LICENCE}(?:{VERSION} 3(?: 0)?)?"),
    ("afl", "academic free", r"afl 3 0", rf"academic free {LICENCE}(?:{VERSION} [123](?: [01])?)?"),
    ("odbl", "open database", r"odbl 1 0", rf"open (?:data commons open |open )?database {LICENCE}"),
    ("odbl", "open data commons database", r"odbl 1 0", rf"open data commons database {LICENCE}"),
    ("odc-by", "open data commons", r"odc by 1 0", rf"open data commons attribution {LICENCE}"),
    ("pddl", "open data commons", r"pddl 1 0", r"open data commons public domain dedication"),
    ("cecill", "cecill", r"cecill(?: [bc12])?", r"cecill(?: [bc])?(?: version [12](?: [01])?)?"),
    ("sspl", "server side", r"sspl 1 0", rf"server side public {LICENCE}"),
    ("busl", "business source", r"busl 1 1", rf"business source {LICENCE}(?: 1 1)?"),
    ("elastic", "elastic", r"elastic 2 0", rf"elastic {LICENCE}(?: 2(?: 0)?)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc by", r"cc by(?: [1-4] [05])?", r"cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: [1-4] [05])?", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4] [05])?", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?: [1-4] [05])?", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1-4] [05])?", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1-4] [05])?", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative commons", r"cc by", rf"creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: {LICENCE})?"),
    ("cc-by-sa", "creative commons", r"cc by sa", rf"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: {LICENCE})?"),
    ("cc-by-nd", "creative commons", r"cc by nd", rf"creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?(?: {LICENCE})?"),
    ("cc-by-nc", "creative commons", r"cc by nc", rf"creative commons attribution non ?commercial(?: [1-4] [05])?(?: {LICENCE})?"),
    ("cc-by-nc-sa", "creative commons", r"cc by nc sa", rf"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: {LICENCE})?"),
    ("cc-by-nc-nd", "creative commons", r"cc by nc nd", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?(?: {LICENCE})?"),
    ("cc0", "creative commons", r"cc0", r"creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?"),
)

# Sentences that stand by themselves: label, priority, keyword, regex.
SENTENCES = (
    ("mit", 2, "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 2, "permission to use", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 2, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", 2, "neither the name", "neither the name of .{1,80}? nor the names of its contributors"),
    ("bsd-4", 2, "all advertising", "all advertising materials mentioning features or use of this software must display"),
    ("gpl", 2, "either version", "either version [123] of the license or at your option any later version"),
    ("gpl", 2, "is free software", "this program is free software you can redistribute it and or modify it"),
    ("lgpl", 2, "is free software", "this library is free software you can redistribute it and or modify it"),
    ("zlib", 2, "as is without any", "this software is provided as is without any express or implied warranty"),
    ("boost", 2, "any person or organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 2, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 2, "what the", "do what the .{1,12} you want to public license"),
    ("public-domain", 2, "public domain", "(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
    ("public-domain", 3, "public domain", "public domain(?: dedication| mark)?"),
    ("proprietary", 2, "all rights reserved", "all rights reserved"),
    ("proprietary", 2, "confidential", "proprietary and confidential"),
    ("proprietary", 2, "unauthorized", "unauthorized (?:copying|use|distribution|reproduction)"),
    ("proprietary", 3, "license agreement", "(?:end user|commercial|software) license agreement"),
    ("proprietary", 4, "eula", "eula"),
    ("notice", 3, "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}"),
    ("notice", 4, "copyright", "copyright"),
    ("gpl", 4, "copyleft", "copyleft"),
    ("gpl", 4, "gpl", "gpl"),
    ("lgpl", 4, "lgpl", "lgpl"),
    ("agpl", 4, "agpl", "agpl"),
    ("cc", 4, "creative commons", "creative commons"),
    ("open-source", 4, "open source", f"open source(?: {LICENCE})?"),
    ("notice", 4, "licen", f"(?:see|read) the {LICENCE}(?: file| text)?"),
)

# Rule templates for every licence: priority and what stands around its name.
AROUND = (
    (1, "spdx license identifier ", "identifier"),
    (2, rf"(?:distributed|released|available|licen[cs]ed|published|provided|used?) under (?:the )?(?:terms of )?(?:the )?", "name"),
    (2, rf"(?:subject to|according to|governed by|in compliance with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", "name"),
    (3, "", "name"),
)


def rules() -> list[tuple[int, str, int, str, str]]:
    """The rules in their order: number, label, priority, keyword, regex."""
    listed = [(label, priority, keyword, regex) for label, priority, keyword, regex in SENTENCES]
    for label, signatures in SIGNATURES.items():
        listed += [(label, priority, keyword, regex) for priority, keyword, regex in signatures]
    for label, keyword, identifier, name in LICENCES:
        for priority, before, which in AROUND:
            tagged = which == "identifier"
            gate = "spdx" if tagged else keyword
            listed.append((label, priority, gate, before + (identifier if tagged else name)))
    listed.sort(key=lambda rule: rule[1])
    return [(n, *rule) for n, rule in enumerate(listed)]


def anchors() -> dict[str, str]:
    """For keywords of signatures alone the longest word that every match holds as a word."""
    others = {keyword for _, _, keyword, _ in SENTENCES} | {l[1] for l in LICENCES} | {"spdx"}
    others |= {phrase for _, phrase in BASE}
    found = {}
    for signatures in SIGNATURES.values():
        for _, keyword, regex in signatures:
            alone = [
                word
                for word in keyword.split()
                if re.search(rf"(?:^|[ |:)]){re.escape(word)}(?:$|[ |)])", regex)
            ]
            if keyword not in others and alone:
                found[keyword] = max(alone, key=len)
    return found


def with_words(rows: DataFrame) -> DataFrame:
    """Adds ``words``: those of ``text``, each with a blank before it and one behind the
    last; empty without words. Letters keep their case: regexes ignore that of A-Z."""
    joined = rows.withColumn("words", F.trim(F.regexp_replace("text", SEPARATORS, " ")))
    spaced = F.concat(F.lit(" "), F.col("words"), F.lit(" "))
    return joined.withColumn("words", F.when(F.col("words") != "", spaced).otherwise(""))


def places(words: Column, regex: Column) -> Column:
    """First and last word of every match of ``regex``, as an array of structs.

    Matches are marked within the text, which is then cut at its blanks, so the work grows
    with the text and not with its square. The marks are separators, so no word has them.
    """
    marked = F.regexp_replace(
        words, F.concat(F.lit("(?i) ("), regex, F.lit(")(?= )")), F.lit(" \u0001$1\u0002")
    )
    cut = F.split(F.substring(marked, F.lit(2), F.length(marked) - 2), " ")

    def positions(holds) -> Column:
        numbered = F.transform(cut, lambda w, i: F.when(holds(w), i))
        return F.filter(numbered, lambda i: i.isNotNull())

    starts = positions(lambda w: F.startswith(w, F.lit("\u0001")))
    ends = positions(lambda w: F.endswith(w, F.lit("\u0002")))
    return F.transform(
        F.arrays_zip(starts.alias("first"), ends.alias("last")),
        lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last")),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``row, doc_id, n_words``, the ``base`` places (label, first,
    last) and all ``detections`` (rule, label, priority, first, last)."""
    listed = rules()
    phrases = {phrase for _, phrase in BASE}
    keywords = sorted({rule[3] for rule in listed} | phrases)
    table_of_rules = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                F.lit(label).alias("label"),
                F.lit(priority).alias("priority"),
                F.lit(keyword).alias("keyword"),
                F.lit(regex).alias("regex"),
            )
            for n, label, priority, keyword, regex in listed
        ]
    )
    words = with_words(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            whole_text().alias("text"),
        )
    ).withColumn(
        "n_words",
        F.when(F.col("words") == "", 0)
        .otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) - 1)
        .cast("long"),
    )
    # One test per keyword, not a lambda, so that the text is lower-cased only once and the
    # regex of a group is a literal.
    groups: dict[str, list[str]] = {}
    for *_, keyword, regex in listed:
        groups.setdefault(keyword, []).append(regex)

    # Signatures are many, so one look at the words of a text says which may be there at all.
    anchored = anchors()
    held = F.array(*[F.lit(w) for w in sorted(set(anchored.values()))])

    def found(keyword: str) -> Column:
        here = F.contains("lowered", F.lit(keyword))
        if keyword in anchored:
            here = F.array_contains("held", anchored[keyword]) & here
        if keyword in groups and keyword not in phrases:
            here &= F.rlike("words", F.lit(f"(?i) (?:{'|'.join(groups[keyword])})(?= )"))
        return here

    holds = [F.when(found(k), F.lit(k)) for k in keywords]
    lowered = words.withColumn("lowered", F.lower("words"))
    lowered = lowered.withColumn("held", F.array_intersect(F.split("lowered", " "), held))
    lowered = lowered.withColumn("present", F.array_compact(F.array(*holds)))

    def base_places(label: str, phrase: str) -> Column:
        found = places(F.col("words"), F.lit(phrase))
        labelled = F.transform(
            found, lambda p: F.struct(F.lit(label).alias("label"), p["first"], p["last"])
        )
        nothing = F.array().cast("array<struct<label:string,first:int,last:int>>")
        return F.when(F.array_contains("present", phrase), labelled).otherwise(nothing)

    def rule_places(rule: Column) -> Column:
        return F.transform(
            places(F.col("words"), rule["regex"]),
            lambda p: F.struct(
                rule["rule"], rule["label"], rule["priority"], p["first"], p["last"]
            ),
        )

    def applies(rule: Column) -> Column:
        whole = F.concat(F.lit("(?i) (?:"), rule["regex"], F.lit(")(?= )"))
        return F.array_contains("present", rule["keyword"]) & F.rlike("words", whole)

    nothing = F.array().cast(
        "array<struct<rule:int,label:string,priority:int,first:int,last:int>>"
    )
    return lowered.select(
        "row",
        "doc_id",
        "n_words",
        F.concat(*[base_places(label, phrase) for label, phrase in BASE]).alias("base"),
        F.when(F.size("present") == 0, nothing)
        .otherwise(F.flatten(F.transform(F.filter(table_of_rules, applies), rule_places)))
        .alias("detections"),
    )


def detections(scanned: DataFrame) -> DataFrame:
    """All detections of a scan, one per row, with ``kept``: not suppressed.

    A text's detections are sorted so that a container stands before what it contains;
    then one is contained if the furthest end so far, among those of the same or a better
    priority, is not before its own.
    """
    each = scanned.select("row", "doc_id", F.inline("detections"))
    earlier = (
        Window.partitionBy("row")
        .orderBy("first", F.col("last").desc(), "priority", "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.lit(None).cast("int")
    for level in SURENESS:
        so_far = F.max(F.when(F.col("priority") <= level, F.col("last"))).over(earlier)
        reach = F.when(F.col("priority") == level, so_far).otherwise(reach)
    return (
        each.withColumn("reach", reach)
        .withColumn("kept", F.coalesce(F.col("reach") < F.col("last"), F.lit(True)))
        .drop("reach")
    )


def licences(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scan of every document, and its detections. The scan is written once, so both
    name rows alike."""
    scanned = written(scan(docs), "licence-scan")
    return scanned, detections(scanned)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op9``: words, base places and labels of each document."""
    scanned, found = licences(table(spark, sf_dir, "documents"))
    sure = F.lit(0.0)
    for level, value in SURENESS.items():
        sure = F.when(F.col("priority") == level, F.lit(value)).otherwise(sure)
    labelled = (
        found.where("kept")
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max(sure).alias("sure"))
    )
    own = F.transform("base", lambda p: p["label"])
    starts = F.transform("base", lambda p: p["first"].cast("long"))
    nothing = F.array().cast("array<string>")
    return scanned.join(labelled, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(own, F.coalesce("more", nothing))), ","
        ).alias("labels"),
        F.greatest(
            F.coalesce("sure", F.lit(0.0)), F.when(F.size("base") > 0, 0.7).otherwise(0.0)
        ).alias("score"),
    )
