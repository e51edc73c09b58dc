"""Licence scans by ordered signature rules, with DataFrame functions only.

A text is lowered (A-Z) and cut into words, which are joined with single spaces. A prefilter of key words decides whether any
rule can match. For texts that pass, each rule whose own key word occurs is matched by its regular expression; detections
are places in the text with the rule's label and rank. A detection that lies inside another one of the same or a higher rank
is suppressed. Three base phrases are always reported.

Null text counts as empty: no words, no places, no labels, score 0. Repeated rows are scanned one by one and a text's length
does not matter. Of detections of one place and rank, the first rule's counts. An empty table gives an empty one. All columns of the input are kept, but for those named like an added one, which are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import free_name

# Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Licence families: label, a key word that every match holds, names as a regular expression over words, known versions.
FAMILIES = (
    ("mit", "mit", r"mit(?: x11)?", ()),
    ("mit", "expat", r"expat(?: x11)?", ()),
    ("mit-0", "mit", r"mit (?:no attribution|0)", ()),
    ("x11", "x11", r"x11(?: mit)?", ()),
    ("x11", "x consortium", r"x consortium", ()),
    ("apache", "apache", r"apache(?: software)?", ("1 0", "1 1", "2 0", "2")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1", "2", "2 0", "3", "3 0")),
    ("gpl", "general public", r"(?:gnu )?general public", ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2", "2 0", "2 1", "3", "3 0")),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public", ("2 1", "3", "3 0")),
    ("lgpl", "library general public", r"(?:gnu )?library general public", ("2", "2 0")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("1", "3", "3 0")),
    ("agpl", "affero", r"(?:gnu )?affero(?: general public)?", ("1", "3", "3 0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("bsd", "bsd", r"(?:original |new |modified |simplified |revised )?bsd", ()),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|freebsd)", ()),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd)", ()),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd)", ()),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd 0 clause)", ()),
    ("isc", "isc", r"isc", ()),
    ("mpl", "mozilla", r"mozilla(?: public)?", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", r"mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", r"eclipse(?: public)?", ("1 0", "2 0")),
    ("epl", "epl", r"epl", ("1 0", "2 0")),
    ("edl", "eclipse distribution", r"eclipse distribution", ("1 0",)),
    ("cddl", "cddl", r"cddl", ("1 0", "1 1")),
    ("cddl", "common development", r"common development and distribution", ("1 0", "1 1")),
    ("cpl", "common public", r"common public", ("1 0",)),
    ("ipl", "ibm public", r"ibm public", ("1 0",)),
    ("eupl", "eupl", r"eupl", ("1 0", "1 1", "1 2")),
    ("eupl", "european union public", r"european union public", ("1 0", "1 1", "1 2")),
    ("cecill", "cecill", r"cecill(?: [bc])?", ("1 0", "2 0", "2 1")),
    ("artistic", "artistic", r"(?:perl )?artistic", ("1 0", "2 0")),
    ("boost", "boost", r"boost(?: software)?", ("1 0",)),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("libpng", "libpng", r"libpng", ("2 0",)),
    ("openssl", "openssl", r"openssl", ()),
    ("ssleay", "ssleay", r"(?:original )?ssleay", ()),
    ("python", "python", r"python(?: software foundation)?", ("2", "2 0")),
    ("php", "php", r"php", ("3 0", "3 01")),
    ("ruby", "ruby", r"ruby", ()),
    ("zpl", "zope", r"zope(?: public)?", ("1 1", "2 0", "2 1")),
    ("vim", "vim", r"vim", ()),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ("1", "2")),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("osl", "open software", r"open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", r"academic free", ("1 2", "2 0", "2 1", "3 0")),
    ("mspl", "microsoft public", r"microsoft public", ()),
    ("msrl", "microsoft reciprocal", r"microsoft reciprocal", ()),
    ("apsl", "apple public source", r"apple public source", ("1 0", "1 1", "1 2", "2 0")),
    ("ofl", "open font", r"(?:sil )?open font", ("1 0", "1 1")),
    ("sspl", "server side public", r"server side public", ("1",)),
    ("bsl", "business source", r"business source", ("1 1",)),
    ("elastic", "elastic", r"elastic", ("1", "2", "2 0")),
    ("ecl", "educational community", r"educational community", ("1 0", "2 0")),
    ("qpl", "qpl", r"qpl", ("1 0",)),
    ("qpl", "q public", r"q public", ("1 0",)),
    ("sleepycat", "sleepycat", r"sleepycat", ()),
    ("upl", "universal permissive", r"universal permissive", ("1 0",)),
    ("curl", "curl", r"curl", ()),
    ("odbl", "open database", r"(?:odc )?open database", ("1 0",)),
    ("pddl", "public domain dedication", r"(?:odc )?public domain dedication(?: and)?", ("1 0",)),
    ("odc-by", "open data commons", r"open data commons attribution", ("1 0",)),
    ("cdla", "community data", r"community data(?: permissive| sharing)?", ("1 0", "2 0")),
    ("openrail", "openrail", r"(?:creativeml |bigscience |bigcode )?openrail(?: m)?", ()),
    ("rail", "responsible ai", r"responsible ai", ("1 0",)),
)
# Creative Commons terms: label, abbreviation and full name.
COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Notices without a licence's name: label, key word, rank, regular expression.
NOTICES = (
    ("cc0", "cc0", 0, r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons zero", 0, r"creative commons zero(?: 1 0)?(?: universal)?"),
    ("cc0", "no rights reserved", 0, r"no rights reserved"),
    ("public-domain", "public domain", 1, r"(?:dedicated|released|placed|contributed)(?: in)?(?: to)? the public domain"),
    ("public-domain", "public domain", 2, r"public domain"),
    ("all-rights-reserved", "all rights reserved", 1, r"all rights reserved"),
    ("copyright", "copyright", 2, r"copyright(?: c)?(?: [0-9]{4})+"),
    ("mit", "permission is hereby granted", 0, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", 0, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", 0, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "as is", 0, r"this software is provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", 0, r"free and unencumbered software released into the public domain"),
    ("wtfpl", "what the fuck", 0, r"do what the fuck you want to(?: public license)?"),
    ("gpl", "free software", 0, r"free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("proprietary", "proprietary", 1, r"proprietary(?: and)? confidential"),
    ("non-commercial", "commercial use", 1, r"(?:not for|no|non) commercial use"),
    ("other", "license agreement", 2, r"(?:end user )?license agreement"),
)
WORD_LICENSE = r"licen[cs]es?"
GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|governed|dual licen[cs]ed)(?: [a-z]+)?(?: under| by| with| via)"
TERMS = r"(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)?"
#: How sure a detection of each rank is.
SURE = (1.0, 0.8, 0.5)
#: One of these stands in every text that any rule can match: tested once for each text.
COMMON_KEYS = ("licen", "general public", "gpl", "mpl", "cc ", "cc0", "creative commons", "public domain", "rights reserved", "copyright", "permission", "redistribution and use", "as is", "unencumbered", "what the fuck", "free software", "proprietary", "commercial use")


def rules() -> list[tuple[str, str, int, str]]:
    """Label, key word, rank (0 first) and regular expression of every rule, in order: each family by each form of notice.

    Rank 0 names a licence with its version, rank 1 says that something is under it, rank 2 only names it.
    """
    out = []
    for label, key, name, versions in FAMILIES:
        # The word licence may only be left out where the key word alone gets a text past the prefilter.
        may = "?" if any(c.strip() in key for c in COMMON_KEYS) else ""
        for v in versions:
            out.append((f"{label}-{v.replace(' ', '.')}", key, 0, rf"(?:{GRANT}{TERMS} )?(?:{name})(?: {WORD_LICENSE}){may}(?: version| v| ver)? ?v?{v}(?: or later| only| or any later version)?"))
        out.append((label, key, 1, rf"{GRANT}{TERMS} (?:{name})(?: style)?(?: {WORD_LICENSE}){may}"))
        out.append((label, key, 2, rf"(?:{name})(?: style)? {WORD_LICENSE}"))
    for label, short, full in COMMONS:
        names = rf"(?:cc {short}|creative commons(?: {short}| {full}))"
        for key in ("cc by", "creative commons"):
            for v in COMMONS_VERSIONS:
                out.append((f"{label}-{v.replace(' ', '.')}", key, 0, rf"{names}(?: international)?(?: {WORD_LICENSE})?(?: version| v)? ?{v}(?: international| unported| generic)?(?: {WORD_LICENSE})?"))
            out.append((label, key, 1, rf"{GRANT}{TERMS} {names}"))
            out.append((label, key, 2, rf"{names}(?: {WORD_LICENSE})?"))
    out += NOTICES
    return out


def normal(text: Column) -> Column:
    """The words of a text in lower case, each between single spaces, with one at both ends; one space if there are none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    words = F.trim(F.regexp_replace(lower, NOT_WORD, " "))
    return F.when(words == "", " ").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.translate(x, " ", ""))


def bounded(pattern: str) -> str:
    return rf"(?<= )(?:{pattern})(?= )"


def base_places(words: Column, n_words: Column) -> Column:
    """(n, first, last, labels) of the base phrases: what stands before the first and after the last place gives their words."""
    found = []
    for phrase, label in BASE:
        parts = F.split(words, bounded(phrase), -1)
        first = spaces(F.element_at(parts, 1)) - 1
        last = n_words - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())
        n = F.size(parts) - 1
        none = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.lit(None).cast("string").alias("label"))
        has = F.struct(n.alias("n"), first.cast("int").alias("first"), last.cast("int").alias("last"), F.lit(label).alias("label"))
        found.append(F.when(F.contains(words, F.lit(f" {phrase} ")), has).otherwise(none))
    return F.array(*found)


#: Detections that are put together at a time: appending one by one to a long array would copy it each time.
RUN = 128
PLACES = "array<struct<start:int,end:int,rank:int,label:string>>"


def _ends(pairs: Column, rule: Column) -> Column:
    """Places from the lengths before each match and of it, which add up: first those of runs of matches, then inside each."""
    length = lambda acc, p: acc + p["before"] + p["match"]
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / RUN).cast("int")), lambda k: F.slice(pairs, k * RUN + 1, F.lit(RUN)))
    whole = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), length))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(whole, begin, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def inside(run: Column, at: Column) -> Column:
        def step(acc: Column, p: Column) -> Column:
            start = acc["at"] + p["before"]
            place = F.struct(start.alias("start"), (start + p["match"]).alias("end"), rule["rank"].alias("rank"), rule["label"].alias("label"))
            return F.struct((start + p["match"]).alias("at"), F.array_append(acc["out"], place).alias("out"))

        return F.aggregate(run, F.struct(at.alias("at"), F.array().cast(PLACES).alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.zip_with(runs, starts, inside))


def _detections(words: Column) -> Column:
    """All places of all rules whose key word occurs: start, end, rank, label."""
    table = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(bounded(p)).alias("pattern"), F.lit(r).alias("rank"), F.lit(x).alias("label")) for x, k, r, p in rules()])

    def places(rule: Column) -> Column:
        between, matched = F.split(words, rule["pattern"], -1), F.regexp_extract_all(words, rule["pattern"], F.lit(0))
        pairs = F.zip_with(F.slice(between, 1, F.size(matched)), matched, lambda b, m: F.struct(F.length(b).alias("before"), F.length(m).alias("match")))
        return F.when(F.size(matched) == 0, F.array().cast(PLACES)).otherwise(_ends(pairs, rule))

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(words, r["key"])), places))


def _surviving(found: Column) -> Column:
    """Labels and best rank of detections that lie in no other one of the same or a higher rank.

    In order of start, longest and highest rank first, a detection lies inside an earlier one if and only if the furthest end
    of those of its rank or higher reaches its own.
    """
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["rank"].alias("rank"), d["label"].alias("label"))))
    start = F.struct(F.lit(-1).alias("r0"), F.lit(-1).alias("r1"), F.lit(-1).alias("r2"), F.array().cast("array<string>").alias("labels"), F.lit(9).alias("best"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        reach = F.when(d["rank"] == 0, acc["r0"]).when(d["rank"] == 1, F.greatest(acc["r0"], acc["r1"])).otherwise(F.greatest(acc["r0"], acc["r1"], acc["r2"]))
        inside = reach >= end
        ends = [F.when(d["rank"] == k, F.greatest(acc[f"r{k}"], end)).otherwise(acc[f"r{k}"]).alias(f"r{k}") for k in range(3)]
        labels = F.when(inside | F.array_contains(acc["labels"], d["label"]), acc["labels"]).otherwise(F.array_append(acc["labels"], d["label"]))
        return F.struct(*ends, labels.alias("labels"), F.when(inside, acc["best"]).otherwise(F.least(acc["best"], d["rank"])).alias("best"))

    return F.aggregate(order, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["best"].alias("best")))


ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with `n_words`, the base phrases' `n_base`, `first_word`, `last_word` and `base_labels`, all `labels`, and
    `score`, how sure the surest detection is (0: none).
    """
    own = [F.col(c) for c in docs.columns if c.lower() not in ADDED]
    w, n, b, m = (free_name(docs, f"scan_{x}") for x in ("words", "n", "base", "more"))
    rows = docs.select(*own, normal(F.col(text)).alias(w))
    words = F.col(w)
    rows = rows.withColumn(n, F.when(words == " ", 0).otherwise(spaces(words) - 1))
    any_key = F.rlike(words, F.lit("|".join(COMMON_KEYS)))
    rows = rows.withColumn(b, F.when(any_key, base_places(words, F.col(n))))
    rows = rows.withColumn(m, F.when(any_key, _surviving(_detections(words))))
    base, more = F.col(b), F.col(m)
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.array_sort(F.filter(base["label"], lambda x: x.isNotNull())), none)
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(more["labels"], none)))
    sure = F.coalesce(*[F.when(more["best"] == k, F.lit(s)) for k, s in enumerate(SURE)], F.lit(0.0))
    return rows.select(
        *own,
        F.col(n).cast("long").alias("n_words"),
        F.coalesce(F.aggregate(base["n"], F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(base["first"]).cast("long").alias("first_word"),
        F.array_max(base["last"]).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(sure, F.when(F.size(base_labels) > 0, 0.8).otherwise(0.0)).alias("score"),
    )
