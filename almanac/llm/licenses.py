"""License scan by ordered signature rules, in DataFrame expressions only.

Text becomes words. A keyword gate lets only texts with a trigger word further;
there each occurrence of a trigger gives a context of words round it, in which
the trigger stands in angle brackets. Every rule belongs to one trigger and has
a keyword that the context must hold before its regular expression runs, so of
several hundred rules a few run per occurrence. A match is an interval of words.
Intervals are read in order of start; one that lies within an interval of the
same or a higher tier is suppressed (a versioned name covers the bare name, a
license name covers a copyright line or a loose mention). Partly overlapping
intervals all stay.

The whole scan is a projection: no shuffle, no join, and work per row linear in
its words and trigger occurrences (up to the sort of its matches).
"""

from __future__ import annotations

import json
import re
from re import _parser as grammar
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The plus of a GNU identifier (GPL-2.0+) stays as a part of its last word.
PLUS = r"(?<=gpl-[0-9]\.[0-9])\+(?![0-9a-z\x{80}-\x{10ffff}])"

#: Phrases that always count: (words before the trigger ``license``, label).
BASE = ((("mit",), "mit"), (("apache",), "apache"), (("general", "public"), "gpl"))

# Tiers: lower ones win. 1 versioned or tagged, 2 named, 3 bare name, 4 loose mention.
# 0 is an identifier of an SPDX expression: the others of the expression don't suppress it,
# and it suppresses as tier 1 does.
APART, VERSIONED, NAMED, BARE, LOOSE = 0, 1, 2, 3, 4
WEIGHT = {APART: 0.98, VERSIONED: 0.98, NAMED: 0.9, BARE: 0.8, LOOSE: 0.3}


class Rule(NamedTuple):
    trigger: str
    keyword: str
    regex: str
    label: str
    tier: int


LICENSE_WORDS = ("license", "licence", "licensed", "licenced", "licenses")

# Families with versions: label stem, words of the name, versions, words after the
# name or before it that make it a license text.
_FAMILIES = (
    ("apache", "apache", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla public", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public", ("1.0", "2.0")),
    ("eupl", "european union public", ("1.0", "1.1", "1.2")),
    ("cddl", "common development and distribution", ("1.0", "1.1")),
    ("cpl", "common public", ("1.0",)),
    ("afl", "academic free", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("osl", "open software", ("1.0", "1.1", "2.0", "2.1", "3.0")),
    ("artistic", "artistic", ("1.0", "2.0")),
    ("bsl", "boost software", ("1.0",)),
    ("ofl", "open font", ("1.0", "1.1")),
    ("odbl", "open database", ("1.0",)),
    ("php", "php", ("3.0", "3.01")),
    ("python", "python software foundation", ("2.0",)),
    ("zpl", "zope public", ("1.1", "2.0", "2.1")),
    ("lppl", "latex project public", ("1.0", "1.1", "1.2", "1.3")),
    ("sspl", "server side public", ("1.0",)),
    ("busl", "business source", ("1.1",)),
    ("elastic", "elastic", ("1.0", "2.0")),
    ("apsl", "apple public source", ("1.0", "1.1", "1.2", "2.0")),
    ("ecl", "educational community", ("1.0", "2.0")),
    ("cecill", "cecill", ("1.0", "2.0", "2.1")),
    ("ms-pl", "microsoft public", ()), ("ms-rl", "microsoft reciprocal", ()),
    ("mit", "mit", ()), ("mit", "expat", ()), ("x11", "x11", ()), ("isc", "isc", ()), ("zlib", "zlib", ()), ("libpng", "libpng", ()),
    ("ncsa", "university of illinois ncsa open source", ()), ("postgresql", "postgresql", ()),
    ("openssl", "openssl", ()), ("ruby", "ruby", ()), ("json", "json", ()), ("icu", "icu", ()), ("curl", "curl", ()),
    ("qpl", "q public", ()), ("vim", "vim", ()), ("ijg", "independent jpeg group", ()), ("unicode", "unicode", ()),
    ("ipl", "ibm public", ()), ("sleepycat", "sleepycat", ()), ("watcom", "sybase open watcom public", ()),
    ("bsd", "bsd", ()), ("wtfpl", "do what the fuck you want to public", ()), ("nposl", "non profit open software", ()),
)
_GNU = (
    ("agpl", "affero general public", ("1.0", "3.0"), ("agpl",)),
    ("lgpl", "lesser general public", ("2.1", "3.0"), ("lgpl",)),
    ("lgpl", "library general public", ("2.0",), ()),
    ("gpl", "general public", ("1.0", "2.0", "3.0"), ("gpl",)),
    ("gfdl", "free documentation", ("1.1", "1.2", "1.3"), ("gfdl", "fdl")),
)
_CC = (
    ("by", "attribution"), ("by-sa", "attribution share alike"), ("by-nd", "attribution no derivatives"),
    ("by-nc", "attribution non commercial"), ("by-nc-sa", "attribution non commercial share alike"),
    ("by-nc-nd", "attribution non commercial no derivatives"),
)
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_BSD = (("0", "zero clause"), ("1", "one clause"), ("2", "two clause|simplified|freebsd"),
        ("3", "three clause|new|revised|modified"), ("4", "four clause|original|old"))


def _version(v: str) -> str:
    """Words of a version: 2.0 is ``2 0``, ``v2 0`` or ``2``."""
    major, _, minor = v.partition(".")
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return rf"(?:,? ?(?:version|ver|v) ?| v?){major}{tail}\b"


def build_rules() -> list[Rule]:
    out: list[Rule] = []

    def add(trigger: str, keyword: str, regex: str, label: str, tier: int) -> None:
        out.append(Rule(trigger, keyword, regex, label, tier))

    for stem, name, versions in _FAMILIES:
        last = name.rsplit(" ", 1)[-1]
        for t in ("license", "licence"):
            add(t, last, rf"\b{name} (?:software )?<{t}>", stem, BARE)
            for v in versions:
                add(t, last, rf"\b{name} (?:software )?<{t}>{_version(v)}", f"{stem}-{v}", VERSIONED)
        for v in versions:  # licensed under apache 2 0
            add("licensed", last, rf"<licensed> under (?:the )?{name}{_version(v)}", f"{stem}-{v}", VERSIONED)
    later = r"(?: \w+){0,6}? (?:or|and) (?:at your option )?(?:\w+ ){0,3}?(?:any )?later\b"
    for stem, name, versions, shorts in _GNU:
        keyword, guard = name.rsplit(" ", 1)[-1], "" if stem != "gpl" else "(?<!lesser )(?<!library )(?<!affero )"
        for t in ("license", "licence"):
            core = rf"(?:\bgnu )?{guard}\b{name} <{t}>"
            add(t, keyword, core, stem, BARE)
            for v in versions:
                add(t, keyword, rf"{core}(?: as published by the free software foundation)?(?: either)?{_version(v)}", f"{stem}-{v}", VERSIONED)
                add(t, "later", rf"{core}(?: \w+){{0,8}}?{_version(v)}{later}", f"{stem}-{v}-or-later", VERSIONED)
        for s in shorts:
            add(s, s, rf"(?:\bgnu )?<{s}>", stem, NAMED)
            for v in versions:
                add(s, s, rf"(?:\bgnu )?<{s}>{_version(v)}", f"{stem}-{v}", VERSIONED)
                add(s, "later", rf"(?:\bgnu )?<{s}>{_version(v)}{later}", f"{stem}-{v}-or-later", VERSIONED)
                add(f"{s}v{v[0]}", s, rf"<{s}v{v[0]}>", f"{stem}-{v}", VERSIONED)
    for code, name in _CC:
        words, spelled = code.replace("-", " "), name.replace("non commercial", "non ?commercial").replace("share alike", "share ?alike")
        spelled = spelled.replace("no derivatives", "no ?deriv(?:ative)?s?(?: works)?")
        add("cc", "by", rf"(?:\blicensed under )?<cc> {words}\b(?! (?:nc|nd|sa)\b)", f"cc-{code}", NAMED)
        add("commons", "attribution", rf"\bcreative <commons> {spelled}\b(?! (?:non|share|no\b))", f"cc-{code}", NAMED)
        for v in _CC_VERSIONS:
            add("cc", "by", rf"(?:\blicensed under )?<cc> {words}{_version(v)}", f"cc-{code}-{v}", VERSIONED)
            add("commons", "attribution", rf"\bcreative <commons> {spelled}(?: (?!non|share|no\b)\w+){{0,2}}?{_version(v)}", f"cc-{code}-{v}", VERSIONED)
    for n, names in _BSD:
        for form in (rf"\b(?:{n} clause|{names}) <bsd>(?: licen[cs]e)?", rf"<bsd> (?:{n} clause|{names})\b(?: licen[cs]e)?"):
            add("bsd", "clause" if n in "01" else "bsd", form, f"bsd-{n}-clause", VERSIONED)
    spdx = {f"{s}-{v}" for s, _, vs in _FAMILIES for v in vs} | {s for s, _, vs in _FAMILIES if not vs}
    spdx |= {f"{s}-{v}" for s, _, vs, _ in _GNU for v in vs} | {f"cc-{c}-{v}" for c, _ in _CC for v in _CC_VERSIONS}
    spdx |= {f"bsd-{n}-clause" for n, _ in _BSD}
    spelled = {label: re.sub(r"[.-]", " ", label) for label in sorted(spdx)}
    # what may stand before an identifier: up to two others, each with its form, an
    # exception and the operator behind it
    ahead = (r"(?: (?:" + "|".join(sorted(spelled.values(), key=len, reverse=True)) + r")(?: only| or later|plus)?"
             r"(?: with(?: \w+){1,2}? exception(?: \d \d)?)? (?:or|and)){0,2}")
    gnu = {f"{s}-{v}" for s, _, vs, _ in _GNU for v in vs}
    for label, words in spelled.items():
        longer = "".join(f"|{w.removeprefix(words)}" for w in spelled.values() if w.startswith(f"{words} "))
        add("spdx", words.split()[0], rf"<spdx> license identifier{ahead} {words}\b(?! or later|plus{longer})", label, APART)
        if label in gnu:
            add("spdx", words.split()[0], rf"<spdx> license identifier{ahead} {words}(?: or later|plus)\b", f"{label}-or-later", APART)
    add("cc0", "cc0", r"<cc0>(?: 1 0)?(?: universal)?", "cc0-1.0", VERSIONED)
    add("unlicense", "unlicense", r"(?:\bthe )?<unlicense>", "unlicense", NAMED)
    add("wtfpl", "wtfpl", r"<wtfpl>", "wtfpl", NAMED)
    add("domain", "public", r"\bpublic <domain>", "public-domain", NAMED)
    add("reserved", "rights", r"\ball rights <reserved>", "all-rights-reserved", LOOSE)
    add("copyright", "copyright", r"<copyright> (?:c )?(?:19|20)\d\d\b", "copyright", LOOSE)
    add("permission", "granted", r"<permission> is hereby granted free of charge to any person obtaining a copy", "mit", NAMED)
    add("permission", "granted", r"<permission> to use copy modify (?:and|or) distribute this software", "isc", NAMED)
    add("redistribution", "binary", r"<redistribution> and use in source and binary forms with or without modification", "bsd", NAMED)
    for t in LICENSE_WORDS:
        add(t, t, rf"<{t}>(?: under)?", "license-mention", LOOSE)
    return out


def _blanks(parsed) -> int:
    """Most blanks that a parsed expression takes or looks at."""
    most = 0
    for op, arg in parsed:
        if op is grammar.LITERAL:
            most += arg == ord(" ")
        elif op in (grammar.MAX_REPEAT, grammar.MIN_REPEAT):
            each = _blanks(arg[2])
            most += int(arg[1]) * each if each else 0
        elif op is grammar.SUBPATTERN:
            most += _blanks(arg[3])
        elif op is grammar.BRANCH:
            most += max(map(_blanks, arg[1]))
        elif op in (grammar.ASSERT, grammar.ASSERT_NOT):
            most += _blanks(arg[1])
    return most


def reach(rules: list[Rule]) -> tuple[int, int]:
    """Most words before and behind its trigger that a rule reads: one for each blank."""
    sides = [r.regex.split(f"<{r.trigger}>") for r in rules]
    return tuple(max(_blanks(grammar.parse(side[i])) for side in sides) for i in (0, 1))


RULES = build_rules()
BEFORE, AFTER = reach(RULES)
TRIGGERS = sorted({r.trigger for r in RULES})
#: Every trigger holds one of these; texts without any are passed over.
GATES = ("licen", "copyright", "gpl", "fdl", "spdx", "commons", "cc", "bsd", "wtfpl", "domain", "reserved",
         "permission", "redistribution")
GATE = ("(?i)(?<![0-9a-z\\x{80}-\\x{10ffff}])(?:un)?(?:licen[cs]e|copyright|[al]?gpl|g?fdl|spdx|commons|cc0?(?![0-9a-z])|bsd|wtfpl"
        "|domain|reserved|permission|redistribution)")


def _literal(rules: list[Rule]) -> Column:
    """The rules of every trigger, parsed from one constant that Spark folds once."""
    by_trigger: dict[str, list[dict]] = {}
    for i, r in enumerate(rules):
        by_trigger.setdefault(r.trigger, []).append({"keyword": r.keyword, "regex": r.regex, "label": r.label, "tier": r.tier, "place": i})
    return F.from_json(F.lit(json.dumps(by_trigger)),
                       "map<string, array<struct<keyword: string, regex: string, label: string, tier: int, place: int>>>")


def _n_words(s: Column) -> Column:
    """Words of a string of words joined by single blanks."""
    s = F.trim(s)
    return F.when(s == "", 0).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of
    each row of ``docs(doc_id, text)``.

    ``score`` is the noisy-or of the labels that stay, each once by its tier's
    weight; 0 without any. Null and empty texts have zeros, null places and empty
    labels; texts of any length are read whole. Equal rows have equal results and all
    stay. Extra columns are ignored; an empty table gives an empty result. Of an SPDX
    expression up to three identifiers count."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.regexp_count(text, F.lit(RAW_WORD)).cast("long").alias("n_words"),
                       F.when(text.rlike(GATE), text).otherwise("").alias("gated"))
    rows = rows.withColumn("words", F.array_remove(
        F.split(F.regexp_replace(F.translate("gated", UPPER, LOWER), PLUS, "plus"), SEPARATORS), "")).drop("gated")
    rows = rows.withColumn("at", F.array_compact(F.transform(
        "words", lambda w, i: F.when(w.isin(TRIGGERS), i))))
    word = lambda i: F.get("words", i)

    def base(i: Column) -> Column:
        found = F.lit(None).cast("struct<start: int, label: string>")
        for before, label in BASE:
            n = len(before)
            same = word(i) == "license"
            for k, b in enumerate(before):
                same &= (i >= n) & (F.coalesce(word(i - n + k), F.lit("")) == b)
            found = F.when(same, F.struct((i - n).alias("start"), F.lit(label).alias("label"))).otherwise(found)
        return found

    rows = rows.withColumn("base", F.array_compact(F.transform("at", base)))
    rules = _literal(RULES)

    def context(i: Column) -> Column:
        low = F.greatest(i - BEFORE, F.lit(0))
        return F.struct(i.alias("at"), word(i).alias("trigger"), F.concat(
            F.array_join(F.slice("words", low + 1, i - low), " "), F.lit(" <"), word(i), F.lit("> "),
            F.array_join(F.slice("words", i + 2, F.lit(AFTER)), " ")).alias("text"))

    def matches(c: Column) -> Column:
        fit = F.filter(F.element_at(rules, c["trigger"]), lambda r: F.contains(c["text"], r["keyword"]))
        hits = F.transform(fit, lambda r: F.struct(r["label"].alias("label"), r["tier"].alias("tier"), r["place"].alias("place"),
                                                   _extract(c["text"], r["regex"]).alias("text")))
        hits = F.filter(hits, lambda h: h["text"] != "")
        return F.transform(hits, lambda h: F.struct(
            (c["at"] - _n_words(F.substring_index(h["text"], "<", 1))).alias("start"),
            (-(c["at"] + 1 + _n_words(F.substring_index(h["text"], ">", -1)))).alias("minus_end"),
            h["tier"].alias("tier"), h["place"].alias("place"), h["label"].alias("label")))

    rows = rows.withColumn("found", F.array_sort(F.flatten(F.transform(F.transform("at", context), matches))))
    # of each tier the furthest end so far; labels kept; chance that none is right
    none = F.lit(-1)
    start = F.struct(none.alias("e1"), none.alias("e2"), none.alias("e3"), none.alias("e4"),
                     F.array().cast("array<string>").alias("labels"), F.lit(1.0).alias("miss"))

    def step(a: Column, d: Column) -> Column:
        end, tier = -d["minus_end"], d["tier"]
        covered = F.greatest(*[F.when(tier >= t, a[f"e{t}"]).otherwise(none) for t in range(1, 5)]) >= end
        new = ~covered & ~F.array_contains(a["labels"], d["label"])
        weight = F.element_at(F.create_map(*[F.lit(x) for kv in WEIGHT.items() for x in kv]), tier)
        counts = F.greatest(tier, F.lit(VERSIONED))
        return F.struct(*[F.when(counts == t, F.greatest(a[f"e{t}"], end)).otherwise(a[f"e{t}"]).alias(f"e{t}") for t in range(1, 5)],
                        F.when(new, F.concat(a["labels"], F.array(d["label"]))).otherwise(a["labels"]).alias("labels"),
                        F.when(new, a["miss"] * (1 - weight)).otherwise(a["miss"]).alias("miss"))

    rows = rows.withColumn("kept", F.aggregate("found", start, step))
    base_labels = F.array_sort(F.array_distinct(F.col("base.label")))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"), F.array_max("base.start").cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("kept.labels"))), ",").alias("labels"),
        (1 - F.col("kept.miss")).alias("score"))


def _extract(text: Column, regex: Column) -> Column:
    """The first match of a regex held in a column, or an empty string."""
    return F.coalesce(F.regexp_substr(text, regex), F.lit(""))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
