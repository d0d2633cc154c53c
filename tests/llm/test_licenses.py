"""License scan: base phrases against brute force, rules on known notices."""

import random
import re

from almanac.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hits = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, words string, at int")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_base_equals_brute_force(spark):
    rng = random.Random(0)
    parts = ["mit", "MIT", "license", "License", "apache", "general", "public", "x", "é", "lİcense", "licensé", "a1"]
    seps = [" ", "  ", "-", "\n", ".", "/", "\x00", "[", "`", "{", "\x7f", "_", "@"]
    texts = ["".join(rng.choice(parts) + rng.choice(seps) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += [None, "", "...", "mit license " * 2000, "word " * 30000 + "mit license", "LICENSE mit", "K license MIT K", "ſ mit license"]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t[:80] if t else t
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


NOTICES = {
    "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "licensed under CC BY 3.0": "cc-by-3.0",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International": "cc-by-nc-sa-4.0",
    "GNU Lesser General Public License v2.1 or later": "gpl,lgpl-2.1-or-later",  # gpl: base phrase
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "Mozilla Public License 2.0": "mpl-2.0",
    "GPLv3": "gpl-3.0",
    "This file is under the 3-Clause BSD License": "bsd-3-clause",
    "dedicated to the public domain": "public-domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it": "mit",
    "a driving licence for cars": "license-mention",
    "nothing of the kind": "",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2.0,mit",
    "// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) AND MIT */": "bsd-3-clause,gpl-2.0,mit",
    "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 OR MPL-2.0 OR LGPL-2.1+": "gpl-2.0-or-later,lgpl-2.1-or-later,mpl-2.0",
    "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception AND NCSA and more words": "apache-2.0,ncsa",
    "SPDX-License-Identifier: MIT\nthis file and that or zlib": "mit",
    "SPDX-License-Identifier: BSD": "bsd",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa-4.0",
    # the canonical GNU notices; the base phrase gpl always counts
    **{f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
       f"as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later "
       "version.": label
       for name, v, label in (("General Public License", "2", "gpl,gpl-2.0-or-later"),
                              ("General Public License", "3", "gpl,gpl-3.0-or-later"),
                              ("Lesser General Public License", "2.1", "gpl,lgpl-2.1-or-later"),
                              ("Affero General Public License", "3", "agpl-3.0-or-later,gpl"))},
    **{f"SPDX-License-Identifier: {stem}{form}": label
       for stem, label in (("GPL-2.0", "gpl-2.0"), ("LGPL-2.1", "lgpl-2.1"), ("AGPL-3.0", "agpl-3.0"))
       for form, label in (("", label), ("-only", label), ("-or-later", f"{label}-or-later"), ("+", f"{label}-or-later"))},
}


def test_notices(spark):
    texts = list(NOTICES)
    got = run(spark, texts)
    assert {t: got[i].labels for i, t in enumerate(texts)} == NOTICES


def test_context_holds_the_longest_rule():
    assert licenses.reach([licenses.Rule("x", "x", r"(?:a b )?(?<!c )d <x>(?: \w+){0,3}?(?: e|, f g)", "x", 1)]) == (4, 5)
    assert (licenses.BEFORE, licenses.AFTER) == licenses.reach(licenses.RULES)


def test_containment_not_overlap(spark):
    # the versioned name covers the bare one; two notices side by side both stay
    got = run(spark, ["Apache License 2.0 Apache License 1.1", "all rights reserved copyright 2020 x"])
    assert got[0].labels == "apache,apache-1.1,apache-2.0"
    assert got[1].labels == "all-rights-reserved,copyright"


def test_every_trigger_passes_the_gate():
    gate = re.compile(licenses.GATE.replace(r"\x{80}-\x{10ffff}", "\x80-\U0010ffff"))
    assert all(gate.search(t) and gate.search(f"x {t.upper()} y") for t in licenses.TRIGGERS)
    assert all(f"<{r.trigger}>" in r.regex for r in licenses.RULES)
    for r in licenses.RULES:
        re.compile(r.regex)


def test_native_plan(spark, sf_dir):
    plan = licenses.op3_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in licenses.op3_license_scan(spark, sf_dir).collect()}
    for d in rows:
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(d.text)


def test_empty(spark):
    assert run(spark, []) == {}
