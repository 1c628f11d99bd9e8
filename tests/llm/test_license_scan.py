"""The license scan against plain Python, and on odd rows."""

import random
import re


from barsignal.llm.common import prepare
from barsignal.llm.license_rules import BASE, REACH, RULES
from barsignal.llm.license_scan import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LINES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.", "CC-BY 4.0",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: BSD-3-Clause",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "https://creativecommons.org/licenses/by-sa/4.0/", "Licensed under the Frobnicate Public License", "cc by cc by", "all rights",
    "Copyright (c) 2019 somebody. ALL RIGHTS RESERVED", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
]


def by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, base, met = [], set(), []
    for i in range(len(words)):
        tail = " ".join(words[i : i + REACH]) + " "
        for phrase, label in BASE.items():
            if tail.startswith(phrase + " "):
                starts.append(i)
                base.add(label)
        for rule in RULES:
            if words[i] in rule.anchors and f" {rule.gate} " in f" {tail}" and (m := re.match(rule.pattern, tail)):
                met.append((i, i + m[0].count(" "), rule.priority, -rule.order, rule.label))
    def rank(d):
        return d[2], d[1] - d[0], d[3]
    kept = [
        d for d in met
        if not any(((e[0] <= d[0] and e[1] >= d[1]) or (d[0] <= e[0] and d[1] >= e[1])) and rank(e) > rank(d) for e in met)
    ]
    score = max([0.0, *(d[2] / 100 for d in kept), *([0.6] if base else [])])
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {d[4] for d in kept})), score, sorted((d[0], d[1] - d[0], d[4], d[2]) for d in kept),
    )


def scanned(df):
    return [
        (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, sorted(tuple(d) for d in r.detections))
        for r in df.collect()
    ]


def test_scan_equals_plain_python(spark):
    prepare(spark)
    rng = random.Random(3)
    texts = [" ".join(rng.choice([*LINES, "some words between", "license", "Été ÇA", "gnu", "the"]) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    texts += [None, "", "  \n", "...", "xK CC BY cc\tby", " ".join(LINES * 40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert scanned(license_scan(df).orderBy("doc_id")) == [by_hand(t) for t in texts]


def test_odd_tables(spark):
    prepare(spark)
    schema = "doc_id long, text string, labels string, score int, _found int, `_found_` int"
    rows = [(None, LINES[0], "x", 1, 2, 3), (1, LINES[0], "x", 1, 2, 3), (1, LINES[0], "x", 1, 2, 3), (2, None, "x", 1, 2, 3)]
    out = license_scan(spark.createDataFrame(rows, schema))
    got = sorted((r["_found"], r["_found_"], r.labels, r.score) for r in out.collect())
    assert got == [(2, 3, "", 0.0), *[(2, 3, "apache-2.0", 0.7)] * 3]
    assert license_scan(spark.createDataFrame([], schema)).count() == 0


def test_long_text_of_licenses(spark):
    prepare(spark)
    text = " ".join(["MIT License"] * 20_000)
    row = license_scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()[0]
    assert (row.n_words, row.labels, len(row.detections)) == (40_000, "mit", 20_000)


def test_no_python_worker(spark):
    df = license_scan(spark.createDataFrame([(1, "a")], "doc_id int, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
