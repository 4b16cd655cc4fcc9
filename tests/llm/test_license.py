import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text):
    """Every rule at every word, then all pairs of detections."""
    w = words(text)
    places = [(i, label) for label, phrase in L.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    found = []
    for order, label, first, pattern, priority, score in L.rules():
        for i, word in enumerate(w):
            if word == first and (m := re.match(pattern, " ".join(w[i : i + L.WINDOW]), re.ASCII)):
                n = len(m[0].strip(" ").split(" "))
                found.append((i, i + n, (-priority, -n, order), label, score))
    related = lambda a, b: a[0] <= b[0] and a[1] >= b[1] or b[0] <= a[0] and b[1] >= a[1]
    kept = [a for a in found if not any(related(a, b) and b[2] < a[2] for b in found)]
    base = sorted({label for _, label in places})
    starts = [i for i, _ in places]
    score = 1.0 if places else max([0.0, *(d[4] for d in kept)])
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *(d[3] for d in kept)})), score


TEXTS = [
    None, "", " \n.,", "Released under the MIT License.", "UNDER\x00THE-mit_license", "under the mit license under the mit license", "under the mitä license", "Apache License, Version 2.0.", "CC-BY-NC 4.0 cc by nc",
    "Licensed under CC BY-NC-SA 4.0", "SPDX-License-Identifier: GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3.", "Copyright (c) 2019 A. B. All rights reserved.",
    "mit der Lizenz", "licensed under the Foo license", "É under the mit license " + "x " * 3000 + "gpl v2 licence", "Mozilla Public License 2.0, or the GNU Lesser General Public License version 2.1; see the license file",
    "license " * 500 + "cc by 4.0 " * 300,
]


def check(spark, texts):
    rows = [(i, t, "clash", 1.5, [1]) for i, t in enumerate(texts)] + [(None, texts[3], None, None, None), (3, texts[3], "", 0.0, [])]
    got = L.license_scan(spark.createDataFrame(rows, "doc_id long, text string, labels string, score double, words array<int>"))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(repr((i, *plain(t))) for i, t, *_ in rows)


def test_odd_texts_equal_plain_python(spark):
    check(spark, TEXTS)


@pytest.mark.parametrize("seed", range(2))
def test_mixed_rule_words_equal_plain_python(spark, seed):
    r = random.Random(seed)
    bits = sorted({w for *_, pattern, _, _ in L.rules() for w in re.findall(r"[a-z]{2,}|\d", pattern.replace("[cs]", "s").replace("|$", ""))})
    phrases = ["gnu general public license", "under the mit license", "creative commons attribution", "version 3", "cc by nc", "apache license version 2 0", "public domain", "licensed under the"]
    texts = [" ".join(r.choice(phrases) if r.random() < 0.4 else r.choice(bits) for _ in range(r.randint(1, 60))) for _ in range(120)]
    check(spark, texts)


def test_empty_table_and_spans(spark):
    docs = spark.createDataFrame([(1, "see GPL v3.")], "doc_id long, text string")
    assert L.license_scan(docs.limit(0)).count() == 0
    assert [tuple(d) for d in L.license_scan(docs).first().detections] == [(1, 3, "gpl-3", 0.75)]


def test_priority_and_containment(spark):
    texts = ["licensed under the gnu lesser general public license version 3", "creative commons attribution noncommercial 4 0", "licensed under the foo license", "licensed under the mit license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in L.license_scan(docs).orderBy("doc_id").collect()] == ["lgpl-3", "cc-by-nc", "unknown", "mit"]


@pytest.mark.parametrize("part", range(4))
def test_every_match_holds_a_keyword(part):
    gate = re.compile("|".join(L.KEYWORDS) + "|" + L.CC_BY)
    for order, *_, pattern, _, _ in L.rules()[part::4]:

        @settings(max_examples=25, database=None, deadline=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(re.compile(pattern.replace(".{", "[a-z ]{"), re.ASCII), fullmatch=True))
        def one(text):
            assert gate.search(text), (order, pattern, text)

        one()


def test_rules_are_many_ordered_and_native(spark):
    assert len(L.rules()) >= 300 and [r[0] for r in L.rules()] == list(range(len(L.rules())))
    plan = L.license_scan(spark.createDataFrame([(1, "x")], "doc_id long, text string").repartition(2).withColumn("text", F.lower("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
