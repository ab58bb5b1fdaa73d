"""License notices against a search word by word."""

import re

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, clashing, documents, empty, odd
from tickerloom.llm import license_scan
from tickerloom.llm.license_scan import BASE, GAP, NOTICES, SHARE


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(doc_id, text):
    words, base, labels, score = words_of(text), [], set(), 0.0
    for label, phrase in BASE:
        parts = phrase.split()
        base += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i:i + len(parts)] == parts]
    pairs = {}
    for i, pair in enumerate(zip(words, words[1:])):
        pairs.setdefault(pair, []).append(i)
    for label, phrase in NOTICES:
        parts = phrase.split()
        held = {}
        for t, pair in enumerate(zip(parts, parts[1:])):
            for i in pairs.get(pair, []):
                held.setdefault(i - t, set()).add(t)
        for start in held:
            share = len(set().union(*[held.get(start + gap, set()) for gap in range(GAP + 1)])) / (len(parts) - 1)
            if share >= SHARE:
                labels.add(label)
                score = max(score, share)
    places = [i for i, _ in base]
    return (doc_id, len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels | {x for _, x in base})), 1.0 if base else score)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


NOTICE = dict(NOTICES)["bsd"].split()
TEXTS = [
    "CC BY-NC, cc by; CC-BY", "cc by cc by cc by", "cc", "by", "All Rights  RESERVED. all rights reserved", "all rights all rights reserved",
    "GNU General Public License general public license", "general\x00public\x7flicense", "the general-public_license", "generalé public license",
    "generaĸ public license", "licenİse general public lİcense", "worK under the K",
    " ".join(NOTICE).upper(), " ".join(NOTICE[:8] + ["word"] + NOTICE[8:]), " ".join(NOTICE[:6] + NOTICE[8:]), " ".join(NOTICE[::-1]),
    " ".join(NOTICE[:10]), " ".join(NOTICE * 3), "x " * 500 + "released under the MIT license", "Released under a MIT license",
    "Licensed under the Apache License, Version 2.0 and released under the mit license", "\U0001f600cc by\U0001f600", "٣cc by",
]


def test_phrases(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(4)
    found = rows_of(license_scan.scanned(docs))
    assert found == sorted([brute(i, t) for i, t in enumerate(TEXTS)], key=str)
    assert {label for r in found for label in r[6].split(",")} >= {"bsd", "mit", "apache", "cc-by", "gpl", "reserved"}


def test_every_notice_is_found(spark):
    docs = spark.createDataFrame([(i, f"Some words; {p.capitalize()}.") for i, (_, p) in enumerate(BASE + NOTICES)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scanned(docs).collect()}
    for i, (label, phrase) in enumerate(BASE + NOTICES):
        assert label in found[i]["labels"].split(",") and found[i]["score"] == 1.0
        assert len(phrase.split()) <= 60


def test_odd_rows(spark):
    want = sorted([brute(r[0], r[1]) for r in ODD], key=str)
    assert rows_of(license_scan.scanned(odd(spark))) == want == rows_of(license_scan.scanned(clashing(spark)))
    assert license_scan.scanned(empty(spark)).count() == 0


def test_one_long_text_of_places(spark):
    docs = spark.createDataFrame([(1, "cc by " * 30_000), (2, "cc")], "doc_id long, text string")
    assert rows_of(license_scan.scanned(docs)) == [brute(1, "cc by " * 30_000), brute(2, "cc")]


def test_no_python_in_the_plan(spark):
    plan = entry.queries()["op12_licenses"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_query(spark):
    docs = documents()
    assert rows_of(entry.queries()["op12_licenses"](spark, SF)) == sorted([brute(i, t) for i, t in zip(docs.doc_id.tolist(), docs.text)], key=str)
