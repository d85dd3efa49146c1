"""License scan, fingerprints, decontamination and revisits: against plain Python, and that no Python runs in the plan."""

import hashlib
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import documents, SCHEMA, TEXTS
from tidegate.llm import merkle, warc
from tidegate.llm.decontamination import contaminated, without_benchmark
from tidegate.llm.licenses import license_scan
from tidegate.llm.merkle import edited_places, fingerprint, likeness, merkle_fingerprints

LICENSED = [
    (1, "Released under the MIT License. Or the mit-license; general public license"), (2, None), (3, ""), (3, ""),
    (4, "apache LICENSE apache license, GNU General\nPublic License v2"), (5, "general license public"), (None, "mit license"),
    (6, "Permission is hereby granted, free of charge, to any human person obtaining copies of this software and "
        "associated documentation files (the Software)"), (7, "All rights reserved."), (8, "License mit apache"),
]
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_base_phrases_against_plain_python(spark):
    df = license_scan(spark, documents(spark, LICENSED))
    no_python(df)
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()]
    want = []
    for i, text in LICENSED:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = sorted((k, label) for p, label in PHRASES.items() for k in range(len(words)) if tuple(words[k:k + len(p)]) == p)
        want.append((i, len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert license_scan(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_edited_license_texts_are_found_over_neighbouring_diagonals(spark):
    rows = {r.doc_id: r for r in license_scan(spark, documents(spark, LICENSED)).collect()}
    half = "redistribution and use in source and binary forms with or without asking is fine"
    twice = license_scan(spark, spark.createDataFrame([(1, half)] * 3, SCHEMA)).collect()
    assert len(twice) == 3 and {(r.labels, r.n_spans) for r in twice} == {("", 0)}
    assert rows[6].labels == "mit" and rows[6].base_labels == "" and 0.6 <= rows[6].score < 1
    assert rows[7].labels == "reserved" and rows[7].score == 1 and rows[8].labels == "" and rows[8].score == 0


@pytest.mark.parametrize("bucket_rows", [1, 3, 2000])
def test_fingerprints_against_plain_python(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(merkle, "BUCKET_ROWS", bucket_rows)
    df = merkle_fingerprints(documents(spark))
    no_python(df)
    order = sorted(TEXTS, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    want = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        want.append((i, len(text), hashlib.sha256((text[:len(text) - n] + after[:n]).encode()).hexdigest()))
    got = df.collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    marks = defaultdict(set)
    for r in got:
        marks[next(t or "" for i, t in TEXTS if i == r.doc_id)].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(m) == 1 for m in marks.values()) and len({m for s in marks.values() for m in s}) == len(marks)
    assert merkle_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_branches_show_where_texts_differ(spark):
    rows = [("one\ntwo\n\nthree four\nfive", "one\ntwo\n\nthree 4\nfive"), ("a\nb", "a\nb"), ("a\n\nb", "a"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        "a", edited_places(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("at"),
        likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("near"))
    got = {r.a: ([tuple(p) for p in r.at], r.near) for r in df.collect()}
    assert got["one\ntwo\n\nthree four\nfive"][0] == [(1, 0)] and got["a\nb"] == ([], 1.0)
    assert got["a\n\nb"][0] and got[""][0] and got[""][1] == 0


ITEMS = [(1, "If Anna buys 12 apples and gives 5 of them to Bernd how many apples remain after 12 days"),
         (2, "plain question without any slots that we want to find in documents"), (3, "too short"), (4, None), (None, "x")]


def test_benchmark_items_exact_reworded_and_inconsistent(spark):
    same = ITEMS[0][1]
    renamed = same.replace("Anna", "Clara").replace("Bernd", "David").replace("12", "7").replace("5", "3")
    mixed = same.replace("Anna", "Clara").replace("buys 12", "buys 7")  # 12 stands for 7 once and for 12 once
    docs = [(1, f"Intro text here. {same}. More text follows."), (2, f"lead {renamed} end"), (3, f"lead {mixed} end"),
            (4, "PLAIN question, without any slots -- that we want to find in documents!"), (5, None), (6, ""),
            (7, "plain question without any of those words"), (8, "word " * 3000 + ITEMS[1][1]), (8, "word " * 3000 + ITEMS[1][1]),
            (None, ITEMS[1][1])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = contaminated(spark, documents(spark, docs).drop("item_id"), items)
    no_python(df)
    got = {(r.doc_id, r.item_id): (r.first_word, r.reworded) for r in df.collect()}
    assert got == {(1, 1): (3, False), (2, 1): (1, True), (4, 2): (0, False), (8, 2): (3000, False)}
    kept = without_benchmark(spark, documents(spark, docs), items)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 5, 6, 7]
    assert kept.filter("doc_id IS NULL").count() == 0
    twins = spark.createDataFrame([(1, same), (1, "a clean text with the id of another")], SCHEMA)
    assert [r.text for r in without_benchmark(spark, twins, items).collect()] == ["a clean text with the id of another"]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(spark, documents(spark, docs), empty).collect() == []
    assert contaminated(spark, spark.createDataFrame([], SCHEMA), items).collect() == []


def found_in(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {(r.doc_id, r.item_id): r for r in contaminated(spark, docs, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_benchmark_items_in_other_capitals_and_spacing(spark):
    same = ITEMS[0][1]
    renamed = same.replace("Anna", "Clara").replace("Bernd", "David").replace("12", "7").replace("5", "3")
    texts = [same.lower(), same.upper(), same.title(), same.replace(" ", "  "), same.replace(" ", "\n"), same.replace("to Bernd", "to\nBernd"),
             same.replace("Bernd", '"Bernd"'), same.replace("Anna", "(Anna)"), renamed.replace(" ", "\n"), renamed.replace("David", "“David”"),
             "Question:\n" + renamed, "a heading\n" + renamed, same.lower().replace("12", "7")]
    got = found_in(spark, [f"lead: {t} end" for t in texts] + texts, ITEMS)
    assert set(got) == {(i, 1) for i in range(2 * len(texts))}
    assert all(got[i, 1].coverage == 1 and not got[i, 1].reworded for i in range(8))
    assert all(got[i, 1].reworded for i in range(8, len(texts)))


def test_benchmark_items_of_numbers_and_of_few_words(spark):
    items = [(1, "Compute 12 + 15 - 7 * 3"), (2, "Add 3 17 24 58 and 91"), (3, "Two plus 5?"), (4, "Why"), (5, "7 8 9 10")]
    texts = [f"lead, words: {t}; more text" for _, t in items] + [
        "compute 12 15 7 4 and Add 3 17 24 59 and 91", "COMPUTE 12 15\n7 3 add", "two plus 6", "7 8 9 and 10", "whys"]
    got = found_in(spark, texts, items)
    assert set(got) == {(i, i + 1) for i in range(5)} | {(6, 1)}
    assert all(r.coverage == 1 and not r.reworded for r in got.values()) and got[0, 1].first_word == 2
    # A number-heavy part that is quoted without the rest of the item.
    long = [(1, "Add 3 17 24 58 61 72 83 94 15 26 37 48 59 60 and tell the class it")]
    assert set(found_in(spark, [long[0][1].split(" tell")[0], "add 3 17 24 58 61"], long)) == {(0, 1)}


def test_benchmark_items_with_longer_fillings_and_words_put_in(spark):
    same = ITEMS[0][1]
    texts = [same.replace("5", "2.5"), same.replace("12", "1,200"), same.replace("Bernd", "Mary Ann"),
             same.replace("Anna", "Mary Ann Lee").replace("Bernd", "Jo Ann Poe").replace("12", "1,000,000").replace("5", "0.25"),
             same.replace("how many", "how very many"), same.replace("gives", "then gladly gives")]
    mixed = [same.replace("Anna", "Clara").replace("buys 12", "buys 7").replace("how many", "how very many"),
             same.replace("to Bernd", "to Bernd at school"), same.replace("gives 5 of them", "eats a lot of pears")]
    got = found_in(spark, [f"lead: {t}. End" for t in texts + mixed], ITEMS)
    assert set(got) == {(i, 1) for i in (*range(6), 7)}
    assert all(got[i, 1].coverage == 1 and got[i, 1].first_word == 1 and got[i, 1].reworded == (i < 4) for i in range(6))


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    from tidegate.llm import decontamination

    docs = spark.createDataFrame([(k, f"lead words {t} and more") for k, t in ITEMS if t], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, contaminated(spark, docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK", 3)
    assert sorted(map(tuple, contaminated(spark, docs, items).collect())) == whole and whole


@pytest.mark.parametrize("block, whole", [(40, 0), (2_000_000, 0)])
def test_benchmark_in_blocks_and_shuffled_gives_the_same(spark, monkeypatch, block, whole):
    from tidegate.llm import decontamination

    texts = [t.replace("Anna", "Mary Ann Lee") for _, t in ITEMS if t]
    docs = spark.createDataFrame([(k, f"lead words of Jo Poe {t} and more {t.lower()}") for k, t in enumerate(texts)], SCHEMA)
    items = spark.createDataFrame(ITEMS + [(5, "so few words"), (6, ITEMS[0][1])], "item_id long, text string")
    plain = sorted(map(tuple, contaminated(spark, docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK", block)
    monkeypatch.setattr(decontamination, "WHOLE", whole)
    assert sorted(map(tuple, contaminated(spark, docs, items).collect())) == plain and {p[:2] for p in plain} >= {(0, 1), (0, 6), (1, 2)}


def test_a_long_text_that_repeats_an_item_leaves_the_loop_without_its_arrays(spark):
    """With the text's words in each row found, these 200,000 rows were over 200 GB at once."""
    text = ITEMS[1][1] + " "
    items = spark.createDataFrame([(i, text) for i in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(1, text * 1000 + "other " * 10_000)], SCHEMA)
    assert {tuple(r)[:4] for r in contaminated(spark, docs, items).collect()} == {(1, i, 0, 1.0) for i in range(20)}


def test_the_plan_does_not_grow_with_the_benchmark(spark):
    def plan(n):
        items = [(i, f"which {i}st of the words w{i}a w{i}b w{i}c w{i}d w{i}e w{i}f is not here") for i in range(n)]
        docs = spark.createDataFrame([(k, f"lead {t}") for k, t in items[:2]], SCHEMA)
        found = contaminated(spark, docs, spark.createDataFrame(items, "item_id long, text string"))
        assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(0, 0), (1, 1)}
        return len(found._jdf.queryExecution().toString())

    small, large = plan(4), plan(400)
    assert large < 1.1 * small


def test_canonical_urls(spark):
    rows = [("HTTP://User@WWW.Example.com:80/a/b/?b=2&a=1&utm_source=x#f", "example.com/a/b?a=1&b=2"),
            ("https://m.example.com", "example.com"), ("https://example.com/?ref=x", "example.com"), (None, None), ("", "")]
    got = spark.createDataFrame(rows, "u string, want string").select(warc.canonical_url(F.col("u")).alias("got"), "want")
    assert all(r.got == r.want for r in got.collect())


@pytest.mark.parametrize("chunk_rows", [1, 5, 50_000])
def test_revisits_against_plain_python(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(warc, "CHUNK_ROWS", chunk_rows)
    start, rows = datetime(2024, 1, 1), []
    for i in range(60):
        url = "http://hot.example.com/" if i % 3 else f"https://other.example.com/{i % 4}"
        kind = "revisit" if i % 2 else "response"
        tag = f'"{i // 10}"' if i % 5 else None
        rows.append((i, url, start + timedelta(minutes=7 * (i // 2)), kind, {"ETag": tag, "X": str(i)} if tag else {"Date": str(i)}, f"body {i}"))
    rows += [(None, "http://x", start, "revisit", {}, None), (90, None, start, "revisit", {}, None), (91, "http://x/", None, "revisit", {}, None),
             (92, "http://hot.example.com", start, "metadata", None, None), (93, "http://none.example.com", start, "revisit", None, None), rows[5]]
    df = spark.createDataFrame(rows, "record_id long, url string, at timestamp, type string, headers map<string,string>, payload string")
    df = df.selectExpr("*", "1 AS chunk", "2 AS found", "3 AS stored")
    result = warc.resolve_revisits(df)
    no_python(result)
    got = {r.record_id: r for r in result.collect()}
    valid = [r for r in rows if None not in (r[0], r[1], r[2]) and r[3] in ("response", "revisit")]
    canon = lambda u: u.split("://")[1].rstrip("/")
    assert set(got) == {r[0] for r in valid if r[3] == "revisit"}
    for i, url, at, kind, headers, _ in valid:
        if kind != "revisit":
            continue
        earlier = [(r[2], r[0], r) for r in valid if r[3] == "response" and canon(r[1]) == canon(url) and r[2] < at]
        if not earlier:
            assert got[i].outcome == "missing" and got[i].payload_sha256 is None
            continue
        answer = max(earlier, key=lambda e: e[:2])[2]
        assert got[i].response_id == answer[0]
        mine, theirs = headers.get("ETag"), answer[4].get("ETag")
        want = "unverified" if mine is None or theirs is None else "resolved" if mine == theirs else "changed"
        assert got[i].outcome == want
        if want != "changed":
            assert got[i].payload_sha256 == hashlib.sha256(answer[5].encode()).hexdigest()
            assert got[i].headers.get("x") == answer[4].get("X")  # not permitted in a not-modified answer
    assert warc.resolve_revisits(df.limit(0)).collect() == []


def test_benchmark_items_in_a_text_of_a_megabyte(spark):
    """Words by the hundred thousand, an item at the end; neither window nor text is repeated per word."""
    text = " ".join(f"w{i % 5000} and" for i in range(100_000)) + " " + ITEMS[1][1]
    got = found_in(spark, [text], ITEMS)
    assert set(got) == {(0, 2)} and got[0, 2].first_word == 200_000 and got[0, 2].coverage == 1
