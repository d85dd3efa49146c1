"""Labels and scores of the license scan, against a scan of all bands of diagonals in plain Python."""

import random
import re
from collections import defaultdict

from tidegate.llm.licenses import BAND, BASE, LEAST_SHARE, TEXTS, license_scan

SCHEMA = "doc_id long, text string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(text):
    words, labels, score = words_of(text), set(), 0.0
    for phrase, label in BASE.items():
        parts = phrase.split()
        if any(words[k:k + len(parts)] == parts for k in range(len(words))):
            labels.add(label)
            score = 1.0
    for phrase, label in TEXTS.items():
        parts = phrase.split()
        votes = defaultdict(set)
        for place in range(len(words) - 1):
            for at in range(len(parts) - 1):
                if words[place:place + 2] == parts[at:at + 2]:
                    votes[place - at].add(at)
        for first in votes:
            matches = sorted((at, at + d) for d in votes if first <= d <= first + BAND for at in votes[d])
            last_at, last_place, n = -1, -1, 0
            for at, place in matches:
                if at > last_at and place > last_place:
                    last_at, last_place, n = at, place, n + 1
            if n / (len(parts) - 1) >= LEAST_SHARE:
                labels.add(label)
                score = max(score, n / (len(parts) - 1))
    return ",".join(sorted(labels)), score


def edited(pick, phrase):
    words = phrase.split()
    for _ in range(pick.randrange(0, 6)):
        k = pick.randrange(len(words) + 1)
        words[k:k + pick.randrange(0, 3)] = pick.choices(["the", "any", "software", "this"], k=pick.randrange(0, 3))
    return " ".join(words)


def test_labels_and_scores_of_edited_texts(spark):
    pick = random.Random(4)
    phrases = [*TEXTS, *BASE]
    rows = [(i, " ".join(edited(pick, pick.choice(phrases)) for _ in range(pick.randrange(1, 4)))) for i in range(150)]
    rows += [(1000, "this work is this work is this work is this work is"), (1001, "license of the free software you can " * 40)]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: brute_force(t) for i, t in rows}
    assert got[1000] == ("", 0.0) and len({x for x, _ in got.values()}) > 10


def test_a_text_of_a_megabyte(spark):
    text = "all rights are not reserved here, " * 30_000 + " ".join(TEXTS)
    row, = license_scan(spark, spark.createDataFrame([(1, text)], SCHEMA)).collect()
    assert set(row.labels.split(",")) >= set(TEXTS.values()) and row.score == 1 and row.n_words == len(words_of(text))
