"""Ranked search by bag classes, against a search that scores every document for every item."""

import math
import re
from collections import Counter

from helpers import LONG, TEXTS, documents
from tidegate.llm.bag_search import bag_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [(1, "The lazy DOG, near the river"), (2, "one two"), (3, "word5x5 word6x6 tail"), (4, ""), (5, None),
         (6, "nothing here matches qqqq"), (7, "日本語 é"), (None, "fox jumps"), (1, "The lazy DOG, near the river")]


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(rows, items, top=10):
    bags = [(i, terms(t)) for i, t in rows]
    bags = [(i, len(ws), Counter(ws)) for i, ws in bags]
    n_docs, n_terms = sum(n > 0 for _, n, _ in bags), sum(n for _, n, _ in bags)
    df = Counter(w for _, _, bag in bags for w in bag)
    out = []
    for item, text in set(items):
        found = []
        for i, n, bag in bags:
            m = 10 + 90 * n * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * bag[w] // (1000 * bag[w] + 8 * m))
                        for w in set(terms(text)) if w in bag)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' AS doc_id", "'clash' AS score")


def test_awkward_texts(spark):
    rows = TEXTS + [(i, "one lazy river") for i in range(100, 140)] + [(i, f"two lazy {i}") for i in range(60, 75)]
    assert found(bag_search(spark, documents(spark, rows), items_of(spark, ITEMS))) == brute_force(rows, ITEMS)


def test_ties_follow_the_ids_across_classes(spark):
    """Classes that differ in a word without weight for the item tie; their members interleave."""
    rows = [(i, f"apple {'pear' if i % 2 else 'plum'} x") for i in range(40, 0, -1)] + [(i, "filler text only here") for i in range(200, 300)]
    items = [(1, "apple"), (2, "pear plum"), (3, "apple plum")]
    assert found(bag_search(spark, documents(spark, rows), items_of(spark, items))) == brute_force(rows, items)


def test_blocks_of_items_give_the_same(spark):
    rows = TEXTS + [(i, f"river {i % 5} two fox") for i in range(300, 330)]
    assert found(bag_search(spark, documents(spark, rows), items_of(spark, ITEMS), top=3, block=4)) == brute_force(rows, ITEMS, 3)


def test_words_over_slices_and_classes_over_batches(spark, monkeypatch):
    from tidegate.llm import bag_search as module

    text = LONG + " dog " + "日" * 3000 + " dog"
    monkeypatch.setattr(module, "SLICE", 1000)
    assert Counter(w for some in module.words(text) for w in some) == Counter(w.encode() for w in terms(text))
    assert [len(s) for s in module.words("")] == []


def test_empty_tables(spark):
    assert found(bag_search(spark, documents(spark, []), items_of(spark, ITEMS))) == []
    assert found(bag_search(spark, documents(spark), items_of(spark, []))) == []
    assert found(bag_search(spark, documents(spark, [(1, None), (2, " . ")]), items_of(spark, ITEMS))) == []
