import random

import numpy as np

from helpers import documents, near_duplicate_groups, shingles, SCHEMA, TEXTS
from tidegate.llm import parity_join
from tidegate.llm.components import components
from tidegate.llm.parity_join import BAND_TOPS, _bands, ngram_jaccard_components, one_of_each_group


def _check(spark, rows, df=None):
    got = ngram_jaccard_components(spark, df if df is not None else spark.createDataFrame(rows, SCHEMA)).collect()
    want = near_duplicate_groups(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted(
        (i is None, i or 0, len(shingles(t))) for i, t in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_awkward_rows_against_brute_force(spark):
    _check(spark, TEXTS, documents(spark))


def test_empty_table(spark):
    assert ngram_jaccard_components(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_groups_of_edited_copies_and_shared_passages(spark):
    """Copies around the threshold, chains, and a passage that unrelated texts share."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for size in (6, 9, 14, 22, 40, 90, 250, 700):
        for _ in range(3):
            base = [rng.choice(words) for _ in range(size)]
            for _ in range(9):
                text = list(base)
                for _ in range(rng.randint(0, max(1, size // 18))):
                    text[rng.randrange(len(text))] = rng.choice(words)
                if rng.random() < 0.3:
                    text = text[: -max(1, size // 12)]
                rows.append((len(rows), " ".join(text)))
    for _ in range(60):
        rows.append((len(rows), " ".join([rng.choice(words) for _ in range(60)] + passage + [rng.choice(words) for _ in range(9)])))
    _check(spark, rows)


def _crowd(n, size, seed=5):
    """Texts that share a passage of ``size`` words and nothing else, but for a few near copies among them."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(size)]
    rows = [(i, " ".join([f"a{rng.random()}" for _ in range(50)] + passage + [f"b{rng.random()}" for _ in range(9)])) for i in range(n)]
    return rows + [(n + i, rows[7 * i][1] + " more at the end") for i in range(n // 10)]


def test_crowds_around_a_passage_against_brute_force(spark, monkeypatch):
    """Groups beyond the limit are joined on rare shingles; so are groups of two if the limit is 0."""
    _check(spark, _crowd(150, 60))
    monkeypatch.setattr(parity_join, "CROWD", 0)
    test_groups_of_edited_copies_and_shared_passages(spark)


def test_a_crowd_is_not_compared_in_all_pairs(spark, monkeypatch):
    """Where n texts share a passage, the pairs compared are about as many as the near copies among them."""
    counted = []
    monkeypatch.setattr(parity_join, "_pairs", lambda members, accept, real=parity_join._pairs: _noted(real(members, accept), counted))
    n = 300
    monkeypatch.setattr(parity_join, "_rare_pairs", lambda rare, real=parity_join._rare_pairs: _noted(real(rare), counted))
    parity_join.ngram_jaccard_components(spark, spark.createDataFrame(_crowd(n, 60), SCHEMA)).count()
    assert sum(counted) <= 12 * n


def test_a_passage_of_most_of_the_text_is_not_compared_in_all_pairs(spark, monkeypatch):
    """Texts that share four fifths of their words, not enough for a link, and some near copies among them."""
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(84)]
    rows = [(i, " ".join([f"a{rng.random()}" for _ in range(20)] + passage)) for i in range(200)]
    rows += [(200 + i, rows[9 * i][1] + " more") for i in range(20)] + [(300, " ".join(passage)), (301, " ".join(passage[:-4]))]
    counted = []
    monkeypatch.setattr(parity_join, "_rare_pairs", lambda rare, real=parity_join._rare_pairs: _noted(real(rare), counted))
    _check(spark, rows)
    assert 0 < len(counted) and sum(counted) <= 3 * len(rows)


def test_rows_of_the_rare_join_grow_with_the_table(spark, monkeypatch):
    """Whether few or many texts share a passage, each is cut into as many rare shingles, once, and compared with as many texts."""
    rare, compared = [], []
    cut = lambda held, real=parity_join._outside: real(_noted(held, rare) if "rest" in held.columns else held)
    monkeypatch.setattr(parity_join, "_outside", cut)
    for name in ("_pairs", "_rare_pairs"):
        monkeypatch.setattr(parity_join, name, lambda *a, real=getattr(parity_join, name): _noted(real(*a), compared))
    sums = []
    for n in (40, 400):
        rare.clear(), compared.clear()
        rows = _crowd(n, 60)
        assert {r.doc_id: r.component_id for r in ngram_jaccard_components(spark, spark.createDataFrame(rows, SCHEMA)).collect()} == (
            near_duplicate_groups(rows))
        sums.append((sum(rare), sum(compared)))
    assert 0 < sums[0][0] and sums[1][0] <= 12 * sums[0][0] and sums[0][1] <= 3 * 40 and sums[1][1] <= 3 * 400


def _noted(pairs, counted):
    counted.append(pairs.count())
    return pairs


def test_exact_setting_joins_all_words(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(900)]
    rows = [(i, " ".join(base[:900 - 20 * i])) for i in range(8)] + [(20 + i, t) for i, t in TEXTS if i in (1, 3, 9, 10)]
    got = {r.doc_id: r.component_id for r in ngram_jaccard_components(
        spark, spark.createDataFrame(rows, SCHEMA), exact=True).collect()}
    assert got == near_duplicate_groups(rows)


def test_words_of_two_letters_that_a_polynomial_confuses_do_not_link(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    _check(spark, [(1, word), (2, other), (3, f"x y {word} z"), (4, f"x y {other} z")])


def test_documents_with_two_texts_join_their_groups(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    _check(spark, [(5, a), (3, b), (9, a), (9, b), (4, a)])


def test_bands_let_every_linkable_pair_of_sizes_meet():
    for small in [*range(1, 400), 1000, 50_000]:
        for large in range(small, small * 4 // 3 + 1, max(1, small // 50)):
            assert set(_bands(small)) & set(_bands(large)) >= {int(np.searchsorted(BAND_TOPS, large))}


def test_components_of_a_chain_and_of_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (None, 5), (7, None), (200, 200)]
    got = dict(map(tuple, components(spark, spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200}


def test_one_of_each_group_keeps_the_smallest_id_and_rows_without_id(spark):
    df = documents(spark)
    kept = one_of_each_group(spark, df)
    assert kept.columns == df.columns
    groups = near_duplicate_groups(TEXTS)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(groups.values()))
    assert kept.filter("doc_id IS NULL").count() == 1
    twins = spark.createDataFrame([(1, "one text of its own that nothing else is like"), (1, "another text with the same id but other words"),
                                   (None, "another text with the same id but other words"), (1, "one text of its own that nothing else is like")],
                                  "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:3]) for r in one_of_each_group(spark, twins).collect()) == [(1, "ano"), (1, "one")]
