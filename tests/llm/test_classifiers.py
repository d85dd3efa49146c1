import random

import numpy as np
import pyarrow as pa

from helpers import documents, LONG, SCHEMA, TEXTS
from tidegate.llm import quality, toxicity
from tidegate.llm.quality import FEATURES, features, fit, keep_good, quality_scores
from tidegate.llm.toxicity import keep_harmless, toxicity_scores

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400):
    """Clean prose, shouting and symbol noise (bad), and prose with slurs or unseen forms of a stem (toxic)."""
    rng = random.Random(1)
    words = ["".join(rng.choice(("ka", "lo", "mi", "te", "ru", "sa", "no")) for _ in range(rng.randint(1, 4))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        bad, toxic = i % 5 == 0, i % 4 == 1
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(("idiot", "scum", "vraq" + rng.choice(words)))
        if bad:
            text = [w.upper() + "!!" if i % 2 else w + "$$$" for w in text]
        docs.append((i, " ".join(text)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def test_quality_separates_held_out_documents(spark):
    docs, labels = corpus()
    rows = quality_scores(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    good = {i: q for i, q, _ in labels}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and held and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == good[r.doc_id] for r in held) >= 0.97 * len(held)


def test_toxicity_separates_held_out_documents(spark):
    docs, labels = corpus()
    rows = toxicity_scores(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    toxic = {i: t for i, _, t in labels}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = corpus(120)
    d = spark.createDataFrame(docs, SCHEMA)
    import zlib

    def flipped(modulus, remainder, at):
        return [tuple(1 - v if k == at and zlib.crc32(str(r[0]).encode()) % modulus == remainder else v for k, v in enumerate(r)) for r in labels]

    for run, change in ((quality_scores, flipped(5, 0, 1)), (toxicity_scores, flipped(3, 1, 2))):
        a, b = (sorted(map(tuple, run(d, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, change))
        assert a == b


def test_awkward_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0), (777, 0, 1)], LABELS)
    for labels in (none, odd):
        for run, keep, share in ((quality_scores, keep_good, 1), (toxicity_scores, keep_harmless, 0)):
            df = documents(spark)
            rows = run(df, labels).collect()
            assert len(rows) == len(TEXTS) and all(r.predicted == share for r in rows)
            assert keep(df, labels).columns == df.columns and keep(df, labels).count() == len(TEXTS)
            assert run(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_features_do_not_depend_on_the_neighbours():
    texts = [t for _, t in TEXTS]
    whole = features(pa.array(texts))
    assert whole.shape == (len(texts), len(FEATURES)) and np.isfinite(whole).all()
    for i, t in enumerate(texts):
        assert np.allclose(features(pa.array([t], pa.string())), whole[i])


def test_ranking_prefers_the_good_ones():
    x = np.random.default_rng(0).normal(size=(300, len(FEATURES)))
    good = x[:, 2] + 0.1 * x[:, 3] > -0.8
    model = fit(x, good)
    assert np.mean((model.strength(x) >= model.cut) == good) > 0.97


def test_gradient_against_differences():
    """The hand-written backward pass, checked numerically."""
    rng = np.random.default_rng(2)
    p = {k: rng.normal(0, 0.4, s) for k, s in toxicity._shapes().items()}
    p["word"], p["gram"] = (rng.normal(0, 0.4, (6, toxicity.DIM)) for _ in range(2))
    words = [np.array([1, 2, 3]), np.array([4, 5])]
    grams = [np.array([1, 2, 3, 4]), np.array([5, 1, 2])]
    firsts = [np.array([0, 1, 3, 4]), np.array([0, 2, 3])]
    target, own = np.array([1.0, 0.0]), [np.zeros((2, 6)), np.zeros((2, 6))]

    def loss():
        out = 0
        for w, g, f, y in zip(words, grams, firsts, target):
            chars = np.maximum.reduceat(p["gram"][g], f[:-1], axis=0)
            x = np.concatenate((p["word"][w], chars), axis=1)[:, None]
            live = np.ones((len(w), 1))
            states = np.concatenate([toxicity._run_gru(x @ p[f"in_{d}"] + p[f"bias_{d}"], live, p[f"rec_{d}"], d == "b") for d in "fb"], axis=2)
            z = toxicity._pool(states, live, p)[2] @ p["out"] + p["out_b"][0]
            q = 1 / (1 + np.exp(-z[0]))
            out -= y * np.log(q) + (1 - y) * np.log(1 - q)
        return out / len(words)

    grad = toxicity._gradient(p, words, grams, firsts, target, own)
    for name, value in p.items():
        flat = value.reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-5 - grad[name].reshape(-1)[i]) < 2e-3, name


def test_every_window_of_a_long_text_counts():
    """The worst place of a text decides, wherever it stands."""
    docs, labels = corpus(200)
    windows = []
    for batch in toxicity._training_windows([pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in docs]), pa.array([x[2] for x in labels], pa.int32()), pa.array([d[1] for d in docs])],
            names=["number", "toxic", "text"])]):
        for n, t, w, r, f in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5))):
            windows.append((n, t == 1, np.array(w).view(np.uint64), np.array(r).view(np.uint64), np.array(f)))
    net = toxicity.train(windows)
    clean = " ".join(docs[0][1].replace("$$$", "").lower().split() * 30)
    words = clean.split()
    texts = [clean] + [" ".join(words[:k] + ["idiot", "scum"] + words[k:]) for k in (0, len(words) // 2, len(words))]
    logits, counts = net.worst_windows(pa.array([*texts, "", None, LONG]))
    assert all(x > logits[0] + 1 for x in logits[1:4]) and counts[4] == counts[5] == 0 and counts[6] > 500


def test_ranking_is_fitted_on_all_labelled_rows(spark):
    """Groups of any size count every labelled row, and one group agrees with the fit in memory."""
    docs, labels = corpus(300)
    docs, labels = docs + [(1000 + i, t) for i, t in docs[:40]], labels + [(1000 + i, q, t) for i, q, t in labels[:40]]
    d, l = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    text, good = dict(docs), {i: q for i, q, _ in labels}
    import zlib
    fitted = [i for i in text if zlib.crc32(str(i).encode()) % 5]
    x, y = features(pa.array([text[i] for i in fitted])), np.array([good[i] for i in fitted]) == 1
    local, whole = fit(x, y), quality.fit_ranking(d, l)
    for name in ("mean", "scale", "weights", "cut"):
        assert np.allclose(getattr(local, name), getattr(whole, name), atol=1e-6), name
    cut_up = quality.fit_ranking(d, l, group=20)
    assert np.allclose(cut_up.mean, whole.mean) and np.allclose(cut_up.scale, whole.scale)
    assert np.mean((cut_up.strength(x) >= cut_up.cut) == y) >= 0.97
    assert not hasattr(quality, "SAMPLE") and not hasattr(quality, "PAIRS")


def test_numbers_of_values_in_half_the_memory():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 50, n).astype(np.uint64) for n in (5, 0, 40, 1)]
    values, ids = toxicity._numbered(parts)
    expected, places = np.unique(np.concatenate(parts), return_inverse=True)
    assert (values == expected).all() and (ids == places).all() and ids.dtype == np.int32
