"""Toxicity by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A text is cut into overlapping windows of words. A step of the network sees one word: a vector of the word itself (known
words only) and one of its characters (the largest value, per dimension, over its runs of RUN bytes), so that unseen
forms of known stems count too. Two gated recurrent layers read the window forwards and backwards, attention weighs the
steps, and a logistic unit judges the pooled state. A text is as toxic as its worst window; a calibration fitted on
whole training texts turns that into the score. Every window of every text is scored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import held_out
from .spans import IS_BLANK, LOWER, byte_table, pieces, span_hashes, spans

#: Training documents of either label, those with the smallest hash of their id; all if there are fewer.
SAMPLE = 1500
#: Training windows, those with the smallest hash; all if there are fewer.
SAMPLE_WINDOWS = 24_000
STEPS, STRIDE = 32, 24
RUN = 4
DIM, HIDDEN, ATTEND = 4, 6, 6
VOCABULARY = 4_000
#: Training documents that must hold a word or run for it to be known; rarer ones only tell documents apart.
LEAST_DOCUMENTS = 4
UPDATES, BATCH, RATE = 300, 256, 0.01
#: Embeddings begin with the evidence of the training documents and move slowly, lest they learn documents by heart.
RATES = {"word": 0.0003, "gram": 0.0003}
#: Windows scored at a time.
SLICE = 512
THRESHOLD = 0.7
PUNCTUATION = byte_table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


# ---- texts as numbers

def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of RUN bytes of each word, with an underscore before and after it: (packed runs, first run of each word)."""
    lengths = ends - starts
    padded = np.maximum(lengths + 2, RUN)
    at = np.concatenate(([0], np.cumsum(padded)))
    text = np.full(at[-1], 95, np.uint64)
    inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text[np.repeat(at[:-1] + 1, lengths) + inner] = data[np.repeat(starts, lengths) + inner]
    packed = text
    for k in range(1, RUN):
        packed = packed[:-1] << np.uint64(8) | text[k:]
    count = padded - RUN + 1
    first = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(first[-1]) + np.repeat(at[:-1] - first[:-1], count)
    return packed[place], first


def _words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words without the punctuation around them: distinct hashes, their spans, and each word's number."""
    lowered = LOWER[data]
    starts, ends, owner = spans(~(IS_BLANK[lowered] | PUNCTUATION[lowered]), offsets)
    hashes, place, which = np.unique(span_hashes(lowered, starts, ends), return_index=True, return_inverse=True)
    return lowered, hashes, starts[place], ends[place], which, owner


def _windows(owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, number of words) of each window; a text without words has none."""
    counts = np.bincount(owner, minlength=n_texts)
    per_text = np.where(counts == 0, 0, 1 + np.maximum(0, -(-(counts - STEPS) // STRIDE)))
    text = np.repeat(np.arange(n_texts), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = (np.cumsum(counts) - counts)[text] + nth * STRIDE
    return text, begin, np.minimum(STEPS, counts[text] - nth * STRIDE)


def _known(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value among the sorted keys, plus one; 0 if it isn't there."""
    if not len(keys):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at + 1, 0)


# ---- the network

def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _shapes() -> dict[str, tuple[int, ...]]:
    gates = 3 * HIDDEN
    return {"in_f": (2 * DIM, gates), "in_b": (2 * DIM, gates), "bias_f": (gates,), "bias_b": (gates,),
            "rec_f": (HIDDEN, gates), "rec_b": (HIDDEN, gates), "att": (2 * HIDDEN, ATTEND), "att_v": (ATTEND,),
            "out": (2 * HIDDEN,), "out_b": (1,)}


def _run_gru(x: np.ndarray, live: np.ndarray, rec: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
    """x (steps, windows, gates) → states (steps, windows, hidden). A step beyond the window leaves the state alone."""
    h = np.zeros((x.shape[1], HIDDEN), x.dtype)
    out = np.zeros((*x.shape[:2], HIDDEN), x.dtype)
    for t in reversed(range(len(x))) if backwards else range(len(x)):
        own = h @ rec
        gate = _sigmoid(x[t, :, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
        reset, update = gate[:, :HIDDEN], gate[:, HIDDEN:]
        new = np.tanh(x[t, :, 2 * HIDDEN:] + reset * own[:, 2 * HIDDEN:])
        m = live[t, :, None]
        after = h + m * (1 - update) * (new - h)
        if keep is not None:
            keep.append((t, h, own, reset, update, new, m))
        out[t] = h = after
    return out


def _gru_gradient(kept: list, rec: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients for the gates' inputs and for the recurrent weights."""
    d_x = np.zeros((*d_out.shape[:2], 3 * HIDDEN), d_out.dtype)
    d_rec, d_h = np.zeros_like(rec), np.zeros((d_out.shape[1], HIDDEN), d_out.dtype)
    for t, h, own, reset, update, new, m in reversed(kept):
        d = d_h + d_out[t]
        d_new = d * m * (1 - update) * (1 - new * new)
        d_update = -d * m * (new - h) * update * (1 - update)
        d_reset = d_new * own[:, 2 * HIDDEN:] * reset * (1 - reset)
        d_x[t] = np.concatenate((d_reset, d_update, d_new), axis=1)
        d_own = np.concatenate((d_reset, d_update, d_new * reset), axis=1)
        d_rec += h.T @ d_own
        d_h = d * (1 - m * (1 - update)) + d_own @ rec.T
    return d_x, d_rec


def _pool(states: np.ndarray, live: np.ndarray, p: dict):
    """Attention over the live steps."""
    bent = np.tanh(states @ p["att"])
    raw = np.where(live > 0, bent @ p["att_v"], -1e9)
    weight = np.exp(raw - raw.max(0)) * live
    weight /= np.maximum(weight.sum(0), 1e-9)
    return bent, weight, np.einsum("tw,twh->wh", weight, states)


@dataclass
class Network:
    words: np.ndarray      # hashes of the known words, sorted
    grams: np.ndarray      # known runs of bytes, sorted
    p: dict                # arrays by name; "word" and "gram" are the embeddings, with row 0 for the unknown
    calibration: np.ndarray

    def word_inputs(self, data, offsets):
        lowered, hashes, starts, ends, which, owner = _words(data, offsets)
        if not len(hashes):
            return np.zeros((0, 2 * DIM), np.float32), which, owner
        runs, first = _grams(lowered, starts, ends)
        of_chars = np.maximum.reduceat(self.p["gram"][_known(self.grams, runs)], first[:-1], axis=0)
        return np.concatenate((self.p["word"][_known(self.words, hashes)], of_chars), axis=1), which, owner

    def worst_windows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The largest window logit of every text (0 without words) and its number of windows."""
        p = self.p
        best, number = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for first, data, offsets in pieces(texts):
            inputs, which, owner = self.word_inputs(data, offsets)
            text, begin, count = _windows(owner, len(offsets) - 1)
            number[first: first + len(offsets) - 1] = np.bincount(text, minlength=len(offsets) - 1)
            if not len(text):
                continue
            gates = [inputs @ p[f"in_{d}"] + p[f"bias_{d}"] for d in "fb"]
            worst = np.full(len(offsets) - 1, -np.inf)
            for at in range(0, len(text), SLICE):
                part = slice(at, at + SLICE)
                place = np.arange(STEPS)[:, None]
                live = (place < count[part]).astype(np.float32)
                word = which[np.minimum(begin[part] + place, len(which) - 1)]
                states = np.concatenate([_run_gru(gates[k][word], live, p[f"rec_{d}"], d == "b")
                                         for k, d in enumerate("fb")], axis=2)
                np.maximum.at(worst, text[part], _pool(states, live, p)[2] @ p["out"] + p["out_b"][0])
            best[first: first + len(worst)] = np.where(np.isfinite(worst), worst, 0)
        return best, number

    def score(self, texts: pa.Array) -> np.ndarray:
        """0 for a text without words."""
        best, number = self.worst_windows(texts)
        a, b, c = self.calibration
        return np.where(number > 0, _sigmoid(a * best + b * np.log1p(number) + c), 0.0)


def _evidence(ids: np.ndarray, owner: np.ndarray, toxic: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a document being toxic, by the ids it holds; near 0 where few documents tell, 0 where too few.

    Also what to add, by label, for a training document itself: its odds come from the other documents only.
    """
    pairs = ids.astype(np.int64)
    pairs *= len(toxic)
    pairs += owner
    pairs = np.unique(pairs)
    ids, owner = pairs // len(toxic), pairs % len(toxic)
    bad = np.bincount(ids, toxic[owner], size)
    fine = np.bincount(ids, ~toxic[owner], size)
    n_bad, n_fine = max(1, toxic.sum()), max(1, (~toxic).sum())

    def odds(bad, fine):
        total = bad + fine
        raw = np.log((bad + 0.3) / n_bad) - np.log((fine + 0.3) / n_fine)
        return np.where(total >= LEAST_DOCUMENTS, raw * total / (total + 4), 0)

    whole = odds(bad, fine)
    return whole, np.stack([odds(bad, np.maximum(fine - 1, 0)) - whole, odds(np.maximum(bad - 1, 0), fine) - whole])


def _numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and, for all parts in a row, each value's place among them; without the sorted copies of an inverse."""
    values = np.unique(np.concatenate(parts))
    return values, np.concatenate([np.searchsorted(values, part).astype(np.int32) for part in parts])


def train(windows: list[tuple[int, bool, np.ndarray, np.ndarray, np.ndarray]]) -> Network:
    """windows: (document, toxic, hashes of its words, packed runs, first run of each word)."""
    rng = np.random.default_rng(11)
    docs, owner = np.unique([w[0] for w in windows], return_inverse=True)
    toxic = np.zeros(len(docs), bool)
    toxic[owner] = [w[1] for w in windows]
    lengths = np.array([len(w[2]) for w in windows])
    owner = owner.astype(np.int32)
    words, word_ids = _numbered([w[2] for w in windows])
    grams, gram_ids = _numbered([w[3] for w in windows])
    word_of = np.repeat(owner, lengths)
    gram_of = np.repeat(owner, [len(w[3]) for w in windows])
    (word_odds, word_own), (gram_odds, gram_own) = (_evidence(i, o, toxic, len(k)) for i, o, k in ((word_ids, word_of, words), (gram_ids, gram_of, grams)))

    def top(odds, ids):
        """The known ones: those with the strongest evidence, weighed by how often they occur."""
        weight = np.abs(odds) * np.sqrt(np.bincount(ids, minlength=len(odds)))
        best = np.argsort(-weight, kind="stable")[:VOCABULARY]
        return np.sort(best[weight[best] > 0])

    word_top, gram_top = top(word_odds, word_ids), top(gram_odds, gram_ids)
    p = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in _shapes().items()}
    for name, odds, kept in (("word", word_odds, word_top), ("gram", gram_odds, gram_top)):
        p[name] = rng.normal(0, 0.05, (len(kept) + 1, DIM)).astype(np.float32)
        p[name][0] = 0
        p[name][1:, 0] += odds[kept]
    net = Network(words[word_top], grams[gram_top], p, np.array([1.0, 0.0, 0.0]))

    # In a toxic document the windows with the strongest words are taken as toxic, the others are left out.
    gram_toxic, word_toxic = (toxic[o].astype(int) for o in (gram_of, word_of))
    strength = np.maximum((word_odds + word_own)[word_toxic, word_ids], np.maximum.reduceat(
        (gram_odds + gram_own)[gram_toxic, gram_ids], np.concatenate([w[4][:-1] + at for w, at in zip(
            windows, np.cumsum([0] + [len(w[3]) for w in windows])[:-1])])))
    peak = np.maximum.reduceat(strength, np.cumsum(lengths) - lengths)
    order = np.lexsort((-peak, owner))
    rank = np.empty(len(windows), int)
    rank[order] = np.arange(len(windows)) - np.searchsorted(owner[order], owner[order])
    target = toxic[owner]
    use = np.flatnonzero(~target | (rank < 2))

    known_words = [_known(net.words, w[2]).astype(np.int32) for w in windows]
    known_grams = [_known(net.grams, w[3]).astype(np.int32) for w in windows]
    own = [np.concatenate((np.zeros((2, 1)), o[:, kept]), axis=1).astype(np.float32)
           for o, kept in ((word_own, word_top), (gram_own, gram_top))]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    bad, fine = use[target[use]], use[~target[use]]
    for step in range(1, UPDATES + 1):
        # One toxic window to two clean ones.
        chosen = np.concatenate((rng.choice(bad, BATCH // 3), rng.choice(fine, BATCH - BATCH // 3)))
        grad = _gradient(p, [known_words[i] for i in chosen], [known_grams[i] for i in chosen],
                         [windows[i][4] for i in chosen], target[chosen].astype(np.float32), own)
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p[k] -= RATES.get(k, RATE) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        p["word"][0] = p["gram"][0] = 0
    return net


def _gradient(p: dict, words: list, grams: list, firsts: list, target: np.ndarray, own: list) -> dict:
    """Gradients of the mean logistic loss over some windows; ``own`` corrects the evidence by the window's label."""
    n = len(words)
    lengths = np.array([len(w) for w in words])
    live = (np.arange(STEPS)[:, None] < lengths).astype(np.float32)
    word_ids, gram_ids = np.concatenate(words), np.concatenate(grams)
    shift = np.cumsum([0] + [len(g) for g in grams])[:-1]
    first = np.concatenate([f[:-1] + s for f, s in zip(firsts, shift)])
    label = target.astype(int)
    looked, known = p["gram"][gram_ids], p["word"][word_ids]
    looked[:, 0] += own[1][np.repeat(label, [len(g) for g in grams]), gram_ids]
    known[:, 0] += own[0][np.repeat(label, lengths), word_ids]
    chars = np.maximum.reduceat(looked, first, axis=0)
    inputs = np.concatenate((known, chars), axis=1)
    x = np.zeros((n, STEPS, 2 * DIM), np.float32)
    x[live.T > 0] = inputs
    x = x.transpose(1, 0, 2)
    kept = {d: [] for d in "fb"}
    states = np.concatenate([_run_gru(x @ p[f"in_{d}"] + p[f"bias_{d}"], live, p[f"rec_{d}"], d == "b", kept[d])
                             for d in "fb"], axis=2)
    bent, weight, pooled = _pool(states, live, p)
    d_logit = (_sigmoid(pooled @ p["out"] + p["out_b"][0]) - target) / n
    g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    d_weight = np.einsum("twh,wh->tw", states, d_pooled)
    d_raw = weight * (d_weight - (weight * d_weight).sum(0))
    g["att_v"] = np.einsum("tw,twa->a", d_raw, bent)
    d_bent = d_raw[:, :, None] * p["att_v"] * (1 - bent * bent)
    g["att"] = np.einsum("twh,twa->ha", states, d_bent)
    d_states = weight[:, :, None] * d_pooled + d_bent @ p["att"].T
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        d_gates, g[f"rec_{d}"] = _gru_gradient(kept[d], p[f"rec_{d}"], d_states[:, :, k * HIDDEN:(k + 1) * HIDDEN])
        g[f"in_{d}"] = np.einsum("twi,twg->ig", x, d_gates)
        g[f"bias_{d}"] = d_gates.sum((0, 1))
        d_x += d_gates @ p[f"in_{d}"].T
    d_in = d_x.transpose(1, 0, 2)[live.T > 0]
    g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
    np.add.at(g["word"], word_ids, d_in[:, :DIM])
    per_word = np.diff(np.append(first, len(gram_ids)))
    # The gradient of a maximum goes to the runs that have it.
    won = looked == np.repeat(chars, per_word, axis=0)
    np.add.at(g["gram"], gram_ids, np.where(won, np.repeat(d_in[:, DIM:], per_word, axis=0), 0))
    return {k: v.astype(np.float32) for k, v in g.items()}


# ---- on Spark

def _training_windows(batches):
    """(number, toxic, text) → the windows of the text with the hashes and runs of their words."""
    for batch in batches:
        for first, data, offsets in pieces(batch.column(2)):
            lowered, hashes, starts, ends, which, owner = _words(data, offsets)
            text, begin, count = _windows(owner, len(offsets) - 1)
            rows = []
            for t, b, c in zip(text, begin, count):
                own = which[b: b + c]
                runs, at = _grams(lowered, starts[own], ends[own])
                rows.append((hashes[own].view(np.int64), runs.view(np.int64), at))
            take = pa.array(text + first, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.arange(len(text))),
                 *(pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(3))],
                names=["number", "toxic", "nth", "words", "runs", "first"])


def _train_task(batches):
    """The windows, in order, → one row with the network; none without windows of both labels."""
    given = list(batches)
    if not given:
        return
    # Not combined, which would copy them: the arrays of numbers stay views of the batches.
    windows = pa.Table.from_batches(given)
    columns = [windows[k].to_pylist() for k in ("number", "toxic")]
    lists = [[v.values.to_numpy() for v in windows[k]] for k in ("words", "runs", "first")]
    data = [(n, t == 1, w.view(np.uint64), r.view(np.uint64), f) for n, t, w, r, f in zip(*columns, *lists)]
    if len({w[1] for w in data}) == 2:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(data))], pa.binary())], names=["network"])


def fit_network(docs: DataFrame, labels: DataFrame, holdout: tuple[int, int] = (3, 1)) -> Network | None:
    """Fit on labelled rows outside the holdout; None without documents of both labels.

    One task gets at most SAMPLE_WINDOWS windows of at most STEPS words, whatever the size of the tables.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").alias("__toxic"))
             .filter("__id IS NOT NULL AND __toxic IS NOT NULL").filter(~held_out("__id", *holdout))
             .join(docs.select(F.col("doc_id").cast("long").alias("__id")), "__id", "left_semi"))
    chosen = None
    for value in (0, 1):
        some = known.filter(F.col("__toxic") == value).orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = (docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
            .join(F.broadcast(chosen), "__id").select(F.col("__id").cast("long"), F.col("__toxic").cast("int"), "__text"))
    # Three quarters train the network; the rest, which it hasn't seen, calibrate it.
    apart = F.pmod(F.xxhash64("__id", F.lit("calibration")), F.lit(4)) == 0
    # The windows go to one task, which trains: the driver only gets the network.
    windows = (rows.filter(~apart).mapInArrow(_training_windows, "number long, toxic int, nth long, words array<long>, "
                                              "runs array<long>, first array<long>")
               .orderBy(F.xxhash64("number", "nth"), "number", "nth", "toxic").limit(SAMPLE_WINDOWS))
    trained = windows.mapInArrow(_train_task, "network binary").collect()
    if not trained:
        return None
    net = pickle.loads(trained[0]["network"])

    def worst(batches):
        for batch in batches:
            best, number = net.worst_windows(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(best), pa.array(np.log1p(number))],
                                             names=["toxic", "best", "windows"])

    got = rows.filter(apart).mapInArrow(worst, "toxic int, best double, windows double").toArrow()
    if len(set(got["toxic"].to_pylist())) < 2:
        got = rows.mapInArrow(worst, "toxic int, best double, windows double").toArrow()
    x = np.column_stack([got["best"].to_numpy(), got["windows"].to_numpy(), np.ones(len(got))])
    y = got["toxic"].to_numpy() == 1
    order = np.lexsort((y, *x.T))
    net.calibration = _calibrate(x[order], y[order])
    return net


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method; a little ridge keeps it finite when the labels separate."""
    w = np.zeros(3)
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), x.T @ (y - p) - 0.05 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def toxicity_score(net: Network | None, text: Column | str) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.zeros(len(texts)) if net is None else net.score(texts))

    return score(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...), labels (doc_id, toxic, ...) → (doc_id, held_out, score, predicted) per row of docs.

    Texts without words, null and empty ones included, score 0; so does everything if the labels show one kind only.
    Other columns are ignored.
    """
    net = fit_network(docs, labels)
    return (docs.select("doc_id", toxicity_score(net, "text").alias("score"))
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns only."""
    return docs.filter(toxicity_score(fit_network(docs, labels), docs["text"]) < THRESHOLD)
