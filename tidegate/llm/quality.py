"""Document quality by pairwise ranking (Bradley-Terry).

A document's strength is a weighted sum of properties of its text. The weights maximise the likelihood that in pairs of
a good and a bad document the good one is the stronger: logistic loss on the difference of their properties. Documents
are kept from a strength upwards; it is the one that agrees best with the labels fitted on.

All labelled documents outside the holdout are fitted on. They are dealt by hash into groups of about ``GROUP``; within a
group every good document meets every bad one. Each step of Newton's method adds up slopes and curves of the groups, and
the cut is chosen by counts over all of them, so no more than a group meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import held_out, stored
from .spans import BLANKS, IS_BLANK, byte_table, pieces, span_hashes, spans

#: Labelled documents that are compared with each other; all pairs where there are no more.
GROUP = 2048
#: Documents of the rarer label that a group gets at least; those of a rarer one than that go to several groups.
LEAST_OF_A_KIND = 128
#: Steps of equal width into which the range of strength is divided to choose the cut.
STEPS = 1 << 14
#: Score of a document at the cut.
CUT = 0.3
RIDGE = 1e-2

CLASSES = {
    "upper": byte_table(bytes(range(65, 91))), "lower": byte_table(bytes(range(97, 123))),
    "digit": byte_table(b"0123456789"), "stop": byte_table(b".,;:"), "loud": byte_table(b"!?"),
    "bar": byte_table(b"|"), "mark": byte_table(b"#$%&*+/<=>@\\^_`{}~[]()"), "quote": byte_table(b"\"'-"),
    "line": byte_table(b"\n"), "high": byte_table(bytes(range(128, 256))), "blank": byte_table(BLANKS),
}
FEATURES = (*CLASSES, "log_words", "word_bytes", "distinct_words", "same_as_before", "distinct_lines", "marked_words",
            "upper_words", "long_words", "empty")


def features(texts: pa.Array) -> np.ndarray:
    """One row per text: shares of kinds of bytes, words and lines. Null and empty texts have zeros and ``empty``."""
    out = [np.zeros((0, len(FEATURES)))]
    for _, data, offsets in pieces(texts):
        n = len(offsets) - 1
        size = np.maximum(np.diff(offsets), 1)

        def share(flags, of, owner=None):
            if owner is not None:
                return np.bincount(owner, flags, n) / of
            total = np.concatenate(([0], np.cumsum(flags)))
            return (total[offsets[1:]] - total[offsets[:-1]]) / of

        starts, ends, owner = spans(~IS_BLANK[data], offsets)
        words = np.bincount(owner, minlength=n)
        some = np.maximum(words, 1)
        hashes = span_hashes(data, starts, ends)
        same = np.zeros(len(hashes))
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        line_at, line_end, line_owner = spans(data != 10, offsets)
        lines = np.bincount(line_owner, minlength=n)
        last = data[ends - 1] if len(ends) else data[:0]
        columns = [share(table[data], size) for table in CLASSES.values()]
        columns += [np.log1p(words), share((ends - starts).astype(float), some, owner),
                    _distinct(hashes, owner, n) / some, share(same, some, owner),
                    _distinct(span_hashes(data, line_at, line_end), line_owner, n) / np.maximum(lines, 1),
                    share((CLASSES["mark"] | CLASSES["loud"] | CLASSES["bar"])[last].astype(float), some, owner),
                    share(CLASSES["upper"][last].astype(float), some, owner),
                    share((ends - starts > 20).astype(float), some, owner), (words == 0).astype(float)]
        out.append(np.stack(columns, axis=1))
    return np.concatenate(out)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[fresh], minlength=n)


@dataclass(frozen=True)
class Ranking:
    """Weights of the standardised features, and the strength from which documents are kept."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        # Far outliers say no more than outliers.
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights


def _unknown() -> Ranking:
    """Without labels of both kinds nothing is known: all documents have the strength of the cut and are kept."""
    return Ranking(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0)


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def _pull(z: np.ndarray, good: np.ndarray, times: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Slope and curve of the likelihood over all pairs of a good and a bad row, and the number of pairs, in one array.

    A row that stands for several documents counts as often. Pairs are taken in blocks of good rows, which bounds memory.
    """
    width = z.shape[1]
    slope, curve, pairs = np.zeros(width), np.zeros((width, width)), 0.0
    bad, of_bad = z[~good], times[~good].astype(float)
    strength = bad @ w
    fine, of_fine = z[good], times[good].astype(float)
    for at in range(0, len(fine) if len(bad) else 0, 256):
        some, of_some = fine[at: at + 256], of_fine[at: at + 256]
        p = 1 / (1 + np.exp(-np.clip((some @ w)[:, None] - strength, -30, 30)))
        count = of_some[:, None] * of_bad
        missed = count * (1 - p)
        slope += missed.sum(1) @ some - missed.sum(0) @ bad
        bend = missed * p
        mixed = some.T @ (bend @ bad)
        curve += (some * bend.sum(1)[:, None]).T @ some + (bad * bend.sum(0)[:, None]).T @ bad - mixed - mixed.T
        pairs += count.sum()
    return np.concatenate((slope, curve.ravel(), [pairs]))


def _climb(width: int, pull) -> np.ndarray:
    """Newton's method: weights from ``pull(w)``, the sums of :func:`_pull` over all groups."""
    w = np.zeros(width)
    for _ in range(25):
        sums = pull(w)
        pairs = max(sums[-1], 1.0)
        slope = sums[:width] / pairs - RIDGE * w
        curve = sums[width:-1].reshape(width, width) / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _steps(strength: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.minimum((strength - low) / max(high - low, 1e-300) * STEPS, STEPS - 1).astype(np.int64)


def _best_cut(good: np.ndarray, bad: np.ndarray, lowest: np.ndarray, highest: np.ndarray) -> float:
    """The cut from the steps that hold documents, rising: how many of them are good and bad, lowest and highest strength.

    From each step upwards documents may be kept, as long as that is a tenth of them; the lowest of the best is taken.
    """
    below = np.cumsum(good + bad) - (good + bad)
    agree = (np.cumsum(bad) - bad) + good[::-1].cumsum()[::-1]
    agree = np.where(below <= 0.9 * (good + bad).sum(), agree, -1)
    best = int(np.argmax(agree))
    # The middle of the gap below, so that copies of fitted documents don't stand on the edge.
    return float((lowest[best] + highest[best - 1]) / 2 if best else lowest[best])


def fit(x: np.ndarray, good: np.ndarray) -> Ranking:
    """The ranking from rows of one group, all in memory."""
    if not len(x) or good.all() or not good.any():
        return _unknown()
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1
    z = _scaled(x, mean, scale)
    w = _climb(x.shape[1], lambda w: _pull(z, good, np.ones(len(z)), w))
    strength = z @ w
    step = _steps(strength, strength.min(), strength.max())
    held, which = np.unique(step, return_inverse=True)
    lowest, highest = np.full(len(held), np.inf), np.full(len(held), -np.inf)
    np.minimum.at(lowest, which, strength)
    np.maximum.at(highest, which, strength)
    return Ranking(mean, scale, w, _best_cut(np.bincount(which, good, len(held)), np.bincount(which, ~good, len(held)), lowest, highest))


def _dealt(rows: DataFrame, n: int, of_kind: dict[int, int], size: int) -> DataFrame:
    """(good, x, times) → one row per group with its rows in order. Where one label is rare, its rows go to several groups."""
    groups = max(1, -(-n // size))
    copies = {kind: min(groups, -(-groups * min(LEAST_OF_A_KIND, size) // count)) for kind, count in of_kind.items()}
    often = F.when(F.col("good") == 1, copies[1]).otherwise(copies[0])
    # Neighbouring copies lie evenly apart, so no two are in one group.
    nth = F.explode(F.sequence(F.lit(0), often - 1)).alias("nth")
    group = F.pmod(F.xxhash64("good", "x") + F.floor(F.col("nth") * groups / often), F.lit(groups)).alias("group")
    return (rows.select("good", "x", "times", often.alias("often"), nth).select(group, "good", "x", "times")
            .groupBy("group").agg(F.sort_array(F.collect_list(F.struct("good", "x", "times"))).alias("rows")))


def _group_arrays(batch: pa.RecordBatch):
    """Per group of a batch (group, rows): features, whether good, how often."""
    for i in range(len(batch)):
        rows = batch.column(1)[i].values
        x = rows.field("x").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        yield x, rows.field("good").to_numpy(zero_copy_only=False) == 1, rows.field("times").to_numpy(zero_copy_only=False)


def fit_ranking(docs: DataFrame, labels: DataFrame, holdout: tuple[int, int] = (5, 0), group: int = GROUP) -> Ranking:
    """Fit on all labelled rows outside the holdout (modulus and remainder of the id's crc32).

    Features are computed where the texts are; only they meet the labels. Labels without id or quality are ignored; a
    document with two labels counts with both. Rows with equal features and label are one that counts several times.
    """
    spark, width = docs.sparkSession, len(FEATURES)
    known = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("good"))
             .filter("__id IS NOT NULL AND good IS NOT NULL").filter(~held_out("__id", *holdout)))

    def described(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(features(batch.column(1))), pa.list_(pa.float64()))], names=["__id", "x"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("__id"), "text").filter("__id IS NOT NULL")
            .mapInArrow(described, "__id long, x array<double>").join(known, "__id")
            .groupBy((F.col("good") == 1).cast("int").alias("good"), "x").agg(F.count(F.lit(1)).alias("times")))
    rows = stored(spark, rows, "labelled")

    kinds = {r["good"]: r for r in rows.groupBy("good").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("times").alias("n"),
        *[F.sum(F.col("x")[k] * F.col("times")).alias(f"x{k}") for k in range(width)]).collect()}
    if len(kinds) < 2:
        return _unknown()
    n = sum(r["n"] for r in kinds.values())
    mean = np.array([sum(r[f"x{k}"] for r in kinds.values()) / n for k in range(width)])
    spread = rows.agg(*[F.sum((F.col("x")[k] - float(mean[k])) ** 2 * F.col("times")) for k in range(width)]).first()
    scale = np.sqrt(np.array(list(spread), float) / n)
    scale[scale < 1e-9] = 1

    of_kind = {kind: r["rows"] for kind, r in kinds.items()}
    groups = stored(spark, _dealt(rows, sum(of_kind.values()), of_kind, group), "groups")

    def pull(w: np.ndarray) -> np.ndarray:
        def sums(batches):
            total = np.zeros(width + width * width + 1)
            for batch in batches:
                for x, good, times in _group_arrays(batch):
                    total += _pull(_scaled(x, mean, scale), good, times, w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

        added = groups.mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        return added["value"].to_numpy()[np.argsort(added["at"].to_numpy())]

    w = _climb(width, pull)

    def strengths(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scaled(x, mean, scale) @ w), batch.column(2)],
                                             names=["good", "strength", "times"])

    placed = rows.select("good", "x", "times").mapInArrow(strengths, "good int, strength double, times long")
    low, high = placed.agg(F.min("strength"), F.max("strength")).first()
    step = F.least(F.floor((F.col("strength") - low) / max(high - low, 1e-300) * STEPS), F.lit(STEPS - 1))
    held = placed.groupBy(step.alias("step")).agg(
        F.sum(F.col("good") * F.col("times")).alias("good"), F.sum((1 - F.col("good")) * F.col("times")).alias("bad"),
        F.min("strength").alias("lowest"), F.max("strength").alias("highest")).orderBy("step").toArrow()  # STEPS rows at most
    return Ranking(mean, scale, w, _best_cut(*(held[c].to_numpy() for c in ("good", "bad", "lowest", "highest"))))


def quality_score(model: Ranking, text: Column | str) -> Column:
    """The chance to be preferred to a document at the cut, moved so that the cut itself scores 0.3."""
    shift = float(np.log(CUT / (1 - CUT)))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        lead = np.clip(model.strength(features(texts)) - model.cut, -30, 30)
        return pa.array(np.where(lead >= 0, np.maximum(1 / (1 + np.exp(-lead - shift)), CUT), 1 / (1 + np.exp(-lead - shift))))

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...), labels (doc_id, quality, ...) → (doc_id, held_out, score, predicted) per row of docs.

    Null, empty and blank texts are scored by their features like any other. Other columns are ignored.
    """
    model = fit_ranking(docs, labels)
    return (docs.select("doc_id", quality_score(model, "text").alias("score"))
            .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with their own columns only."""
    model = fit_ranking(docs, labels)
    return docs.filter(quality_score(model, docs["text"]) >= CUT)
