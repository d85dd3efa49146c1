"""Near duplicates by an n-gram Jaccard join over parity sketches.

Two sets link when 4 * |A & B| >= 3 * |A | B|, so their symmetric difference holds at most (|A| + |B|) / 7 elements.

*Sketch.* The hash space is cut into K words. A token is XORed into the word that its hash falls in, so the number of
words in which two sketches differ is at most the symmetric difference. K is one more than the largest difference
allowed in the pair's size band, so a linked pair agrees in one word at least (pigeonhole): sketches are joined on
(band, word number, word). A pair's band is that of its larger set; a set also enters the bands of the larger sets it
may link with.

*Words looked at.* Of K words the first ``WORDS`` are joined. A linked pair agrees in a share of at least 1/e of them, a
third with tokens in them, so for large sets the chance that no joined word agrees is under (2/3) ** 48 < 1e-8. Where
K <= WORDS all words are joined; words without tokens say nothing, so sets with such a word also enter their smallest
n // 4 + 1 hashes, of which two linked sets share one. No size of a join group is capped.

*Verify.* Sets that are equal are one class. In each join group the members are first compared with the group's smallest
id, then, where the group still holds several components, with a member picked by hash. What is then still apart is
compared: a member outside a group's largest component with those of the others. Where more than ``CROWD``
are outside, as when unrelated texts share a passage, their documents are joined anew on their n // 4 + 1 rarest
shingles, one of which two linked sets share whatever the order of rarity, and only where enough of both sets follows in
that order; so a passage brings two texts together only if it makes up six sevenths of the shorter one, and the join
makes at most n // 4 + 1 rows for a text, in small tables as in large ones. A second sketch of 1024 parity bits bounds the difference from below and rejects
most pairs before texts are read; the others are decided on the exact shingle sets. So a group of n alike texts costs
about n comparisons, and no link between components is lost.

``exact=True`` joins all K words and rejects nothing by sampled bits, for those who want no chance of a miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir
from .common import discard, stored
from .components import components
from .spans import mix, shingle_sets

WIDTH = 5
WORDS = 48
BITS = 1024
BAND_GROWTH = 2
#: Groups with more members outside their largest component are joined anew on rare shingles. A group with one outside needs no
#: more comparisons than it has members; with a larger limit, which texts go which way, and so the rows made, would change with
#: the size of the table, because a passage that few share in a small one is shared by many in a large one.
CROWD = 1
#: Shingles whose frequency counts for the order of rarity; any order gives the same links.
POPULAR = 1 << 16
#: Largest set size of each band; sizes beyond 1e12 words do not occur.
BAND_TOPS = np.unique(np.floor(3 * BAND_GROWTH ** np.arange(40)).astype(np.int64))

SKETCH = ("doc_id long, n int, set_a long, set_b long, band int, lead boolean, words array<long>, "
          "parity array<long>")


def _bands(n: int) -> range:
    first = int(np.searchsorted(BAND_TOPS, n))
    last = int(np.searchsorted(BAND_TOPS, n * 4 // 3))
    return range(first, last + 1)


def _sampling(band) -> int:
    """The parity bits take one hash of so many, which keeps them from filling up."""
    return np.maximum(1, BAND_TOPS[band] // BITS)


def _word_keys(values: np.ndarray, band: int, exact: bool) -> np.ndarray:
    """Join keys of one set in one band. ``values`` are its hashes, rising, so that words are runs of them."""
    k = int(BAND_TOPS[band]) * 2 // 7 + 1
    # The word number comes from the upper 32 bits.
    word = ((values >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    joined = k if exact else min(k, WORDS)
    used = values[: int(np.searchsorted(word, joined))]
    word = word[: len(used)]
    out = np.zeros(0, np.uint64)
    if len(used):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out = np.bitwise_xor.reduceat(used, first) ^ mix(word[first] + np.uint64(band << 40))
    if joined == k and len(out) < k:
        out = np.concatenate((out, values[: len(values) // 4 + 1] ^ np.uint64((band + 1) << 48 | 1)))
    return mix(out + np.uint64(band))


def _parity(values: np.ndarray, band: int) -> np.ndarray:
    low = values & np.uint64(0xFFFFFFFF)
    taken = low[low % np.uint64(_sampling(band)) == 0] // np.uint64(_sampling(band))
    odd = np.bincount((mix(taken) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], exact: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, n_texts, values, owner in shingle_sets(texts, WIDTH):
            borders = np.searchsorted(owner, np.arange(n_texts + 1))
            rows: dict[str, list] = {k: [] for k in ("at", "n", "a", "b", "band", "lead", "words", "p")}
            for i in range(n_texts):
                own = values[borders[i]: borders[i + 1]]
                key = (int(np.sum(own, dtype=np.uint64).astype(np.int64)),
                       int(np.sum(mix(own ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).astype(np.int64)))
                bands = _bands(len(own)) if len(own) else range(-1, 0)
                for band in bands:
                    rows["at"].append(first + i)
                    rows["lead"].append(band == bands[0])
                    rows["n"].append(len(own))
                    rows["a"].append(key[0])
                    rows["b"].append(key[1])
                    rows["band"].append(band)
                    rows["words"].append(_word_keys(own, band, exact).view(np.int64) if band >= 0 else np.zeros(0, np.int64))
                    rows["p"].append(_parity(own, band) if band >= 0 else np.zeros(BITS // 64, np.int64))
            lengths = np.concatenate(([0], np.cumsum([len(w) for w in rows["words"]])))
            parity = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(rows["p"])), BITS // 64)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows["at"], pa.int64())).cast(pa.int64()), pa.array(rows["n"], pa.int32()),
                 pa.array(rows["a"], pa.int64()), pa.array(rows["b"], pa.int64()), pa.array(rows["band"], pa.int32()),
                 pa.array(rows["lead"], pa.bool_()),
                 pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(rows["words"]))),
                 parity.cast(pa.list_(pa.int64()))],
                names=["doc_id", "n", "set_a", "set_b", "band", "lead", "words", "parity"])


def sketches(docs: DataFrame, exact: bool = False) -> DataFrame:
    """One row per document and size band: set size, hashes of the whole set, join keys, parity bits; ``lead`` in one of them."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _sketches(b, exact), SKETCH)


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) → the pairs that link, decided on their shingle sets."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            both = [{}, {}]
            for side in (0, 1):
                for first, n_texts, values, owner in shingle_sets(part.column(2 + side), WIDTH):
                    borders = np.searchsorted(owner, np.arange(n_texts + 1))
                    both[side].update({first + i: values[borders[i]: borders[i + 1]] for i in range(n_texts)})
            keep = []
            for i in range(len(part)):
                a, b = both[0][i], both[1][i]
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common > 0 and 100 * common >= 75 * (len(a) + len(b) - common))
            yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _by_id(spark: SparkSession, texts: DataFrame) -> tuple[str, str]:
    """Store (doc_id, text) in buckets by id, so that no round shuffles it again: (table, folder)."""
    n, folder = int(spark.conf.get("spark.sql.shuffle.partitions")), work_dir(spark, "texts")
    name = "near_duplicate_texts_" + folder.rsplit("-", 1)[1]
    (texts.write.bucketBy(n, "doc_id").sortBy("doc_id").option("path", folder).option("compression", "zstd")
     .saveAsTable(name))
    return name, folder


def linked(spark: SparkSession, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts link; ``texts`` has (doc_id, text). A text is moved once per pair it is in as ``a``."""
    pairs = stored(spark, pairs, "pairs")
    hubs = stored(spark, texts.join(pairs.select(F.col("b").alias("doc_id")).distinct(), "doc_id", "left_semi"), "hubs")
    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(hubs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.select("a", "b", "text_a", "text_b").mapInArrow(_overlap, "a long, b long")


def _distance(x: str, y: str) -> Column:
    """Number of places in which the parity bits differ."""
    differ = F.zip_with(f"{x}.parity", f"{y}.parity", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(differ, F.lit(0), lambda total, d: total + d)


def _may_link(x: str, y: str, exact: bool) -> Column:
    """Sizes allow a link, and the parity bits differ in no more places than a link allows.

    Bands that sample their hashes hold a share of the difference only; six standard deviations are added to it,
    or with ``exact`` nothing is rejected by them.
    """
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.floor((a + b) / 7)
    share = F.element_at(F.array(*(F.lit(int(_sampling(k))) for k in range(len(BAND_TOPS)))), F.col(f"{x}.band") + 1)
    allowed = F.when(share == 1, most).otherwise(most / share + 6 * F.sqrt(most / share) + 6)
    near = _distance(x, y) <= allowed
    return (4 * F.least(a, b) >= 3 * F.greatest(a, b)) & ((share > 1) | near if exact else near)


def _nearest(pairs: DataFrame, bits: DataFrame, exact: bool) -> DataFrame:
    """(doc_id, hub, band) → for each document the hub nearest by parity bits, of those it may link with: (a, b)."""
    sides = (pairs.distinct().join(bits.alias("x"), ["doc_id", "band"])
             .select("hub", "band", F.struct("x.*").alias("x"))
             .join(bits.select(F.col("doc_id").alias("hub"), "band", F.struct(*bits.columns).alias("y")), ["hub", "band"]))
    return (sides.filter(_may_link("x", "y", exact))
            .groupBy(F.col("x.doc_id").alias("a")).agg(F.min_by("hub", _distance("x", "y")).alias("b")))


def _still_open(groups: DataFrame, merged: DataFrame) -> DataFrame:
    """The members, with their components, of the groups that hold several components."""
    now = groups.join(merged.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "key", "doc_id", "band", F.coalesce("component", "doc_id").alias("component"))
    keys = (now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo < hi").select("key"))
    return now.join(keys, "key", "left_semi")


def _outside(groups: DataFrame) -> DataFrame:
    """Adds to the members (key, component, ...) of groups with several components the largest one, ``main``, and how many
    members are ``outside`` of it."""
    parts = groups.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"))
    keys = parts.groupBy("key").agg(F.max_by("component", F.struct("members", "component")).alias("main"),
                                    (F.sum("members") - F.max("members")).alias("outside")).filter("outside > 0")
    return groups.join(keys, "key")


def _pairs(members: DataFrame, accept: Column) -> DataFrame:
    """The pairs of members of different components of a group (x, y) that ``accept`` takes."""
    return (members.filter("component <> main").alias("x").join(members.alias("y"), F.expr(
        "x.key = y.key AND x.component <> y.component AND (y.component = y.main OR x.doc_id < y.doc_id)") & accept)
        .select(F.greatest("x.doc_id", "y.doc_id").alias("a"), F.least("x.doc_id", "y.doc_id").alias("b")).distinct())


def _rare_pairs(rare: DataFrame) -> DataFrame:
    """(key, doc_id, component, main, n, rest) → the pairs of different components that may link by what they share: (a, b).

    What two sets share begins with their rarest common shingle, so it is no more than either has from there on. For the
    smaller set of a pair this means six sevenths of its shingles: where it has fewer, it only meets smaller sets that have
    them, and texts that share less than that of a passage are not compared at all.
    """
    most = F.expr("7 * rest >= 6 * n")
    x = rare.filter("component <> main").withColumn("most", most).alias("x")
    y = rare.withColumn("most", F.explode(F.when(most, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))).alias("y")
    return (x.join(y, F.expr("""x.key = y.key AND x.most = y.most AND x.component <> y.component
        AND (y.component = y.main OR x.doc_id < y.doc_id OR NOT x.most) AND 7 * least(x.rest, y.rest) >= 3 * (x.n + y.n)"""))
            .select(F.greatest("x.doc_id", "y.doc_id").alias("a"), F.least("x.doc_id", "y.doc_id").alias("b")).distinct())


def _frequent(batches: Iterator[pa.RecordBatch], most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Texts → (key, times) of the shingles that several texts of the task hold; beyond ``most`` the rarest are let go."""
    keys, times, new = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def counted():
        every, which = np.unique(np.concatenate([keys, *new]), return_inverse=True)
        total = np.bincount(which[: len(keys)], times, len(every)) + np.bincount(which[len(keys):], minlength=len(every))
        if len(every) > most:
            kept = total > np.partition(total, len(total) - most)[len(total) - most]
            every, total = every[kept], total[kept]
        return every, total.astype(np.int64)

    for batch in batches:
        for _, _, values, _ in shingle_sets(batch.column(0), WIDTH):
            new.append(values)
            if sum(map(len, new)) > most // 2:
                (keys, times), new = counted(), []
    keys, times = counted()
    several = times > 1
    yield pa.RecordBatch.from_arrays([pa.array(keys[several].view(np.int64)), pa.array(times[several])], names=["key", "times"])


def _rarest(batches: Iterator[pa.RecordBatch], popular: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, component, text) → the n // 4 + 1 rarest shingles of each text: (key, doc_id, component, n, rest), where
    ``rest`` is how many of its shingles are no rarer."""
    for batch in batches:
        for first, n_texts, values, owner in shingle_sets(batch.column(2), WIDTH):
            at = np.minimum(np.searchsorted(popular, values), len(popular) - 1)
            order = np.lexsort((values, np.where(popular[at] == values, times[at], 0), owner))
            n = np.bincount(owner, minlength=n_texts)
            place = np.arange(len(values)) - (np.cumsum(n) - n)[owner]
            taken = place <= n[owner] // 4
            rows = pa.array(first + owner[taken])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[order][taken].view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(n[owner[taken]].astype(np.int32)), pa.array((n[owner] - place)[taken].astype(np.int32))],
                names=["key", "doc_id", "component", "n", "rest"])


def _crowded_pairs(spark: SparkSession, crowd: DataFrame, texts: DataFrame, bits: DataFrame, exact: bool) -> DataFrame:
    """(doc_id, component) of crowded groups → pairs that share a rare shingle and may link: (a, b)."""
    held = texts.join(crowd, "doc_id").select("doc_id", "component", "text")
    often = (held.select("text").mapInArrow(_frequent, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))
             .filter(F.col("times") > CROWD).orderBy(F.desc("times"), "key").limit(POPULAR).toArrow())
    popular, times = (often.column(c).to_numpy() if len(often) else np.zeros(1, np.int64) for c in ("key", "times"))
    order = np.argsort(popular.view(np.uint64))
    popular, times = popular.view(np.uint64)[order], times[order]
    # Stored before it is read twice, or the texts would be cut into shingles for each of the two.
    every = stored(spark, held.mapInArrow(
        lambda b: _rarest(b, popular, times), "key long, doc_id long, component long, n int, rest int"), "rarest")
    rare = stored(spark, _outside(every), "rare")
    pairs = _rare_pairs(rare)
    sides = (pairs.join(bits.select(F.col("doc_id").alias("a"), "band", F.struct(*bits.columns).alias("x")), "a")
             .join(bits.select(F.col("doc_id").alias("b"), "band", F.struct(*bits.columns).alias("y")), ["b", "band"]))
    return sides.filter(_may_link("x", "y", exact)).select("a", "b").distinct()


def ngram_jaccard_components(spark: SparkSession, docs: DataFrame, exact: bool = False) -> DataFrame:
    """docs (doc_id, text, ...) → (doc_id, n_shingles, component_id, n_copies), one row per row of ``docs``.

    n_copies counts the rows with an equal shingle set, the row itself included. A text that is null, empty or without
    words has no shingles and links with nothing. A null doc_id gets component_id null and links with nothing.
    Rows with the same doc_id are one document: what any of them links with is in its component. Other columns of
    ``docs`` are ignored, whatever their names. An empty table gives an empty result.
    """
    sketch = stored(spark, sketches(docs, exact), "sketches")
    # Equal sets have equal sketches, so a class is put together, and its copies are dropped, before any key leaves its task.
    reps = stored(spark, sketch.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "set_a", "set_b", "band", "lead").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"),
        F.first("words").alias("words"), F.first("parity").alias("parity")), "classes")
    classes = reps.filter("lead").select("n", "set_a", "set_b", F.col("doc_id").alias("rep"), "n_copies")
    rows = sketch.filter("lead").select("doc_id", "n", "set_a", "set_b")
    member = stored(spark, rows.join(classes, ["n", "set_a", "set_b"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies")), "members")
    # A document with several rows may be in several classes.
    same_id = (member.filter("n > 0").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"))
               .filter("a <> b").select("doc_id", "b").join(member.filter("n > 0").select("doc_id", "rep"), "doc_id")
               .select(F.col("rep").alias("a"), "b"))

    keys = reps.select(F.explode("words").alias("key"), "doc_id", "band")
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).filter("hub < last")
    groups = stored(spark, keys.join(hubs.select("key", "hub"), "key"), "groups")

    involved = groups.select("doc_id").distinct()
    bits = stored(spark, reps.join(involved, "doc_id", "left_semi").select("doc_id", "n", "band", "parity"), "bits")
    table, folder = _by_id(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").join(involved, "doc_id", "left_semi")
        .dropDuplicates(["doc_id", "text"]))
    texts = spark.table(table)

    star = _nearest(groups.filter("doc_id <> hub").select("doc_id", "hub", "band"), bits, exact)
    links = stored(spark, linked(spark, star, texts).unionByName(same_id), "links")
    merged = components(spark, links)

    groups = stored(spark, _still_open(groups, merged), "open")
    order = F.xxhash64("key", "doc_id")
    picked = groups.groupBy("key").agg(F.min_by("doc_id", order).alias("hub"),
                                       F.min_by("component", order).alias("hub_component"))
    star = groups.join(picked, "key").filter("component <> hub_component").select("doc_id", "hub", "band")
    links = stored(spark, linked(spark, _nearest(star, bits, exact), texts).unionByName(links), "links")
    merged = components(spark, links)

    groups = stored(spark, _outside(_still_open(groups.select("key", "doc_id", "band"), merged)), "apart")
    apart = groups.filter(F.col("outside") <= CROWD).join(bits, ["doc_id", "band"])
    across = _pairs(apart, _may_link("x", "y", exact))
    crowd = groups.filter(F.col("outside") > CROWD).select("doc_id", "component").distinct()
    across = across.unionByName(_crowded_pairs(spark, crowd, texts, bits, exact)).distinct()
    last = stored(spark, linked(spark, across, texts), "links")
    final = merged if last.isEmpty() else components(spark, links.unionByName(last))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    discard(spark, folder)
    return (member.join(final.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("component", "rep").alias("component_id"), "n_copies"))


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each component: that with the smallest doc_id, a null one last. Rows are told apart by doc_id and text, so
    rows with one id and different texts that do not link both stay; rows equal in both stay once."""
    row = F.xxhash64("doc_id", "text")
    ids = docs.select("doc_id", row.alias("__row"))
    found = ngram_jaccard_components(spark, docs.select(row.alias("doc_id"), "text")).select(
        F.col("doc_id").alias("__row"), "component_id").distinct()
    first = ids.join(found, "__row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first"))
    kept = first.select(F.col("first.__row").alias("__row"))
    return docs.withColumn("__row", row).join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(*docs.columns)
