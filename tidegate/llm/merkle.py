"""Document fingerprints by a Merkle tree over sections, paragraphs and groups of words.

A section ends with an empty line, a paragraph with a line break; the breaks belong to what they end, so no two texts
have the same parts. A paragraph's digest is that of its text, a section's that of its paragraphs' digests, and the root
is the digest of the sections' digests: equal roots mean equal texts. Under each paragraph stand short digests of its
groups of up to eight words, for likeness. The fingerprint writes the tree as text:

    root : section = paragraph / groups . paragraph / groups ; section = ...

Everything is done with built-in functions on the row of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Documents that are put in order together, about.
BUCKET_ROWS = 2000
MOST_BUCKETS = 4096
GROUP = r"\s*+(?:\S++\s*+){1,4}"


def fingerprint(text: Column) -> Column:
    """A null text has the fingerprint of the empty one."""
    text = F.coalesce(text, F.lit(""))

    def paragraph(p: Column) -> Column:
        groups = F.transform(F.regexp_extract_all(p, F.lit(GROUP), F.lit(0)), lambda g: F.substring(F.md5(F.trim(g)), 1, 8))
        return F.struct(F.sha2(p, 256).alias("digest"), F.array_join(groups, "").alias("groups"))

    def section(s: Column) -> Column:
        return F.transform(F.split(s, r"(?<=\n)"), paragraph)

    def written(paragraphs: Column) -> Column:
        digest = F.sha2(F.array_join(F.transform(paragraphs, lambda p: p["digest"]), ""), 256)
        below = F.transform(paragraphs, lambda p: F.concat(F.substring(p["digest"], 1, 16), F.lit("/"), p["groups"]))
        return F.struct(digest.alias("digest"), F.concat(F.substring(digest, 1, 16), F.lit("="), F.array_join(below, ".")).alias("branch"))

    sections = F.transform(F.transform(F.split(text, r"(?<=\n\n)"), section), written)
    # The tree is built once and then read twice.
    return F.element_at(F.transform(F.array(sections), lambda tree: F.concat(
        F.sha2(F.array_join(F.transform(tree, lambda s: s["digest"]), ""), 256), F.lit(":"),
        F.array_join(F.transform(tree, lambda s: s["branch"]), ";"))), 1)


def root(mark: Column) -> Column:
    return F.substring(mark, 1, 64)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots; else the share of word groups in common (Dice's coefficient of the distinct ones)."""
    def groups(mark):
        runs = F.regexp_extract_all(mark, F.lit(r"(?:/|\G(?<!^))([0-9a-f]{8})"), F.lit(1))
        return F.array_distinct(runs)

    def score(pair):
        total = F.size(pair["a"]) + F.size(pair["b"])
        return F.when(total > 0, 2.0 * F.size(F.array_intersect(pair["a"], pair["b"])) / total).otherwise(0.0)

    both = F.array(F.struct(groups(a).alias("a"), groups(b).alias("b")))
    return F.when(root(a) == root(b), 1.0).otherwise(F.element_at(F.transform(both, score), 1))


def edited_places(a: Column, b: Column) -> Column:
    """Where two fingerprints' paragraphs part: array of (section, paragraph) numbers from 0 whose branches differ.

    Only branches whose section digests differ are looked into. A branch that one side lacks counts as different.
    """
    def sections(mark):
        return F.split(F.substring(mark, 66, 2 ** 30), ";")

    def differing(x, i):
        def paragraphs(branch):
            return F.split(F.coalesce(branch, F.lit("")), r"[=.]")

        other = F.get(sections(b), i)
        mine, theirs = paragraphs(x), paragraphs(other)
        places = F.sequence(F.lit(1), F.greatest(F.size(mine), F.size(theirs)) - 1)
        return F.when(x.eqNullSafe(other), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(F.transform(
            F.filter(places, lambda k: ~F.get(mine, k).eqNullSafe(F.get(theirs, k))),
            lambda k: F.struct(i.cast("int").alias("section"), (k - 1).cast("int").alias("paragraph"))))

    own = sections(a)
    extra = F.greatest(F.size(sections(b)) - F.size(own), F.lit(0))
    padded = F.concat(own, F.array_repeat(F.lit(None).cast("string"), extra))
    return F.flatten(F.transform(padded, differing))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``next_text``: that of the next lower doc_id; after the lowest comes the highest.

    Ids are cut into buckets at counted quantiles. A bucket's highest document also goes to the next bucket above, as the
    one after its lowest, so each bucket is put in order by itself. A null id is the lowest; among equal ids the smaller
    text comes first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    number = rows.count()
    buckets = max(1, min(MOST_BUCKETS, number // BUCKET_ROWS))
    borders = []
    if buckets > 1:
        fractions = [i / buckets for i in range(1, buckets)]
        borders = sorted(set(rows.agg(F.percentile_approx("doc_id", fractions, 100 * buckets)).first()[0] or []))
    bucket = F.lit(0)
    if borders:
        known = F.array(*(F.lit(b).cast("long") for b in borders))
        bucket = F.size(F.filter(known, lambda b: b < F.col("doc_id")))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket))
    # At most MOST_BUCKETS + 1 rows.
    tops = {r["bucket"]: r["top"] for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    above = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    if tops:
        top, target = (F.create_map(*(F.lit(x) for b in order for x in (b, m[b]))) for m in (
            {b: -(2 ** 63) if t is None else t for b, t in tops.items()}, above))
        at_top = F.coalesce("doc_id", F.lit(-(2 ** 63))) == F.element_at(top, F.col("bucket"))
        rows = rows.select("doc_id", "text", F.explode(F.when(at_top, F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest")),
            F.struct(F.element_at(target, F.col("bucket")).alias("bucket"), F.lit(1).alias("guest")))).otherwise(F.array(
                F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))))).alias("place")).select(
                    "doc_id", "text", "place.bucket", "place.guest")
    else:
        rows = rows.withColumn("guest", F.lit(0))
    w = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return rows.withColumn("next_text", F.lead("text").over(w)).filter("guest = 0").select("doc_id", "text", "next_text")


def merkle_fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) → per row of docs: n_chars, digests, fingerprints and likenesses, as the query names them.

    A null text counts as empty. Other columns are ignored; an empty table gives an empty result. A single document is
    its own next one.
    """
    text, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    rows = with_next(docs).select("doc_id", text.alias("text"), following.alias("next_text"))
    rows = rows.select("doc_id", size.cast("long").alias("n_chars"), "text", "next_text", F.concat(
        F.substring("text", F.lit(1), (size - third).cast("int")), F.substring("next_text", F.lit(1), third)).alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
                       fingerprint(F.col("next_text")).alias("next_fingerprint"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
