"""Benchmark decontamination by templates.

A text has two forms. In the plain one numbers and units become typed placeholders and all else is lower-cased words; in
the other one names become placeholders too. Capitals decide what a name is, so a text in other capitals meets an item in
the plain form, and one with other names in the second. Windows of five places of these forms are joined by hash and
compared place by place. Matches that lie on one diagonal (place in the document minus place in the item) are counted
together, and those of neighbouring diagonals too, as long as they agree, because a word put in moves all that follow. An
item is in a document if that has three quarters of the windows of one of the item's forms, and if the placeholders are
filled consistently: each filling of the item has one counterpart in the document and the other way round. A number with
a point or grouped digits is one word, and a run of names one placeholder. So a question whose numbers or names were replaced throughout is caught too. Windows that are nearly all placeholders
say something by their words only: an item that has them is also found if three quarters of all its windows are there word
for word, and an item of fewer than five words if it is there as a whole. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored

WIDTH = 5
LEAST_SHARE = 0.75
#: Words of a window that must not be placeholders.
LEAST_WORDS = 2
#: Hashes of benchmark windows that all tasks hold at a time; more of them take several passes over the documents.
BLOCK = 2_000_000
#: Up to so many benchmark windows go to all tasks as a whole too; more are met by a shuffle of what was found.
WHOLE = 200_000
#: Units.
UNITS = ("mm", "cm", "m", "km", "in", "ft", "mi", "g", "kg", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hr", "hz",
         "khz", "mhz", "ghz", "v", "w", "kw", "kwh", "j", "kj", "cal", "kcal", "n", "pa", "kpa", "k", "c", "f", "usd", "eur",
         "gbp", "dollars", "euros", "pounds", "cents", "percent", "meters", "metres", "kilometers", "kilometres", "miles",
         "feet", "inches", "grams", "kilograms", "liters", "litres", "seconds", "minutes", "hours", "days", "weeks", "months",
         "years", "degrees")
#: Diagonals up to this far apart are counted together.
REACH = 8
#: Marks: of a name (two of them after a comma, where a run of names ends), and between the parts of a number.
NAME, POINT = "\x01", "\x02"
#: Windows of the plain form, of the form with names, and of the words themselves. Where a document's window begins and its
#: kind are kept as begin * KINDS + kind; RAW + m - 1 is there the kind of a window of m words, fewer than WIDTH.
PLAIN, NAMED, RAW, KINDS = 0, 1, 2, 8


def marked_text(text: Column) -> Column:
    """Words in their own capitals, one blank between them; a capitalised word inside a sentence carries a mark in front.

    Line breaks, quotes, brackets and dashes are blanks here; a name does not begin after . ! or ? and a blank. 2.5 and 1,200
    are one word each; 2,5 is two, since it may as well be a list.
    """
    even = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}.!?,;:]+", " ")
    even = F.regexp_replace(even, r"\.(?<=[0-9]\.)(?=[0-9])|,(?<=[0-9],)(?=[0-9]{3}(?![0-9]))", POINT)
    marked = F.regexp_replace(even, r"(?<=[\p{Ll}\p{N},;:] )(?=\p{Lu}\p{Ll})", NAME)
    marked = F.regexp_replace(marked, f"[,;:] {NAME}", f" {NAME}{NAME}")
    return F.regexp_replace(marked, r"[ .!?,;:]+", " ")


def _split(marked: Column) -> Column:
    return F.array_remove(F.split(F.lower(marked), " "), "")


def _is_number(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def _plain_form(words: Column) -> Column:
    """A unit is one only after a number."""
    return F.transform(words, lambda word, i: F.when(_is_number(word), F.lit("<number>"))
                       .when(word.isin(*UNITS) & (i > 0) & _is_number(F.get(words, i - 1)), F.lit("<unit>")).otherwise(word))


def _with_forms(rows: DataFrame) -> DataFrame:
    """Adds the marked text, its words, their plain form, and the places (form, first word) of the form with names.

    A text without names has no such places.
    """
    rows = rows.withColumn("marked", marked_text(F.col("text")))
    rows = rows.withColumn("words", _split(F.replace("marked", F.lit(NAME), F.lit(""))))
    rows = rows.withColumn("form", _plain_form(F.col("words")))
    rows = rows.withColumn("parts", F.when(F.contains("marked", F.lit(NAME)), _split(F.col("marked")))
                           .otherwise(F.array().cast("array<string>")))
    runs_on = lambda word, i: (word.startswith(NAME) & ~word.startswith(NAME * 2) & (i > 0)
                               & F.get("parts", i - 1).startswith(NAME))
    places = F.transform("parts", lambda word, i: F.when(~F.coalesce(runs_on(word, i), F.lit(False)), F.struct(
        F.when(word.startswith(NAME), F.lit("<name>")).otherwise(F.get("form", i)).alias("form"), i.alias("at"))))
    return rows.withColumn("named", F.filter(places, lambda p: p.isNotNull())).drop("parts")


def _is_slot(word: Column) -> Column:
    return word.startswith("<")


def _places(column: str, width: int = WIDTH) -> Column:
    """Where a window can begin; a text with fewer words has none."""
    last = F.size(column) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _coded(begins: Column, kind: int) -> Column:
    return F.transform(begins, lambda i: i * KINDS + kind)


def _begins(short: list[int]) -> Column:
    """All windows of the plain form, those with a name of the other one, which are new, and those of ``short`` words."""
    last = F.size("named") - WIDTH
    names = F.filter(F.transform("named", lambda p, i: F.when(p["form"] == "<name>", i)), lambda i: i.isNotNull())
    near = F.array_distinct(F.flatten(F.transform(names, lambda i: F.sequence(
        F.greatest(i - (WIDTH - 1), F.lit(0)), F.least(i, last)))))
    named = F.when(last >= 0, near).otherwise(F.array().cast("array<int>"))
    return F.concat(_coded(_places("words"), PLAIN), _coded(named, NAMED),
                    *(_coded(_places("words", m), RAW + m - 1) for m in short))


def _parts(column: str, first: Column, width: int = WIDTH) -> list[Column]:
    parts = [F.get(column, first + k) for k in range(width)]
    return [p["form"] for p in parts] if column == "named" else parts


def _says_little(parts: list[Column]) -> Column:
    """With fewer than LEAST_WORDS words there is a placeholder among any LEAST_WORDS places, so most windows need no sum."""
    some = reduce(or_, map(_is_slot, parts[:LEAST_WORDS]))
    return some & (sum((_is_slot(p).cast("int") for p in parts), F.lit(0)) > WIDTH - LEAST_WORDS)


def _key(kind: int, parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def _fill(first: Column) -> Column:
    """The words at the places of a window of the form with names."""
    def words(i):
        at = F.get("named", i)["at"]
        return F.array_join(F.slice("words", at + 1, F.coalesce(F.get("named", i + 1)["at"], F.size("words")) - at), " ")

    return F.array(*(words(first + k) for k in range(WIDTH)))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """One row per form of an item and window that says something; an item of fewer than five words is one window.

    An item may follow a colon or a heading in a document, so it has a further form in which its first word is a name.
    """
    rows = items.filter("item_id IS NOT NULL").select("item_id", "text")
    alone = _with_forms(rows).withColumn("variant", F.xxhash64("marked"))
    inside = _with_forms(rows.withColumn("text", F.concat(F.lit(", "), "text"))).withColumn("variant", F.xxhash64("marked"))
    plain = alone.select("item_id", F.lit(PLAIN).alias("kind"), "variant", "words", "form", F.explode(_places("form")).alias("item_place"))
    plain = plain.select("item_id", "kind", "variant", "item_place", F.col("item_place").alias("item_at"),
                         F.array(*_parts("form", F.col("item_place"))).alias("item_form"),
                         F.array(*_parts("words", F.col("item_place"))).alias("item_words"))
    named = alone.unionByName(inside).select("item_id", F.lit(NAMED).alias("kind"), "variant", "words", "named",
                                             F.explode(_places("named")).alias("item_place"))
    named = named.select("item_id", "kind", "variant", "item_place", F.get("named", F.col("item_place"))["at"].alias("item_at"),
                         F.array(*_parts("named", F.col("item_place"))).alias("item_form"),
                         _fill(F.col("item_place")).alias("item_words"))
    rows = plain.unionByName(named).distinct()
    parts = [F.get("item_form", F.lit(k)) for k in range(WIDTH)]
    rows = rows.withColumn("window", F.when(F.array_contains("item_form", "<name>"), _key(NAMED, parts)).otherwise(_key(PLAIN, parts)))
    little = _says_little(parts)
    own = [F.get("item_words", F.lit(k)) for k in range(WIDTH)]
    raw = rows.filter(F.col("kind") == PLAIN)
    raw = raw.join(raw.filter(little).select("item_id", "variant").distinct(), ["item_id", "variant"]).select(
        "item_id", F.lit(RAW).alias("kind"), "variant", "item_place", "item_at", F.col("item_words").alias("item_form"), "item_words",
        F.when(little, _key(RAW, own)).otherwise(F.col("window")).alias("window"))
    rows = rows.filter(~little).unionByName(raw)
    for m in range(1, WIDTH):
        few = alone.filter(F.size("words") == m).select(
            "item_id", F.lit(RAW).alias("kind"), "variant", F.lit(0).alias("item_place"), F.lit(0).alias("item_at"),
            F.col("words").alias("item_form"), F.col("words").alias("item_words"), _key(RAW, _parts("words", F.lit(0), m)).alias("window"))
        rows = rows.unionByName(few.distinct())
    item = Window.partitionBy("item_id", "kind", "variant")
    return rows.withColumns({"n_windows": F.count(F.lit(1)).over(item), "nth": F.row_number().over(item.orderBy("item_place"))})


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...), items (item_id, text, ...) → (doc_id, item_id, first_word, coverage, reworded).

    One row per document and item found in it: where it begins (words from 0), the share of the windows of one of the
    item's forms on the best diagonals, and whether placeholders are filled otherwise than in the item. Null and empty texts
    hold and give nothing, rows without id are left out, repeated rows count once. Other columns are ignored.
    """
    windows = stored(spark, benchmark_windows(items), "benchmark-windows")
    size = F.size("item_words")
    number, hashes, short = windows.agg(F.count(F.lit(1)), F.count_distinct("window"), F.collect_set(F.when(size < WIDTH, size))).first()
    passes = max(1, -(-hashes // BLOCK))
    rows = _with_forms(docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                                F.xxhash64("text").alias("version"), "text"))

    def window_key(at: Column, own: Column) -> Column:
        plain = F.when(_says_little(_parts("form", at)), _key(RAW, _parts("words", at))).otherwise(_key(PLAIN, _parts("form", at)))
        key = F.when(own == PLAIN, plain)
        for m in short:
            key = key.when(own == RAW + m - 1, _key(RAW, _parts("words", at, m)))
        return key.otherwise(_key(NAMED, _parts("named", at)))

    # Windows stay numbers and hashes in two arrays until the join with the benchmark's hashes, in one generated loop with the
    # explode, finds one of them. The hashes are not listed in the plan, which would grow with the benchmark.
    keyed = rows.withColumn("begins", _begins(sorted(short))).withColumn("keys", F.transform(
        "begins", lambda b: window_key(F.shiftright(b, 3), b.bitwiseAND(KINDS - 1))))
    # Unlike explode, its outer form is not put behind a filter that hashes the windows a second time; what it adds meets nothing.
    pieces = keyed.select("doc_id", "version", "words", "form", "named", "begins", F.posexplode_outer("keys").alias("key_at", "window"))
    known, hits = windows.select("window").distinct(), None
    for i in range(passes):
        block = known if passes == 1 else known.filter(F.pmod("window", F.lit(passes)) == i)
        some = _own_words(pieces.join(F.broadcast(block), "window", "left_semi"))
        if passes > 1:  # one block is held at a time
            some = stored(spark, some, "benchmark-hits")
        hits = some if hits is None else hits.unionByName(some)
    hits = hits.join(F.broadcast(windows) if number <= WHOLE else windows, "window")
    raw = (F.col("own") >= RAW) | (F.col("kind") == RAW)
    hits = hits.filter(F.when(raw, F.col("filled")).otherwise(F.col("form")) == F.col("item_form"))
    # Each window answers for its placeholders.
    slots = F.filter(F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda k: F.struct(
        F.get("item_form", k).alias("form"), F.get("item_words", k).alias("item"), F.get("filled", k).alias("doc"))),
        lambda s: _is_slot(s["form"]))
    place = F.when(F.col("kind") == NAMED, F.col("named_place")).otherwise(F.col("place"))
    hits = hits.select("doc_id", "version", "item_id", "kind", "variant", "n_windows", (place - F.col("item_place")).alias("diagonal"),
                       "item_place", "nth", (F.col("first") - F.col("item_at")).alias("first"),
                       F.transform(slots, lambda s: F.struct(s["item"], s["doc"])).alias("slots"))
    keys = ["doc_id", "version", "item_id", "kind", "variant", "n_windows"]
    # An item's windows bound what comes together here.
    spans = hits.groupBy(*keys, "diagonal").agg(
        F.collect_set(F.struct("item_place", "nth")).alias("places"), F.min(F.struct("item_place", "first")).alias("first"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    # Each diagonal on its own, and in the two overlapping bands that hold it and all within REACH of it on one side.
    band = F.floor(F.col("diagonal") / REACH)
    bands = [F.struct(F.lit(wide).alias("wide"), at.cast("long").alias("at"))
             for wide, at in ((False, F.col("diagonal")), (True, band), (True, band + 1))]
    spans = spans.withColumn("band", F.explode(F.array(*bands)))
    spans = spans.groupBy(*keys, "band").agg(F.sort_array(F.collect_list(F.struct(
        (-F.size("places")).alias("fewer"), "diagonal", "places", "first", "slots"))).alias("spans"))
    spans = spans.filter(~F.col("band.wide") | (F.size("spans") > 1)).select(*keys, _together("spans").alias("all"))
    spans = spans.select("doc_id", "item_id", (_covered("all.places") / F.col("n_windows")).alias("coverage"),
                         F.col("all.first.first").alias("first"),
                         F.exists("all.slots", lambda s: s["item"] != s["doc"]).alias("reworded"))
    found = spans.filter(F.col("coverage") >= LEAST_SHARE)
    best = F.max_by(F.struct(F.col("first").cast("long").alias("first_word"), "coverage", "reworded"),
                    F.struct("coverage", -F.col("first"), "reworded"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def _own_words(found: DataFrame) -> DataFrame:
    """Windows of documents, each with its own words (``filled``: a text per place) instead of the document's arrays.

    All windows found in a document are in memory together, as one generated loop makes them; so they must leave it without
    those arrays, and the first step has no lambda, which generated code has no place for.
    """
    at, own = F.shiftright("begin", 3), F.col("begin").bitwiseAND(KINDS - 1)
    first = F.when(own == NAMED, F.get("named.at", at)).otherwise(at)
    width = F.when(own >= RAW, own - (RAW - 1)).otherwise(F.lit(WIDTH))
    # Where the places of the form with names begin, and the last one ends.
    ends = F.when(own == NAMED, F.array_append(F.slice("named.at", at + 1, WIDTH), F.coalesce(
        F.get("named.at", at + WIDTH), F.size("words"))))
    # A window without names stands in both forms.
    named_place = F.when((own == PLAIN) & (F.size("named") > 0),
                         F.size(F.array_intersect("named.at", F.sequence(F.lit(0), at))) - 1).otherwise(at)
    rows = found.withColumn("begin", F.get("begins", "key_at")).withColumn("ends", ends).select(
        "doc_id", "version", "window", own.alias("own"), at.alias("place"), named_place.alias("named_place"), first.alias("first"),
        F.when(own == PLAIN, F.slice("form", at + 1, WIDTH)).when(own == NAMED, F.slice("named.form", at + 1, WIDTH)).alias("form"),
        F.slice("words", first + 1, F.coalesce(F.get("ends", F.lit(WIDTH)) - first, width)).alias("around"), "ends")
    runs = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda k: F.array_join(F.slice(
        "around", F.get("ends", k) - F.get("ends", F.lit(0)) + 1, F.get("ends", k + 1) - F.get("ends", k)), " "))
    return rows.withColumn("filled", F.when(F.col("ends").isNull(), F.col("around")).otherwise(runs)).drop("around", "ends")


def _together(spans: str) -> Column:
    """The diagonals as one, longest first, without those that add no place or fill a placeholder otherwise."""
    none = F.struct(F.array().cast("array<struct<item_place:int,nth:int>>").alias("places"),
                    F.lit(None).cast("struct<item_place:int,first:int>").alias("first"),
                    F.array().cast("array<struct<item:string,doc:string>>").alias("slots"))

    def add(held, span):
        places, slots = F.array_union(held["places"], span["places"]), F.array_union(held["slots"], span["slots"])
        return F.when((F.size(places) > F.size(held["places"])) & _one_to_one(slots), F.struct(
            places.alias("places"), F.least(held["first"], span["first"]).alias("first"), slots.alias("slots"))).otherwise(held)

    return F.aggregate(spans, none, add)


def _covered(places: str) -> Column:
    """Windows that are matched, or all of whose words lie in matched ones."""
    order = F.array_sort(places)
    between = F.zip_with(order, F.slice(order, 2, F.size(places)), lambda a, b: F.when(
        b["item_place"] - a["item_place"] <= WIDTH, b["nth"] - a["nth"] - 1).otherwise(0))
    return F.size(places) + F.aggregate(between, F.lit(0), lambda total, n: total + n)


def _one_to_one(slots: Column | str) -> Column:
    return ((F.size(F.array_distinct(F.transform(slots, lambda s: s["item"]))) == F.size(slots))
            & (F.size(F.array_distinct(F.transform(slots, lambda s: s["doc"]))) == F.size(slots)))


def without_benchmark(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found: each row by its own text, also those that share an id or
    have none."""
    row = F.xxhash64(docs["doc_id"], docs["text"])
    bad = contaminated(spark, docs.select(row.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("__row")).distinct()
    return docs.join(bad, row == F.col("__row"), "left_anti").select(*docs.columns)
