"""CSV folders as feeds: incremental reading, a stored schema, and new columns in later files."""

from __future__ import annotations

import csv
import io
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import numbered_folders, path_exists

CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE"}
# A file counts however old it is. The driver then keeps the names of all files seen; where that is too much, a source
# folder can be cleaned with Spark's option cleanSource.
ANY_AGE = {"maxFileAge": "36500d"}
CORRUPT = "_corrupt_record"
# Numbers, from narrow to wide. A text counts as a number only if the number is written back the same way, so that
# telephone numbers and codes with leading zeros stay text.
NUMBERS = {"int": r"^(0|-?[1-9][0-9]*)$", "bigint": r"^(0|-?[1-9][0-9]*)$",
           "double": r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"}


def csv_feed(spark: SparkSession, folder: str, schema: T.StructType,
             max_files: int | None = None) -> DataFrame:
    """A folder of CSV files with one fixed schema as a stream; each file is read once.

    A file whose header differs from the schema stops the stream instead of shifting columns.
    """
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS, **ANY_AGE).option("enforceSchema", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def append_csv(df: DataFrame, folder: str) -> None:
    """Blanks around a value are part of it."""
    (df.write.mode("append").option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(folder))


def literal_path(path: str) -> str:
    """A file name as Spark's readers take it: characters of patterns stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def discover_files(spark: SparkSession, folders: Sequence[str], max_files: int | None = None) -> DataFrame:
    """Stream of the paths of new files, each once. File contents are not read."""
    schema = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("content", T.BinaryType())])

    def one(folder: str) -> DataFrame:
        reader = spark.readStream.format("binaryFile").schema(schema).options(**ANY_AGE)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        # The timestamp is fixed per micro-batch, also when the batch is run again after a failure.
        return reader.load(folder).select("path", F.current_timestamp().alias("seen_at"))

    return reduce(DataFrame.unionByName, [one(folder) for folder in folders])


class SchemaStore:
    """The schema of a feed, kept as one small file per version so that a repeated write is harmless. Its versions are
    a log: what was valid at a commit can be read later."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def versions(self, upto: int | None = None) -> list[int]:
        found = numbered_folders(self.spark, self.folder, "version")
        return [v for v in found if (upto is None or v <= upto) and path_exists(self.spark, f"{self.folder}/version={v}/_SUCCESS")]

    def at(self, version: int) -> T.StructType:
        """The schema saved with exactly this version."""
        row = self.spark.read.schema("schema_json string").json(f"{self.folder}/version={version}").first()
        return T.StructType.fromJson(json.loads(row[0]))

    def load(self, upto: int | None = None) -> T.StructType | None:
        """The schema valid at commit ``upto``, or the newest one. Only one file is opened."""
        for version in reversed(numbered_folders(self.spark, self.folder, "version")):
            if (upto is None or version <= upto) and path_exists(self.spark, f"{self.folder}/version={version}/_SUCCESS"):
                return self.at(version)
        return None

    def save(self, schema: T.StructType, version: int) -> None:
        row = self.spark.createDataFrame([(schema.json(),)], "schema_json string")
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/version={version}")


def infer_schema(spark: SparkSession, paths: Sequence[str], sampling_ratio: float = 1.0) -> T.StructType:
    """Column types from the data. Dates and times stay text: later files may write them differently."""
    found = (spark.read.options(**CSV_OPTIONS).option("inferSchema", "true")
             .option("samplingRatio", sampling_ratio).csv(list(paths)).schema)
    text = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, text) else f.dataType) for f in found])


def infer_and_store_schema(spark: SparkSession, folder: str, store: SchemaStore, version: int = 0) -> T.StructType:
    schema = store.load()
    if schema is None:
        schema = infer_schema(spark, [folder])
        store.save(schema, version)
    return schema


def schema_as_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema],
                                 "column_name string, data_type string")


def first_record(spark: SparkSession, path: str, size: int = 1 << 16) -> list[str]:
    """The first record of a CSV file that is not blank, from its first bytes; [] if there is none."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    while True:
        stream = files.open(jvm_path)
        try:
            data = stream.readNBytes(size)
        finally:
            stream.close()
        lines = list(io.StringIO(data.decode("utf-8", "replace").removeprefix("\ufeff"), newline=""))
        reader = csv.reader(lines)
        record = next((r for r in reader if any(v.strip() for v in r)), [])
        # A record that ends where the bytes end may go on.
        if reader.line_num < len(lines) or len(data) < size:
            return record
        size *= 4


def group_by_header(spark: SparkSession, paths: Iterable[str]) -> dict[tuple, list[str]]:
    """Files with the same header belong together. Only the first bytes of a file are read, like its entry in a listing."""
    paths = sorted(set(paths))  # a pattern in a name can make Spark list a file several times
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda path: first_record(spark, path), paths))
    groups: dict[tuple, list[str]] = defaultdict(list)
    for path, names in zip(paths, headers):
        if names:
            groups[_column_names(names)].append(path)
    return dict(groups)


def _column_names(names: Sequence[str]) -> tuple:
    """Names of a header; a missing or repeated name gets its position."""
    lowered = [n.strip().lower() for n in names]
    return tuple(f"_c{i}" if not n.strip() else f"{n}{i}" if lowered.count(low) > 1 else n
                 for i, (n, low) in enumerate(zip(names, lowered)))


def read_as_text(spark: SparkSession, known: Sequence[str], groups: dict[tuple, list[str]]) -> DataFrame:
    """All files as one DataFrame of texts; a column that a file lacks is NULL, and a line with too many or too few
    values is kept whole in a column of its own. Names match in any case, in the spelling seen first.

    CSV binds columns by position, so each group of equal headers is read with its own column order.
    """
    spelling = {c.lower(): c for c in known}
    parts = []
    for columns, paths in groups.items():
        names = [spelling.setdefault(c.lower(), c) for c in columns]
        order = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        # A header with a line break in quotes is one record only to a reader that does not split files at lines.
        parts.append(spark.read.schema(order).options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
                     .option("multiLine", any("\n" in c or "\r" in c for c in columns))
                     .csv([literal_path(p) for p in paths]))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
                         for c in spelling.values()], CORRUPT)


# What is counted of a column's values, besides how many there are: those that fit each number type, all numbers, truth
# values, and codes, which look like numbers but would be written back otherwise.
KINDS = ("n", "int", "bigint", "number", "boolean", "code")


def kind_counts(columns: dict[str, str]) -> list[Column]:
    """Counts of the kinds of values of each column ({name: column that holds its text}), as ``name of the kind, place``."""
    out = []
    for i, text in enumerate(columns.values()):
        value = F.col(text)
        number, canonical = value.try_cast("double").isNotNull(), value.rlike(NUMBERS["double"])
        tests = {"n": value.isNotNull(), "number": number, "boolean": value.isin("true", "false"),
                 "code": number & ~canonical & value.rlike(r"^\s*[+-]?[0-9.]"),
                 **{t: value.rlike(NUMBERS[t]) & value.try_cast(t).isNotNull() for t in ("int", "bigint")}}
        out += [F.count_if(tests[kind]).alias(f"{kind}_{i}") for kind in KINDS]
    return out


def add_counts(before: T.StructType, columns: Sequence[str], found: dict[str, int]) -> dict[str, dict[str, int]]:
    """The counts of every column over all commits: those kept in the schema before, and those of this commit."""
    kept = {f.name: f.metadata.get("counts", {}) for f in before}
    out = {c: dict(counts) for c, counts in kept.items()}
    for i, c in enumerate(columns):
        out[c] = {kind: kept.get(c, {}).get(kind, 0) + found[f"{kind}_{i}"] for kind in KINDS}
    return out


def type_of(counts: dict[str, int]) -> str:
    """The type that a column's counts allow. It depends on sums alone, so on no order of files and no cut into commits.

    A number type if more than half of the values are numbers, as narrow as all of them fit; the others are rescued. A code
    makes the column text, as do mixtures without such a majority. A truth value if all are.
    """
    if not counts.get("n") or counts["code"]:
        return "string"
    if counts["boolean"] == counts["n"]:
        return "boolean"
    if 2 * counts["number"] <= counts["n"]:
        return "string"
    return next((t for t in ("int", "bigint") if counts[t] == counts["number"]), "double")


def misfits(kind: str, counts: dict[str, int]) -> int:
    """How many of the counted values do not fit a type that was chosen for them."""
    return counts["n"] - {"string": counts["n"], "boolean": counts["boolean"], "double": counts["number"]}.get(kind, counts.get(kind, 0))


def typed_schema(columns: Sequence[str], declared: dict[str, str], counts: dict[str, dict[str, int]]) -> T.StructType:
    """Fields in their types, declared or counted; the counts travel in the fields."""
    declared = {c.lower(): t for c, t in declared.items()}
    fields = []
    for c in columns:
        kind = declared.get(c.lower()) or type_of(counts.get(c, {}))
        held = {} if c.lower() in declared else {"counts": counts.get(c, {})}
        fields.append(T.StructField(c, T.StructType.fromDDL(f"x {kind}")[0].dataType, True, held))
    return T.StructType(fields)


def typed(rows: DataFrame, types: dict[str, str], rescued: str | None = None) -> DataFrame:
    """Texts in their types. A value that does not fit is NULL; ``rescued`` names a map that holds it by column."""
    columns = [F.col(c).try_cast(t).alias(c) for c, t in types.items()]
    if rescued:
        kept = [F.struct(F.lit(c).alias("key"), F.when(misfit(c, t), F.col(c)).alias("value")) for c, t in types.items()]
        if CORRUPT in rows.columns:
            kept.append(F.struct(F.lit(CORRUPT).alias("key"), F.col(CORRUPT).alias("value")))
        held = F.filter(F.array(*kept), lambda e: e["value"].isNotNull())
        columns.append(F.when(F.size(held) > 0, F.map_from_entries(held)).alias(rescued))
    return rows.select(*columns, *[c for c in rows.columns if c not in types and c != CORRUPT])


def misfit(column: str, kind: str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def typed_or_stop(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Like :func:`typed`, for a stream whose types cannot change any more: a number that is too wide for its column stops
    the stream instead of passing as NULL. Started again, it has the wider type."""
    checked = []
    for c, t in types.items():
        wide = misfit(c, t) & F.col(c).rlike(NUMBERS["double"]) if t in ("int", "bigint") else F.lit(False)
        text = F.concat(F.lit(f"the type of column {c} has widened from {t}; restart the stream: "), F.col(c))
        checked.append(F.when(wide, F.raise_error(text).cast("string")).otherwise(F.col(c)).alias(c))
    return typed(rows.select(*checked, *[c for c in rows.columns if c not in types]), types)
