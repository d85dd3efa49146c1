"""Reading tables and keeping intermediate results where every executor can read them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir


PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application; they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, label: str, with_folder: bool = False):
    """Write to the shared folder and read back: cuts the lineage and survives lost executors.

    ``with_folder`` gives the pair (folder, DataFrame), for a table to :func:`discard` when nothing reads it any more.
    """
    folder = work_dir(spark, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    return (folder, back) if with_folder else back


def discard(spark: SparkSession, folder: str) -> None:
    """Remove an intermediate table of this run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id's text has the given remainder; a null id counts as the text 'null'."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))) % modulus) == remainder
