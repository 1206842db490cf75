"""Helpers shared by the operators: tables in the shared folder, code for the workers."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.session import shared_dir

# ASCII white space separates words everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch while whole texts go through Python.
TEXT_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors.

    ``by`` names a column of few values, each of which gets a folder.
    """
    path = shared_dir(df.sparkSession, purpose)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame, folder_of: str = "") -> None:
    """Remove a table that ``materialize`` wrote, once nothing that is still to run reads it.

    ``folder_of`` (``column=value``) leaves all but the folder of one value where it is.
    """
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if not folder.endswith(folder_of):
            continue
        where, path = pafs.FileSystem.from_uri(folder) if ":/" in folder else (pafs.LocalFileSystem(), folder)
        where.delete_dir(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished queries removed now, from every executor's disk.

    Spark removes them once the driver's objects of a query are collected, which a driver with memory
    to spare puts off while the files of one query after the other add up.
    """
    for _ in range(2):  # what the first round lets go of may hold more
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def ship_code(spark: SparkSession) -> None:
    """Give Python workers this package wherever they run, once for each application."""
    context = spark.sparkContext
    name = "crestline-code.zip"
    if any(str(f).endswith(name) for f in context._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="crestline-code-")) / name  # Spark serves it from here
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(target))


def small_batches(spark: SparkSession) -> None:
    """Bound what a worker holds of long texts at a time."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of a row as one struct, so that no column name can clash with ours."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, names: list[str], row: str = "_row") -> list[Column]:
    return [F.col(row).getField(c).alias(c) for c in names]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that a table does not have yet."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
