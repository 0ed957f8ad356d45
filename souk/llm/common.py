"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be any that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage (a lost executor does not recompute what came before) and
    lets several consumers share one computation, column-pruned.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of a row as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def running(df: DataFrame, group: list[str], slice_: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``out``: the inclusive running total of ``value`` within ``group`` in the order (slice, *order).

    A task holds a slice, or the sums of a group's slices, never a whole group.
    """
    sums = df.groupBy(*group, slice_).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_o_{c}") for c in (*group, slice_)],
                          F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_offset"))
    on = [df[c].eqNullSafe(offsets[f"_o_{c}"]) for c in (*group, slice_)]
    inner = Window.partitionBy(*group, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn("_within", F.sum(value).over(inner)).join(offsets, on, "left")
            .withColumn(out, F.col("_offset") + F.col("_within"))
            .drop("_within", "_offset", *[f"_o_{c}" for c in (*group, slice_)]))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (Spark copies the archive to every executor)."""
    sc = spark.sparkContext
    if "souk.zip" in sc._python_includes:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="souk-code-"), "souk.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def sliced(batches, rows: int = 256):
    """Arrow batches cut into short ones: few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
