"""Helpers that several operators share."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space. ``bytes.split()`` splits at exactly these.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once an application, so that they need no installation."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        top = Path(__file__).resolve().parent.parent
        to = Path(tempfile.mkdtemp(prefix="chainloom-code-")) / "chainloom_code.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(to))  # served by the driver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's shared folder; set a local one only where none is named (tests, local mode)."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="chainloom-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    What led to it isn't needed any more, so the driver is asked to collect its garbage: Spark then
    removes shuffle files that nothing refers to, which otherwise stay until that happens by chance."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def release(spark: SparkSession) -> None:
    """Once more after a cut of much shuffled data: until its events are handled, about a second, they hold it."""
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()


def least_hashes(rows: DataFrame, key: str, limit: int, bits: int = 14) -> DataFrame:
    """``rows`` (``key``, ``h``, ...): of each key the ``limit`` rows of the smallest hash, about: whole ranges of
    hashes are taken until there are enough, and what they hold too many is ranked. Keys must be few.

    Counts by key and the hash's upper bits are aggregated before any shuffle, so that no task sees all rows of a key."""
    rows = rows.withColumn("_range", F.shiftrightunsigned("h", 64 - bits))
    by = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(by), F.lit(0)))
    last = ranges.where(F.col("before") < limit).groupBy(key).agg(F.max("_range").alias("_last"))
    near = rows.join(F.broadcast(last), key).where(F.col("_range") <= F.col("_last"))  # one row a key
    return near.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_range", "h"))).where(F.col("_r") <= limit).drop("_r", "_range", "_last")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, inside one expression."""
    return F.transform(F.array(value), body)[0]


def utf8(name: str = "text") -> Column:
    """The text as bytes (null: empty), so that Python workers get it without decoding."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))
