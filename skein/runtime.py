"""Session-level helpers shared by all operators: checkpoints, size-checked broadcasts, input spreading."""

from __future__ import annotations

import atexit
import shutil
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side with short rows may be broadcast (checked by counting, never assumed).
BROADCAST_ROWS = 200_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, as spark.checkpoint.dir names it.

    Where the session names none, a temporary folder serves a local master, as in tests; on a cluster that is an error,
    since executors could not share it. Files of a checkpoint are removed when nothing refers to it any more.
    """
    sc = spark.sparkContext
    sc._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="skein-checkpoint-")
        atexit.register(shutil.rmtree, named, True)
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: computed once, lineage cut, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    out._is_cut = True
    return out


def settled(df: DataFrame) -> DataFrame:
    """df itself if it was just cut, else df cut: counting it and joining it then compute it only once."""
    return df if df.__dict__.get("_is_cut") else cut(df)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when df has at most max_rows rows; counts at most max_rows + 1 of them."""
    if max_rows < 0:
        return False
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Join with a side that is usually small, under few and possibly hot keys.

    Broadcast when the counted size allows; otherwise a shuffle join in which the right side is replicated over
    `salts` salts, so that a key with a third of all left rows is spread over that many tasks. The right side is written
    once and counted from there.
    """
    right = settled(right)
    if is_small(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    if salts <= 1:
        return left.join(right, on, how)
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns if c not in on] or [F.lit(0)]), F.lit(salts)).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def meet(left: DataFrame, right: DataFrame, keys: list[str], piece: int = 2_000) -> DataFrame:
    """left joined with right on keys, every pair of them: a key of many rows is dealt in pieces of both sides.

    Every pair of pieces of a key meets in a task of its own, so that no key is bound to one task. Columns other than
    the keys have different names on both sides.
    """
    pieces = lambda n: F.ceil(F.col(n) / piece).cast("int")
    counts = cut(left.groupBy(*keys).agg(F.count("*").alias("n")).join(right.groupBy(*keys).agg(F.count("*").alias("m")), keys).select(*keys, pieces("n").alias("_n"), pieces("m").alias("_m")))
    if counts.filter("_n > 1 or _m > 1").isEmpty():
        return left.join(right, keys)
    large = counts.filter("_n > 1 or _m > 1")  # at most as many keys as rows / piece
    place = lambda df, n: F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = join_small(left, large, keys, "left").na.fill(1, ["_n", "_m"]).withColumn("_i", place(left, "_n")).withColumn("_j", every("_m")).drop("_n", "_m")
    theirs = join_small(right, large, keys, "left").na.fill(1, ["_n", "_m"]).withColumn("_j", place(right, "_m")).withColumn("_i", every("_n")).drop("_n", "_m")
    return mine.join(theirs, [*keys, "_i", "_j"]).drop("_i", "_j")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan at least as many partitions as the cluster has cores, for stages that are heavy on CPU.

    Inputs that already have enough partitions pass through without a shuffle.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)


def frame(rows: list, columns: list[str]) -> pd.DataFrame:
    """Rows (tuples, or dictionaries with missing fields as None) as plain object columns for Spark to convert."""
    values = [[r.get(c) for r in rows] for c in columns] if rows and isinstance(rows[0], dict) else [list(v) for v in zip(*rows, strict=True)] or [[] for _ in columns]
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in zip(columns, values, strict=True)})
