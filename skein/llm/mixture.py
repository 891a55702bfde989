"""Mixing sources to target weights, by weighted sampling without replacement (Efraimidis and Spirakis).

Every record draws an exponential key, scaled by its quality weight; within a source the records in key order are a
weighted random permutation. A source's token budget is filled by complete epochs first and then by the records whose
prefix sum of tokens, in key order, fits into the rest; a last record closes the gap where one makes it smaller. The
key at which a budget ends is found by narrowing: the range of keys is cut into equal parts, their tokens are summed,
and the part in which the budget ends is cut again, until it holds few records. Only those are put in order one by one,
so no source is ever ordered in one task, however its keys are distributed.
"""

from __future__ import annotations

import base64
import functools
import os

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.canonical import SPACE, squeeze
from skein.runtime import cut, join_small, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pre-tokenisation pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Records of a source that are put in order one by one, at most, and parts into which a range of keys is cut.
EDGE_ROWS, PARTS = 4096, 1024
#: Keys are kept as whole numbers in units of 2 ** -KEY_BITS.
KEY_BITS = 40


@functools.cache
def _encoding(path: str):  # noqa: ANN202
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("skein", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; null counts 0. The vocabulary file of the driver is sent to the executors."""
    spark.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(SparkFiles.get(name)).encode_ordinary
        return texts.map(lambda s: len(encode(s)) if s else 0).astype("int64")

    return count(text)


def quality(text: Column) -> Column:
    """A weight in [0.05, 1]: the geometric mean of five signs of prose, each from 0 to 1.

    They are the share of words with letters only, a mean word length like that of written language, few repeated words
    for the length, lines that end like sentences, and enough words for a passage. Blank texts have the least weight.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    packed = F.struct(words.alias("w"), lines.alias("l"))

    def weight(x: Column) -> Column:
        n = F.greatest(F.size(x["w"]), F.lit(1)).cast("double")
        spoken = F.size(F.filter(x["w"], lambda w: w.rlike(r"^[\p{Ps}\p{Pi}\"']*\p{L}[\p{L}\p{M}'\u2019-]*[\p{P}]*$"))) / n
        mean = F.aggregate(x["w"], F.lit(0), lambda a, w: a + F.length(w)) / n
        usual = F.greatest(F.lit(0.0), 1 - F.abs(mean - 6.0) / 6.0)
        distinct = F.size(F.array_distinct(x["w"])) / n
        fresh = F.least(F.lit(1.0), distinct / F.pow(n, F.lit(-0.2)))
        ended = (F.size(F.filter(x["l"], lambda y: F.rtrim(y).rlike("[.!?:;][\"')\\]]*$"))) + 1) / (F.size(x["l"]) + 1.0)
        enough = F.least(F.lit(1.0), n / 40.0)
        return F.greatest(F.lit(0.05), F.pow(spoken * usual * fresh * ended * enough, F.lit(0.2)))

    # through an array, so that the words are split once
    return F.element_at(F.transform(F.array(packed), weight), 1)


def _uniform(*columns: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the columns and the seed alone."""
    return (F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(2**52)).cast("double") + 0.5) / float(2**52)


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, vocabulary: str = VOCABULARY, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(chosen, report).

    chosen: (doc_id, source, n_tokens, copies) for every record used, copies at most max_repeats of its source.
    report: (source, target_share, max_repeats, available_documents, available_tokens, budget_tokens, epochs,
    chosen_documents, chosen_tokens, actual_share) for every source of targets.

    Source names are compared without edge white space and case; the same name twice in targets: the largest share
    counts. Records with null or empty text have no size and are never chosen. Without total_tokens the total is the
    largest at which every source that occurs can have its share (shares of sources that don't occur are divided among
    the others in proportion); with it, sources that fall short give all their copies and the others fill up in
    proportion. Targets without a positive share or repeats get nothing.
    """
    spark: SparkSession = documents.sparkSession
    name = lambda c: F.lower(squeeze(F.col(c)))
    wanted = (
        targets.select(name("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.coalesce("max_repeats", F.lit(0)).cast("int").alias("max_repeats"))
        .filter("source <> ''")
        .groupBy("source")
        .agg(F.max(F.struct(F.coalesce("target_share", F.lit(0.0)).alias("s"), F.col("max_repeats").alias("m"))).alias("x"))
        .select("source", F.greatest(F.col("x.s"), F.lit(0.0)).alias("target_share"), F.greatest(F.col("x.m"), F.lit(0)).alias("max_repeats"))
    )
    listed = join_small(documents.select("doc_id", name("source").alias("source"), "text").filter(F.length("text") > 0), wanted.select("source"), ["source"])
    u = _uniform(F.col("doc_id"), seed=seed)
    sized = cut(
        spread(listed, "doc_id")
        .select("doc_id", "source", token_count(spark, F.col("text"), vocabulary).alias("n_tokens"), (-F.log(u) / quality(F.col("text")) * float(2**KEY_BITS)).cast("long").alias("_key"))
        .filter("n_tokens > 0")
    )  # _key: the exponential key -ln(u) / weight
    stats = sized.groupBy("source").agg(F.count("*").alias("available_documents"), F.sum("n_tokens").alias("available_tokens"))
    plan = cut(_budgets(wanted.join(stats, "source", "left").na.fill(0, ["available_documents", "available_tokens"]), total_tokens))
    marked = join_small(sized, _edges(sized, plan), ["source"])
    # keys below the edge's range are in, those above it are out; only those within are ordered record by record
    whole = marked.filter("_key < _low or _key >= _high").withColumn("_extra", (F.col("_key") < F.col("_low")).cast("int"))
    upto = F.col("_below") + F.sum("n_tokens").over(Window.partitionBy("source").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    # records in order as long as they fit; then the one whose size fills the gap best, if any makes it smaller
    partly = (
        marked.filter("_key >= _low and _key < _high").withColumn("_fits", upto <= F.col("rest_tokens"))
        .withColumn("_gap", F.col("rest_tokens") - F.col("_below") - F.coalesce(F.sum(F.when(F.col("_fits"), F.col("n_tokens"))).over(Window.partitionBy("source")), F.lit(0)))
        .withColumn("_off", F.abs(F.col("_gap") - F.col("n_tokens")))
        .withColumn("_place", F.row_number().over(Window.partitionBy("source", "_fits").orderBy("_off", "_key", "doc_id")))
        .withColumn("_extra", (F.col("_fits") | ((F.col("_place") == 1) & (F.col("_off") < F.col("_gap")))).cast("int"))
    )
    same = ["doc_id", "source", "n_tokens", "epochs", "max_repeats", "_extra"]
    chosen = (
        whole.select(*same).unionByName(partly.select(*same))
        .withColumn("copies", F.least(F.col("epochs") + F.coalesce("_extra", F.lit(0)), F.col("max_repeats")).cast("int"))
        .filter("copies > 0").select("doc_id", "source", "n_tokens", "copies")
    )
    used = chosen.groupBy("source").agg(F.count("*").alias("chosen_documents"), F.sum(F.col("n_tokens") * F.col("copies")).alias("chosen_tokens"))
    total = used.agg(F.sum("chosen_tokens").alias("_total"))
    report = (
        plan.join(used, "source", "left").na.fill(0, ["chosen_documents", "chosen_tokens"]).crossJoin(F.broadcast(total))  # one row
        .select("source", "target_share", "max_repeats", "available_documents", "available_tokens", "budget_tokens", "epochs", "chosen_documents", "chosen_tokens",
                F.coalesce(F.col("chosen_tokens") / F.col("_total"), F.lit(0.0)).alias("actual_share"))
    )
    return chosen, report


def _edges(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, epochs, max_repeats, rest_tokens, _low, _high, _below) for every source with records: the range of keys
    in which its rest ends, with at most EDGE_ROWS records or a single key, and the tokens below it."""
    spans = sized.groupBy("source").agg(F.min("_key").alias("_low"), (F.max("_key") + 1).alias("_high"), F.count("*").alias("_n"))
    edges = cut(join_small(spans, plan.select("source", "epochs", "max_repeats", "rest_tokens"), ["source"]).withColumn("_below", F.lit(0).cast("long")))
    while True:
        wide = edges.filter((F.col("_n") > EDGE_ROWS) & (F.col("_high") - F.col("_low") > 1)).withColumn("_width", F.ceil((F.col("_high") - F.col("_low")) / PARTS).cast("long"))
        if wide.isEmpty():
            return edges.drop("_n")
        inside = join_small(sized, wide, ["source"]).filter("_key >= _low and _key < _high")
        parts = inside.groupBy("source", ((F.col("_key") - F.col("_low")) / F.col("_width")).cast("long").alias("_part")).agg(F.sum("n_tokens").alias("_t"), F.count("*").alias("_m"))
        before = F.coalesce(F.sum("_t").over(Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most PARTS rows
        reached = join_small(parts.withColumn("_before", before), wide, ["source"]).filter("_below + _before <= rest_tokens")
        last = reached.groupBy("source").agg(F.max_by(F.struct("_part", "_before", "_m"), "_part").alias("x"))
        narrowed = wide.join(last, "source").withColumn("_low", F.col("_low") + F.col("x._part") * F.col("_width")).withColumn("_high", F.least(F.col("_low") + F.col("_width"), F.col("_high"))).withColumn("_below", F.col("_below") + F.col("x._before")).withColumn("_n", F.col("x._m"))
        done = edges.join(wide.select("source"), "source", "left_anti")
        edges = cut(done.unionByName(narrowed.select(*edges.columns)))


def _budgets(sources: DataFrame, total_tokens: int | None) -> DataFrame:
    """Adds budget_tokens, epochs (complete ones) and rest_tokens to one row per source."""
    rows = sources.toPandas()  # one short row per target source: the mixture's settings, not its data
    capacity = rows.available_tokens * rows.max_repeats
    able = (capacity > 0) & (rows.target_share > 0)
    share = rows.target_share.where(able, 0.0)
    share = share / share.sum() if share.sum() > 0 else share
    if total_tokens is None:
        total = (capacity[able] / share[able]).min() if able.any() else 0.0
        budget = share * total
    else:
        budget, open_, left = share * 0.0, able.copy(), float(total_tokens)
        while open_.any() and left > 0:
            part = share.where(open_, 0.0) / share[open_].sum() * left
            full = open_ & (part >= capacity)
            if not full.any():
                budget[open_] = part[open_]
                break
            budget[full] = capacity[full].astype(float)
            left -= float(capacity[full].sum())
            open_ &= ~full
    rows["budget_tokens"] = budget.round().astype("int64").clip(upper=capacity)
    size = rows.available_tokens.clip(lower=1)
    rows["epochs"] = (rows.budget_tokens // size).astype("int32")
    rows["rest_tokens"] = rows.budget_tokens - rows.epochs * rows.available_tokens
    kinds = {"source": "string", "target_share": "double", "max_repeats": "int", "available_documents": "long", "available_tokens": "long", "budget_tokens": "long", "epochs": "int", "rest_tokens": "long"}
    return sources.sparkSession.createDataFrame(rows[list(kinds)], ", ".join(f"{c} {t}" for c, t in kinds.items()))
