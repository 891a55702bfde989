"""Top N items within every group, by two-stage salted ranking.

Every group is hashed into subgroups; each subgroup keeps its N best, then the survivors (at most N per subgroup) are
ranked per group. A group with a third of all rows is thus ranked by as many tasks as there are subgroups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.canonical import SPACE

SUBGROUPS = 64

#: English month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_WORD = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"


def top_n(items: DataFrame, group: list[str], order: list[Column], n: int, subgroup_by: list[str], subgroups: int = SUBGROUPS) -> DataFrame:
    """The n first rows of every group in `order`, with their `rank` from 1; all columns are kept.

    `order` must end in an identifier for ties to be settled the same way in every run. Null group values form a
    group of their own; an empty input gives an empty result. `subgroup_by` names columns whose hash picks the
    subgroup. Temporary columns begin with `_top_`; a column named `rank` in the input is replaced.
    """
    salted = items.drop("rank").withColumn("_top_salt", F.pmod(F.xxhash64(*subgroup_by), F.lit(subgroups)).cast("int"))
    inner = Window.partitionBy(*group, "_top_salt").orderBy(*order)
    survivors = salted.withColumn("_top_rank", F.row_number().over(inner)).filter(F.col("_top_rank") <= n).drop("_top_rank", "_top_salt")
    outer = Window.partitionBy(*group).orderBy(*order)
    return survivors.withColumn("rank", F.row_number().over(outer)).filter(F.col("rank") <= n)


def date_key(text: Column) -> Column:
    """yyyymmdd as an integer from a date in one of several notations; unknown month or day are 00; 0 without a date.

    Notations: 2009-06-21, 2010/01/01, 2016-12, 2006 (each may be followed by a time of day), Dec 2020, 10 Nov 2023,
    Jun 15, 2024. Years 0000 and months or days out of range are unknown.
    """
    t = F.coalesce(F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", ""), F.lit(""))
    part = lambda pattern, k: F.coalesce(F.nullif(F.regexp_extract(t, pattern, k), F.lit("")).cast("int"), F.lit(0))
    number = r"^(\d{4})(?:[-/.](\d{1,2})(?:[-/.](\d{1,2}))?)?(?:[T ].*)?$"
    spoken = t.rlike(_WORD)
    month_name = F.lower(F.regexp_extract(t, _WORD, 1))
    year = F.when(spoken, part(r"(?:^|\D)(\d{4})(?:\D|$)", 1)).otherwise(part(number, 1))
    month = F.when(spoken, F.coalesce(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_name).cast("int"), F.lit(0))).otherwise(part(number, 2))
    day = F.when(spoken, part(r"(?:^|\D)(\d{1,2})(?:\D|$)", 1)).otherwise(part(number, 3))
    month = F.when(month.between(1, 12), month).otherwise(0)
    day = F.when((month > 0) & day.between(1, 31), day).otherwise(0)
    return F.when(year > 0, year * 10000 + month * 100 + day).otherwise(0)


def latest_papers(papers: DataFrame, n: int = 10) -> DataFrame:
    """(author_id, external_id, date_key, rank): the n latest papers of every author.

    An external_id counts once per author, with the row fetched last (equal fetch times: the later date). Rows without
    an external_id identify nothing and are left out. Order: date, else year (0 is no year), papers with neither last;
    ties go to the greater external_id by code point.
    """
    dated = date_key(F.col("publication_date"))
    key = F.when(dated > 0, dated).when(F.col("year") > 0, F.col("year").cast("int") * 10000).otherwise(0)
    # fetch time and date in one decimal: the aggregate keeps one fixed-width value per key, so it stays a hash aggregate
    stamp = (F.coalesce(F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit(-(10**17))) + F.lit(10**17)).cast("decimal(20,0)")
    once = (
        papers.filter(F.col("external_id").isNotNull())
        .select("author_id", "external_id", (stamp * F.lit(10**8).cast("decimal(9,0)") + key.cast("decimal(9,0)")).cast("decimal(30,0)").alias("_k"))
        .groupBy("author_id", "external_id")
        .agg(F.max("_k").alias("_k"))
        .select("author_id", "external_id", (F.col("_k") % F.lit(10**8).cast("decimal(9,0)")).cast("int").alias("date_key"))
    )
    return top_n(once, ["author_id"], [F.col("date_key").desc(), F.col("external_id").desc()], n, ["external_id"])
