"""Matching entities across two sources without a common key, by collective graph linkage.

Candidates are all pairs whose names may denote one person (blocks of surname and initial, or a shared title). The edges of
this graph are weighted by the attributes that both sides share, the rarer the heavier; edges that are light against
the other edges of both their ends are pruned (meta-blocking). The scores that remain are then refined along the graph:
profiles that resemble each other support each other's match, and persons compete for a profile, until the accepted
matches no longer change.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.names import fold, misspelt, readings
from skein.runtime import cut, frame, join_small, meet

ACCEPT = 2.0
SUPPORT, RIVALRY = 0.6, 0.5
#: Rounds after which matches that still change are an error.
ROUNDS = 100
#: Entities of one side of a block that meet those of the other in one task.
PIECE = 2_000
#: Rarity (log of entities per entity that has it, so a share and not a number of them) from which a word may be part of
#: a phrase, and of a phrase to count.
WORD_RARITY, PHRASE_RARITY, PHRASE_RANGE = 1.8, 3.5, 2.0
#: Abbreviations in affiliations.
_UNITS = {"univ": "university", "dept": "department", "inst": "institute", "tech": "technology", "coll": "college"}
_WORDS = re.compile(r"[^\W\d_]+")


def _stem(word: str) -> str:
    return word[:-1] if len(word) > 3 and word.endswith("s") and not word.endswith("ss") else word


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(side, id, kind, text_no, pos, word): words of titles and other texts, segments of affiliations."""
    for batch in batches:
        rows = []
        for side, key, titles, texts, affiliations in batch[["side", "id", "titles", "texts", "affiliations"]].itertuples(index=False):
            for kind, values in (("title", titles), ("text", texts)):
                for n, value in enumerate(values if values is not None else []):
                    for pos, w in enumerate(_WORDS.findall(fold(value or ""))):
                        if len(w) > 2:
                            rows.append((side, key, kind, n, pos, _stem(w)))
            for n, value in enumerate(affiliations if affiliations is not None else []):
                for segment in (value or "").split(","):
                    ws = [_UNITS.get(w, w) for w in _WORDS.findall(fold(segment)) if w != "the"]
                    if ws:
                        rows.append((side, key, "unit", n, 0, " ".join(ws)))
                    # the field a department is named after is a topic as well
                    if ws[:2] == ["department", "of"]:
                        rows += [(side, key, "text", 1_000_000 + n, pos, _stem(w)) for pos, w in enumerate(ws[2:])]
        yield frame(rows, ["side", "id", "kind", "text_no", "pos", "word"])


def attributes(entities: DataFrame) -> DataFrame:
    """(side, id, kind, value, rarity) of entities (side, id, titles, texts, affiliations); value is a hash.

    kinds: word, phrase (two neighbouring words in either order, both rare), title (the words of a whole title in
    alphabetical order) and unit (a segment of an affiliation). Misspelt words count as the word they stand for.
    """
    raw = cut(entities.mapInPandas(_words, f"side string, id {dict(entities.dtypes)['id']}, kind string, text_no long, pos long, word string"))
    spoken = raw.filter("kind <> 'unit'")
    fixes = cut(misspelt(spoken.groupBy(F.col("word").alias("token")).agg(F.count_distinct("id").alias("n"))))
    right = join_small(spoken, fixes.withColumnRenamed("token", "word"), ["word"], "left", salts=1).withColumn("word", F.coalesce("canon", "word")).drop("canon")
    total = float(max(entities.count(), 2))
    df = cut(right.groupBy("word").agg(F.count_distinct("side", "id").alias("df")).withColumn("rarity", F.log(F.lit(total) / F.col("df"))))
    known = cut(join_small(right, df.select("word", "rarity"), ["word"], salts=1))
    line = Window.partitionBy("side", "id", "kind", "text_no").orderBy("pos")
    two = known.withColumn("next", F.lead("word").over(line)).withColumn("next_rarity", F.lead("rarity").over(line)).withColumn("gap", F.lead("pos").over(line) - F.col("pos"))
    two = two.filter((F.col("rarity") >= WORD_RARITY) & (F.col("next_rarity") >= WORD_RARITY) & (F.col("word") != F.col("next")) & (F.col("gap") == 1))
    phrases = two.select("side", "id", F.lit("phrase").alias("kind"), F.concat_ws(" ", F.least("word", "next"), F.greatest("word", "next")).alias("value"))
    words = known.select("side", "id", F.lit("word").alias("kind"), F.col("word").alias("value"))
    titles = known.filter("kind = 'title'").groupBy("side", "id", "text_no").agg(F.array_sort(F.collect_set("word")).alias("w")).filter(F.size("w") >= 3)  # the words of one title
    titles = titles.select("side", "id", F.lit("title").alias("kind"), F.concat_ws(" ", "w").alias("value"))
    units = raw.filter("kind = 'unit'").select("side", "id", "kind", F.col("word").alias("value"))
    # values are only ever compared, so a hash stands for each; the words of an entity count once before they move
    every = phrases.unionByName(words).unionByName(titles).unionByName(units).withColumn("value", F.xxhash64("value")).distinct()
    counts = every.groupBy("kind", "value").agg(F.count("*").alias("df"))
    # values that only one side has, or one entity, link nothing
    shared = counts.filter("df > 1").select("kind", "value", F.log(F.lit(total) / F.col("df")).alias("rarity"))
    return every.join(shared, ["kind", "value"])


def _given_score(a: Column, b: Column, la: Column, lb: Column) -> Column:
    """Points for the given names, null if they speak against one person."""
    ma, mb = F.substring(la, 2, 1), F.substring(lb, 2, 1)
    conflict = (ma != "") & (mb != "") & (ma != mb)
    same = (a == b) & (a != "")
    close = (a != "") & (b != "") & (F.least(F.length(a), F.length(b)) >= 4) & (F.levenshtein(a, b) <= 2) & (F.substring(a, 1, 1) == F.substring(b, 1, 1))
    initial = ((a == "") | (b == "")) & (F.substring(la, 1, 1) == F.substring(lb, 1, 1)) & (la != "")
    agreed = (ma != "") & (ma == mb)
    return F.when(conflict, None).when(same, F.when(agreed, 1.2).otherwise(1.0)).when(close, 0.7).when(initial, F.when(agreed, 0.5).otherwise(0.2))


def _candidates(names: DataFrame, titles: DataFrame) -> DataFrame:
    """(a, b) of all pairs that share a block and whose given names don't speak against one person.

    names: (side, id, surname, given, letters); titles: (side, id, value). Names that agree have the same initial, so
    a shared title is split by it as well.
    """
    initial = F.substring("letters", 1, 1).alias("i")
    by_surname = names.select("side", "id", "given", "letters", F.explode(F.split("surname", " ")).alias("block"), initial, F.lit("name").alias("by"))
    by_title = names.join(titles, ["side", "id"]).select("side", "id", "given", "letters", F.col("value").cast("string").alias("block"), initial, F.lit("title").alias("by"))
    rows = cut(by_surname.unionByName(by_title).filter("i <> ''").distinct())
    of = lambda k, key: rows.filter(F.col("side") == k).select("by", "block", "i", F.col("id").alias(key), F.col("given").alias(f"g_{key}"), F.col("letters").alias(f"l_{key}"))
    pairs = meet(of("a", "a"), of("b", "b"), ["by", "block", "i"], PIECE)
    return pairs.filter(_given_score(F.col("g_a"), F.col("g_b"), F.col("l_a"), F.col("l_b")).isNotNull()).select("a", "b").distinct()


#: Kinds of attributes by their code.
_KINDS = ("word", "phrase", "title", "unit")


def _packed(values: DataFrame) -> DataFrame:
    """(id, v): the attributes of every entity as whole numbers: a hash of 48 bits, the kind and the rarity.

    values: (id, kind, value, rarity). A value has one rarity, so equal attributes are equal numbers, and what two
    entities share is the intersection of two short arrays.
    """
    code = F.array_position(F.array(*[F.lit(k) for k in _KINDS]), F.col("kind")).cast("long") - 1
    rare = F.least(F.lit(16383), F.round(F.col("rarity") * 500)).cast("long")
    number = F.xxhash64("kind", "value").bitwiseAND(F.lit(-65536).cast("long")).bitwiseOR(F.shiftleft(code, 14)).bitwiseOR(rare)
    return values.groupBy("id").agg(F.collect_set(number).alias("v"))  # the attributes of one entity


def _edges(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, titles, phrases, words, units, fields, weight): what the two sides of each candidate share.

    left and right: (id, kind, value, rarity). Candidates that share nothing stay, with weight 0.
    """
    mine, theirs = _packed(left).select(F.col("id").alias("a"), F.col("v").alias("va")), _packed(right).select(F.col("id").alias("b"), F.col("v").alias("vb"))
    none = F.array().cast("array<bigint>")
    joined = candidates.join(mine, "a", "left").join(theirs, "b", "left")
    shared = joined.select("a", "b", F.array_intersect(F.coalesce("va", none), F.coalesce("vb", none)).alias("s"))

    def total(kinds: tuple[str, ...], points) -> Column:  # noqa: ANN001
        codes = [_KINDS.index(k) for k in kinds]
        kind = lambda v: F.shiftright(v, 14).bitwiseAND(F.lit(3).cast("long"))
        return F.aggregate(F.filter("s", lambda v: kind(v).isin(codes)), F.lit(0.0), lambda t, v: t + points(v.bitwiseAND(F.lit(16383).cast("long")) / 500.0))

    above = lambda r, least: F.greatest(F.lit(0.0), r - least)
    return shared.select(
        "a", "b",
        total(("title",), lambda r: F.lit(1.0)).alias("titles"),
        total(("phrase",), lambda r: F.least(F.lit(1.0), above(r, PHRASE_RARITY) / PHRASE_RANGE)).alias("phrases"),
        total(("word",), lambda r: above(r, 2.5)).alias("words"),
        total(("unit",), lambda r: F.lit(1.0)).alias("units"),
        total(("unit",), lambda r: F.when(r >= 2, 1.0).otherwise(0.0)).alias("fields"),
        (total(("title", "phrase"), lambda r: r) + total(("word", "unit"), lambda r: above(r, 1))).alias("weight"),
    )


def _evidence(e: DataFrame) -> Column:
    return 2.5 * F.least(F.col("titles"), F.lit(2.0)) + F.least(F.col("phrases"), F.lit(3.0)) + 0.8 * F.least(F.lit(1.0), F.col("words") / 6)


def link(persons: DataFrame, profiles: DataFrame) -> DataFrame:
    """(person_id, profile_id, confidence) of the accepted matches.

    persons: (id, name, titles, texts, affiliations); profiles the same. Rows that repeat an id add to its attributes
    and names. Null ids are left out; null or empty attributes give no evidence; an entity without a readable name is
    matched with nothing. Profiles may be matched with several persons only if neither is clearly better.
    """
    shape = ["id", "name", "titles", "texts", "affiliations"]
    both = persons.select(*[F.col(c).cast("string") if c == "id" else F.col(c) for c in shape]).withColumn("side", F.lit("a")).unionByName(profiles.select(*[F.col(c).cast("string") if c == "id" else F.col(c) for c in shape]).withColumn("side", F.lit("b"))).filter("id is not null")
    both = cut(both.distinct())
    merged = both.groupBy("side", "id").agg(*[F.array_distinct(F.flatten(F.collect_set(F.coalesce(c, F.array().cast("array<string>"))))).alias(c) for c in ("titles", "texts", "affiliations")])  # the rows of one id
    read = readings(both.select("name").filter(F.trim("name") != "").distinct())
    named = cut(both.select("side", "id", "name").filter("name is not null").distinct().join(read.select("name", "surname", "given", "letters"), "name").filter("surname <> ''").drop("name").distinct())
    found = cut(attributes(merged))
    poor = merged.join(found.filter("kind in ('title', 'phrase')").select("side", "id").distinct(), ["side", "id"], "left_anti").filter("side = 'a'").select("id", F.lit(True).alias("poor"))
    values = lambda k: found.filter(F.col("side") == k).select("id", "kind", "value", "rarity")
    # blocks: every surname with the initial; a shared title is a block of its own, for names that were mangled
    edges = _edges(cut(_candidates(named, found.filter("kind = 'title'").select("side", "id", "value"))), values("a"), values("b"))
    # meta-blocking: an edge stays if it is not light against the heaviest one at either end
    edges = cut(edges)
    heaviest = lambda c: edges.groupBy(c).agg(F.max("weight").alias(f"h_{c}"))
    pruned = edges.join(heaviest("a"), "a").join(heaviest("b"), "b").filter((F.col("weight") >= 0.1 * F.col("h_a")) | (F.col("weight") >= 0.1 * F.col("h_b"))).drop("h_a", "h_b")
    left = named.filter("side = 'a'").select(F.col("id").alias("a"), F.col("surname").alias("s_a"), F.col("given").alias("g_a"), F.col("letters").alias("l_a"))
    right = named.filter("side = 'b'").select(F.col("id").alias("b"), F.col("surname").alias("s_b"), F.col("given").alias("g_b"), F.col("letters").alias("l_b"))
    given = _given_score(F.col("g_a"), F.col("g_b"), F.col("l_a"), F.col("l_b"))
    apart = F.levenshtein("s_a", "s_b")
    surname = F.when(F.col("s_a") == F.col("s_b"), 0.0).when(F.arrays_overlap(F.split("s_a", " "), F.split("s_b", " ")), -0.3).when(apart <= 2, -0.1)
    homes = merged.select("side", "id", (F.size("affiliations") > 0).alias("has"))
    scored = (
        pruned.join(left, "a").join(right, "b").withColumn("name_points", given + surname).filter("name_points is not null")
        .groupBy("a", "b").agg(F.max("name_points").alias("name_points"), *[F.first(c).alias(c) for c in ("titles", "phrases", "words", "units", "fields")])
        .join(homes.filter("side = 'b'").select(F.col("id").alias("b"), "has"), "b")
        .join(poor.withColumnRenamed("id", "a"), "a", "left")
    )
    home = F.when(F.col("fields") > 0, 0.8).when(F.col("units") > 0, 0.4).when(F.col("has"), -0.6).otherwise(0.0)
    base = cut(scored.select("a", "b", (F.col("name_points") + _evidence(scored) + home + F.when(F.col("poor"), 0.6).otherwise(0.0)).alias("base")))
    # profiles of one block that share a title or phrases resemble each other; phrases of less rarity add nothing to it
    telling = values("b").filter(f"kind = 'title' or kind = 'phrase' and rarity > {PHRASE_RARITY}")
    known = telling.join(base.select(F.col("b").alias("id")).distinct(), "id", "left_semi").select("id", "kind", "value")
    by_name = named.filter("side = 'b'").select("id", F.explode(F.split("surname", " ")).alias("s"), F.substring("letters", 1, 1).alias("i")).distinct()
    c = cut(known.join(by_name.select("id", F.concat_ws("|", "s", "i").alias("block")), "id").unionByName(known.filter("kind = 'title'").withColumn("block", F.lit(""))))
    pairs = cut(meet(c.withColumnRenamed("id", "a"), c.withColumnRenamed("id", "b"), ["block", "kind", "value"], PIECE).filter("a <> b").select("a", "b").distinct())
    like = _edges(pairs, telling, telling)
    like = cut(like.select(F.col("a").alias("b"), F.col("b").alias("other"), F.least(F.lit(1.0), F.col("titles") + F.col("phrases") / 3).alias("alike")).filter("alike > 0"))
    scores, accepted = base.withColumn("score", F.col("base")), None
    for _ in range(ROUNDS):
        sure = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score") - (ACCEPT - 1)))
        support = scores.select("a", F.col("b").alias("other"), sure.alias("sure")).join(like, "other").groupBy("a", "b").agg(F.max(F.col("sure") * F.col("alike")).alias("support"))
        best = scores.groupBy("b").agg(F.max(F.struct("score", "a")).alias("top"))
        joined = scores.join(support, ["a", "b"], "left").join(best, "b")
        rival = F.when((F.col("top.a") != F.col("a")) & (F.col("top.score") >= ACCEPT), F.least(F.lit(1.5), F.col("top.score") - F.col("score"))).otherwise(0.0)
        scores = cut(joined.select("a", "b", "base", (F.col("base") + SUPPORT * F.coalesce("support", F.lit(0.0)) - RIVALRY * rival).alias("score")))
        state = scores.filter(F.col("score") >= ACCEPT).agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**40))).alias("h")).first()
        if state == accepted:
            break
        accepted = state
    else:
        raise RuntimeError(f"the matches still change after {ROUNDS} rounds")
    return scores.filter(F.col("score") >= ACCEPT).select(F.col("a").alias("person_id"), F.col("b").alias("profile_id"), F.round(1 / (1 + F.exp(-2 * (F.col("score") - ACCEPT + 0.5))), 6).alias("confidence"))


def people(faculty: DataFrame) -> DataFrame:
    return faculty.select(F.col("faculty_id").alias("id"), "name", F.col("known_publication_titles").alias("titles"), F.array("research_text").alias("texts"), "affiliations")


def profiles(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("author_id").alias("id"), "name", F.transform("known_papers", lambda p: p["title"]).alias("titles"), F.col("topics").alias("texts"), "affiliations")
