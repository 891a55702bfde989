"""Variant spellings of names typed by people.

Tokens of all names are joined with themselves by a prefix-filtered set-similarity join on their q-grams, which finds
misspelt tokens and the frequent token each stands for. Short forms of given names are learnt from the surnames they
share with the full name, by a join of the same kind. Names are then read into surname, given name and initials by the
positions in which their tokens usually stand, so that parts may come in any order.

Names that read alike form a shape. Shapes are joined by the rarest q-grams of their surnames, within the same given
name, or the same initial where one side spells out no given name. The pairs are verified by a soft weighted token
similarity, in which rare tokens count more, and filtered: initials are linked only where they fit one person, and
different middle initials keep persons apart. Spellings are put in for shapes only at the end.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.runtime import cut, frame, join_small, meet

#: Common short forms of given names, behind the full name they stand for. Others are learnt (`short_forms`).
NICKNAMES = """abigail abby abbie gail; alexander alex sasha; alexandra lexi; andrew andy drew; anthony tony; barbara barb; beatriz bea; beatrice bee
benjamin ben benny; catherine cathy cath cate; charles chuck charlie; christopher chris; daniel dan danny; david dave; deborah deb debbie debby; dmitri dima mitya
dorothy dot; edward ed eddie ned ted; elizabeth liz beth betsy betty lizzie eliza libby; frances fran frannie; francis frank; francisco paco; frederick fred freddie; gabriel gabe
gregory greg; harold hal harry; henry hank; ibrahim ibra; isabella bella izzy isa; james jim jimmy jamie; jennifer jen jenny jenn; jose pepe; joseph joe joey; john jack johnny
kenneth ken kenny; katherine kathy kate katie kat kit; lawrence larry laurie; leonard leo len; lukasz luk; margaret meg peggy maggie marge; matthew matt; michael mike mick mikey; monica moni
nathaniel nate nat; nicholas nick nicky; oliver ollie olly; patricia pat patty trish tricia; patrick paddy; peter pete; philip phil; priyanka priya; rebecca becky becca; richard rick dick rich richie
robert bob rob bobby; ronald ron; samuel sam sammy; stephen steve; susan sue susie suzie; theodora thea dora theo; theodore teddy; thomas tom tommy; tomas tomi
victoria vicky vicki tori; vikram vik vicks; vincent vince vinny; wilhelmina mina willa minnie billie; william bill will billy liam; yolanda yoli yola; zachary zach zack zak"""
_FORMAL = {short: group.split()[0] for line in NICKNAMES.split("\n") for group in line.split(";") if group.split() for short in group.split()[1:]}
#: Titles, degrees and suffixes; particles of surnames; letters that have no decomposition.
_TITLES = frozenset("dr prof professor mr mrs ms phd md jr sr ii iii iv msc bsc".split())
_PARTICLES = frozenset("de del della der den van von al el la le di da dos du bin ibn ten ter".split())
_LETTERS = str.maketrans({0xF8: "o", 0x142: "l", 0xE6: "ae", 0x153: "oe", 0xDF: "ss", 0x111: "d", 0xF0: "d", 0xFE: "th", 0x131: "i"})

_BROKEN = re.compile("[%s-%s][%s-%s%s]" % (chr(0xC2), chr(0xDF), chr(0x80), chr(0xBF), "".join(sorted({bytes([b]).decode("cp1252") for b in range(0x80, 0xC0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)} - {chr(b) for b in range(0x80, 0xC0)}))))


def repair(name: str) -> str:
    """UTF-8 that was read in a single-byte encoding, put right pair by pair."""

    def one(m: re.Match) -> str:
        pair = m.group(0)
        raw = b"".join(c.encode("latin-1") if ord(c) < 256 else c.encode("cp1252") for c in pair)
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return pair

    return _BROKEN.sub(one, name) if not name.isascii() else name


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold().translate(_LETTERS))
    return "".join(c for c in plain if not unicodedata.combining(c)).translate(_LETTERS)


_DEGREE = re.compile(r",?\s+(?:m\.\s?d\.?|ph\.\s?d\.?|d\.\s?phil\.?)\s*$|^(?:m\.d\.|ph\.d\.)\s+", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W\d_]+(?:['%s][^\W\d_]+)*" % chr(0x2019))


def tokens_of(name: str) -> list[tuple[str, str]]:
    """(token, place) of a name; place is i (an initial), s (before a comma), g (behind it), f (first), l (last) or m."""
    text = unicodedata.normalize("NFKC", repair(name))
    m = _DEGREE.search(text)
    if m:
        rest = (text[: m.start()] + " " + text[m.end() :]).strip()
        # "Surname, M. D." may as well be two initials; a degree is taken off where a name stands before it
        if len([t for t in _TOKEN.findall(rest) if fold(t) not in _PARTICLES]) >= 2:
            text = rest
    shouting = text.upper() == text
    parts = [p for p in text.split(",") if p.strip()]
    while len(parts) > 1 and all(fold(t) in _TITLES for t in _TOKEN.findall(parts[-1])):
        parts.pop()
    lone = len([t for t in _TOKEN.findall(text) if fold(t) not in _PARTICLES | _TITLES and t != t.upper()]) == 1 and not re.search(r"\b[^\W\d_]\b", text)
    out: list[tuple[str, str]] = []
    for k, part in enumerate(parts):
        # short parts tied by a hyphen are one given name (Hye-Jin); long ones are two surnames
        part = re.sub(r"\b([^\W\d_]{2,5})-([^\W\d_]{2,5})\b", r"\1\2", part)
        for raw in _TOKEN.findall(part):
            t = fold(raw).replace("'", "").replace(chr(0x2019), "")
            # two capitals beside a lone surname are initials, even where they read like a title
            initials = len(raw) == 2 and raw.isupper() and not shouting and lone
            if not t or ((t in _PARTICLES or t in _TITLES) and not initials):
                continue
            if len(t) == 1:
                out.append((t, "i"))
            elif len(raw) <= 3 and raw.isupper() and not shouting:
                out += [(c, "i") for c in t]
            else:
                out.append((t, "m" if len(parts) == 1 else "s" if k == 0 else "g"))
    if len(parts) == 1:
        long = [k for k, (_, p) in enumerate(out) if p != "i"]
        if len(long) > 1:
            out[long[0]] = (out[long[0]][0], "f")
            out[long[-1]] = (out[long[-1]][0], "l")
        elif long:  # a surname with initials
            out[long[0]] = (out[long[0]][0], "s" if len(out) > 1 else "m")
    return out


_TOKENS = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("place", T.StringType())]))


def tokenised(names: DataFrame) -> DataFrame:
    """(name, tokens) of distinct names."""

    @F.pandas_udf(_TOKENS)
    def split(column: pd.Series) -> pd.Series:
        return column.map(lambda n: [{"token": t, "place": p} for t, p in tokens_of(n)])

    return names.select("name", split(F.col("name")).alias("tokens"))


# --- misspelt tokens -------------------------------------------------------------------------------------------------

Q = 3
#: An edit or a swap of neighbours destroys at most so many padded q-grams, so prefixes are one longer.
_DESTROYED = Q + 1


def misspelt(tokens: DataFrame, known: tuple[str, ...] = ()) -> DataFrame:
    """(token, canon): tokens one edit or swap away from a far more frequent one, or long rare ones from each other; tokens has (token, n).

    Similar tokens share a q-gram among the rarest _DESTROYED + 1 of either (prefix filter), at positions that differ
    by at most one. Only tokens of at least 3 letters are compared; the most frequent partner wins, then the first.
    `known` tokens stand for themselves.
    """
    padded = F.concat(F.lit("#"), F.col("token"), F.lit("$"))
    at = F.sequence(F.lit(1), F.length(padded) - (Q - 1))
    grams = tokens.filter(F.length("token") >= 3).select("token", "n", F.explode(F.transform(at, lambda i: F.struct(i.alias("at"), padded.substr(i, F.lit(Q)).alias("gram")))).alias("g")).select("token", "n", "g.at", "g.gram")
    df = grams.groupBy("gram").agg(F.count("*").alias("df"))
    order = Window.partitionBy("token").orderBy("df", "gram", "at")
    prefix = cut(grams.join(df, "gram").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= _DESTROYED + 1).select("token", "n", "gram", "at"))
    left = prefix.select(F.col("token").alias("a"), F.col("n").alias("n_a"), "gram", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)).alias("at"))
    right = prefix.select(F.col("token").alias("b"), F.col("n").alias("n_b"), "gram", "at")
    rare = (F.length("a") >= 7) & (F.col("n_a") <= 2) & ((F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") > F.col("a"))))
    frequent = F.col("n_b") >= F.greatest(F.lit(3), 3 * F.col("n_a"))
    left = left.filter(~F.col("a").isin(*known)) if known else left
    pairs = left.join(right, ["gram", "at"]).filter((F.greatest(F.length("a"), F.length("b")) >= 4) & (F.abs(F.length("a") - F.length("b")) <= 1) & (rare | frequent)).select("a", "b", "n_b").distinct()
    distance = F.levenshtein("a", "b", 2)
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    swapped = (distance == 2) & (F.length("a") == F.length("b")) & (letters("a") == letters("b"))
    near = pairs.filter((distance == 1) | swapped)
    once = cut(near.groupBy("a").agg(F.max(F.struct("n_b", "b"))["b"].alias("canon")).withColumnRenamed("a", "token"))
    # a token may stand for one that is misspelt itself
    again = once.select(F.col("token").alias("canon"), F.col("canon").alias("next"))
    return once.join(again, "canon", "left").select("token", F.coalesce("next", "canon").alias("canon"))


# --- short forms -----------------------------------------------------------------------------------------------------

#: Share of the surnames of a given name that another must have for the first to be its short form, and how many at least.
CONTAINED, LEAST_SHARED = 0.6, 5


def short_forms(bearers: DataFrame) -> DataFrame:
    """(short, long): given names nearly all of whose surnames another, more frequent given name has as well.

    bearers: distinct (given, surname). People under a short form appear under the full name too, so the surnames of
    `bob` lie within those of `robert`, while two unrelated names share few. A given name's rarest surnames, as many as
    it may lack and one more, are its prefix; only names that share a surname of the prefix are compared. The name with
    the largest share counts, then the more frequent, then the first.
    """
    sizes = bearers.groupBy("given").agg(F.count("*").alias("n"))
    rare = bearers.groupBy("surname").agg(F.count("*").alias("df"))
    rows = cut(bearers.join(rare, "surname").join(sizes, "given").filter(F.col("n") >= LEAST_SHARED))
    place = F.row_number().over(Window.partitionBy("given").orderBy("df", "surname"))
    prefix = rows.withColumn("_r", place).filter(F.col("_r") <= F.col("n") - F.ceil(CONTAINED * F.col("n")) + 1).select(F.col("given").alias("short"), F.col("n").alias("n_s"), "surname")
    other = rows.select(F.col("given").alias("long"), F.col("n").alias("n_l"), "surname")
    pairs = prefix.join(other, "surname").filter((F.col("short") != F.col("long")) & (F.col("n_s") < F.col("n_l"))).select("short", "long", "n_s", "n_l").distinct()
    mine = pairs.join(rows.select(F.col("given").alias("short"), "surname"), "short")
    shared = mine.join(other.drop("n_l"), ["long", "surname"]).groupBy("short", "long", "n_s", "n_l").agg(F.count("*").alias("k"))
    found = shared.filter((F.col("k") >= LEAST_SHARED) & (F.col("k") >= CONTAINED * F.col("n_s")))
    return found.groupBy("short").agg(F.max_by("long", F.struct(F.col("k") / F.col("n_s"), "n_l", "long")).alias("long"))


# --- reading names ---------------------------------------------------------------------------------------------------


class Reading(dict):
    """surname: sorted tokens; given: canonical tokens; initials: letters that stand alone, in order."""


def full_form(token: dict) -> str:
    """The given name that a token stands for, by the list of short forms or else as learnt."""
    return _FORMAL.get(token["canon"]) or token.get("long") or token["canon"]


def read_name(tokens: list[dict]) -> Reading:
    """Roles by place, corrected where a token nearly always stands elsewhere; tokens carry canon and share (of first places)."""
    long = [t for t in tokens if t["place"] != "i"]
    initials = [t["token"] for t in tokens if t["place"] == "i"]
    given, surname = [], []
    for t in long:
        share = t.get("share")
        usual = None if share is None else "g" if share >= 0.7 else "s" if share <= 0.3 else None
        placed = {"s": "s", "g": "g", "f": "g", "l": "s"}.get(t["place"])
        role = placed if t["place"] in ("s", "g") and len(long) > 1 else usual or placed or "s"
        (given if role == "g" else surname).append(t)
    if not surname and len(given) > 1:
        surname.append(given.pop())
    elif not given and len(surname) > 1 and not initials:
        given.append(surname.pop(0))
    return Reading(
        surname=sorted({t["canon"] for t in surname}),
        given=[full_form(t) for t in given],
        initials=initials,
    )


def readings(names: DataFrame) -> DataFrame:
    """(name, surname, given, letters, weights) of distinct names; surname is '' where none could be read.

    surname and given are canonical tokens joined by blanks; letters are the initials of the given and middle names in
    order; weights maps the tokens of the name to the logarithm of names per token, so rare tokens weigh more.
    """
    parsed = cut(tokenised(names))
    exploded = parsed.select("name", F.posexplode("tokens").alias("pos", "t")).select("name", "pos", "t.token", "t.place")
    stats = exploded.filter("place <> 'i'").groupBy("token").agg(F.count("*").alias("n"), F.count_if(F.col("place").isin("f", "g")).alias("firsts"), F.count_if(F.col("place").isin("l", "s")).alias("lasts"))
    stats = cut(stats)
    fixes = cut(misspelt(stats.select("token", "n"), tuple(sorted({*_FORMAL, *_FORMAL.values()}))))
    mapped = stats.join(fixes, "token", "left").withColumn("canon", F.coalesce("canon", "token"))
    canon = mapped.groupBy("canon").agg(F.sum("n").alias("canon_n"), (F.sum("firsts") / F.greatest(F.sum("firsts") + F.sum("lasts"), F.lit(1))).alias("share"), F.sum(F.col("firsts") + F.col("lasts")).alias("seen"))
    info = cut(mapped.select("token", "canon").join(canon, "canon").select("token", "canon", "canon_n", F.when(F.col("seen") >= 4, F.col("share")).alias("share")))
    total = parsed.count()
    full = cut(join_small(exploded, info, ["token"], "left", salts=1).withColumn("canon", F.coalesce("canon", "token")))
    # names of one given name and one surname tell short forms
    first, last = F.col("place").isin("f", "g"), F.col("place").isin("l", "s")
    plain = full.filter("place <> 'i'").groupBy("name").agg(F.count_if(first).alias("x"), F.count_if(last).alias("y"), F.max(F.when(first, F.col("canon"))).alias("given"), F.max(F.when(last, F.col("canon"))).alias("surname")).filter("x = 1 and y = 1")
    short = cut(short_forms(plain.select("given", "surname").distinct()).select(F.col("short").alias("canon"), "long"))
    full = join_small(full, short, ["canon"], "left", salts=1)
    packed = full.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "place", "canon", "long", "share", F.log(F.lit(float(max(total, 2))) / F.coalesce("canon_n", F.lit(1))).alias("weight")))).alias("t"))  # the tokens of one name

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, tokens in zip(batch["name"], batch["t"], strict=True):
                tokens = [dict(t) if isinstance(t, dict) else t.asDict() for t in tokens]
                r = read_name(tokens)
                letters = "".join(g[0] for g in r["given"]) + "".join(r["initials"])
                weights = {}
                for t in tokens:
                    if t["place"] != "i":
                        weights[full_form(t)] = max(t["weight"], 0.1)
                rows.append((name, " ".join(r["surname"]), " ".join(r["given"]), letters, weights))
            yield frame(rows, ["name", "surname", "given", "letters", "weights"])

    return packed.mapInPandas(run, "name string, surname string, given string, letters string, weights map<string,double>")


# --- shapes ----------------------------------------------------------------------------------------------------------

#: Share of the q-grams of two surnames that must be the same for their shapes to be compared.
ALIKE = 0.8


def shapes_of(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shapes, members): distinct readings (shape, surname, given, letters, weights, middle, size), and the names of
    each (shape, name). Names without a surname have no shape."""
    named = read.filter("surname <> ''").withColumn("shape", F.xxhash64("surname", "given", "letters"))
    own = F.when(F.col("given") != "", F.aggregate(F.split("given", " "), F.lit(""), lambda acc, g: F.concat(acc, F.substring(g, 1, 1)))).otherwise("")
    shapes = named.groupBy("shape", "surname", "given", "letters").agg(F.min_by("weights", "name").alias("weights"), F.count("*").alias("size"))
    return shapes.withColumn("own", own).withColumn("middle", F.expr("substring(letters, length(own) + 1)")), named.select("shape", "name")


def alike(shapes: DataFrame) -> DataFrame:
    """(a, b) of shapes whose surnames are alike, by a prefix-filtered join on q-grams.

    Two shapes meet if they share one of the rarest q-grams of their surnames, so many that the similarity ALIKE can't
    be missed, and agree in the given name; a shape with initials only meets all that have its first initial. Shared
    q-grams of a frequent surname are dealt in pieces of both sides. Each pair is given once, initials-only shapes on
    the left; a shape isn't paired with itself.
    """
    padded = F.concat(F.lit("#"), F.replace("surname", F.lit(" "), F.lit("$#")), F.lit("$"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - (Q - 1)), lambda i: padded.substr(i, F.lit(Q))))
    rows = cut(shapes.select("shape", "given", "letters", grams.alias("grams")).withColumn("n", F.size("grams")))
    flat = rows.select("shape", "given", "letters", "n", F.explode("grams").alias("gram"))
    df = flat.groupBy("gram").agg(F.count("*").alias("df"))
    order = Window.partitionBy("shape").orderBy("df", "gram")
    keep = F.col("n") - F.ceil(ALIKE * F.col("n")) + 1
    prefix = cut(join_small(flat, df, ["gram"]).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= keep).select("shape", "given", F.substring("letters", 1, 1).alias("letter"), "gram"))
    side = lambda d, k: d.withColumnRenamed("shape", k)
    full, bare = prefix.filter("given <> ''"), prefix.filter("given = '' and letter <> ''").select("shape", "letter", "gram")
    spelt = meet(side(full.select("shape", "given", "gram"), "a"), side(full.select("shape", "given", "gram"), "b"), ["gram", "given"]).filter("a < b")
    initial = meet(side(bare, "a"), side(full.select("shape", "letter", "gram"), "b"), ["gram", "letter"])
    pairs = spelt.select("a", "b").unionByName(initial.select("a", "b")).distinct()
    sets = rows.select("shape", "grams")
    both = pairs.join(side(sets, "a").withColumnRenamed("grams", "ga"), "a").join(side(sets, "b").withColumnRenamed("grams", "gb"), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    return both.filter(common >= ALIKE * (F.size("ga") + F.size("gb") - common)).select("a", "b")


def persons(shapes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(shape, person): the person each shape stands for, as far as the names alone tell; pairs are `alike` shapes.

    A person is a surname, a given name and, where bearers of both have different middle initials, that initial.
    Spellings without middle initial then fit several persons and stand for none of them, but for each other.
    Spellings with initials only are given to the one person they fit; if they fit none, they go together by initials.
    """
    full = shapes.filter("given <> ''")
    middles = full.groupBy("surname", "given").agg(F.count_distinct(F.when(F.col("middle") != "", F.substring("middle", 1, 1))).alias("kinds"), F.max(F.substring("middle", 1, 1)).alias("known"))
    settled = cut(full.join(middles, ["surname", "given"]).withColumn("m", F.when(F.col("kinds") <= 1, F.col("known")).otherwise(F.substring("middle", 1, 1))).withColumn("person", F.concat_ws("|", "surname", "given", "m")))
    identities = settled.filter("kinds <= 1 or middle <> ''").select(F.col("shape").alias("b"), F.col("surname").alias("s_b"), "own", "m", "person")
    bare = shapes.filter("given = '' and letters <> ''").select("shape", "surname", "letters")
    joined = bare.join(pairs, bare["shape"] == pairs["a"]).join(identities, "b").filter(F.col("surname") == F.col("s_b"))
    several = (F.length("own") > 1) & F.col("letters").startswith(F.col("own"))
    rest = F.when(several, F.expr("substring(letters, length(own) + 1)")).otherwise(F.expr("substring(letters, 2)"))
    fit = (rest == "") | (F.col("m") == "") | (rest == F.col("m")) | (rest == F.expr("substring(own, 2)"))
    options = joined.filter(fit).groupBy("shape").agg(F.count_distinct("person").alias("n"), F.min("person").alias("fitting"))
    lone = F.concat_ws("|", "surname", F.lit(""), "letters")
    of_bare = bare.join(options, "shape", "left").withColumn("person", F.when(F.col("n") == 1, F.col("fitting")).when(F.col("n").isNull(), lone))
    return settled.select("shape", "person").unionByName(of_bare.filter("person is not null").select("shape", "person"))


def soft_similarity(a: dict[str, float], b: dict[str, float], letters_a: str, letters_b: str) -> float:
    """Weighted share of tokens that two names have in common.

    A token that only one name spells out counts half when the other has its initial, and against them otherwise.
    """
    both = sum(max(a[t], b[t]) for t in a.keys() & b.keys())
    only = [(t, w, letters_b) for t, w in a.items() if t not in b] + [(t, w, letters_a) for t, w in b.items() if t not in a]
    half = sum(w / 2 for t, w, letters in only if t[0] in letters)
    total = both + sum(w for t, w, letters in only if t[0] not in letters) + half
    return (both + half / 2) / total if total else 0.0


def linked_shapes(names: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, members, owners): verified pairs of shapes (a, b, similarity), the names of every shape, and the person of
    every shape that has one. Initials-only shapes of one person are linked to each other through it."""
    read = cut(readings(names.select("name").filter(F.trim("name") != "").distinct()))
    shapes, members = shapes_of(read)
    shapes = cut(shapes)
    candidates = cut(alike(shapes))
    owners = cut(persons(shapes, candidates))
    # initials of one person meet through the full name that both are alike to
    bare = shapes.filter("given = ''").select("shape")
    of_bare = owners.join(bare, "shape", "left_semi").filter("person not like '%||%'")
    both = of_bare.withColumnRenamed("shape", "a").join(of_bare.withColumnRenamed("shape", "b"), "person").filter("a < b").select("a", "b")
    facts = shapes.select("shape", "weights", "letters").join(owners, "shape")
    side = lambda k: facts.select(F.col("shape").alias(k), F.col("weights").alias(f"w_{k}"), F.col("letters").alias(f"l_{k}"), F.col("person").alias(f"p_{k}"))
    same = candidates.unionByName(both).join(side("a"), "a").join(side("b"), "b").filter("p_a = p_b")

    @F.pandas_udf(T.DoubleType())
    def similarity(w_a: pd.Series, w_b: pd.Series, l_a: pd.Series, l_b: pd.Series) -> pd.Series:
        return pd.Series([soft_similarity(dict(x), dict(y), p, q) for x, y, p, q in zip(w_a, w_b, l_a, l_b, strict=True)], dtype=float)

    scored = same.select("a", "b", similarity("w_a", "w_b", "l_a", "l_b").alias("similarity"))
    return cut(scored.filter(F.col("similarity") >= threshold).distinct()), members, owners


def variant_pairs(names: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(name_a, name_b, similarity), name_a < name_b: spellings of one person; names has the column name.

    Null and blank names, and names without a surname, are linked to nothing. Repeated names count once.
    """
    pairs, members, owners = linked_shapes(names, threshold)
    named = members.join(owners.select("shape"), "shape", "left_semi")
    alone = named.select(F.col("shape").alias("a"), F.col("shape").alias("b")).distinct().withColumn("similarity", F.lit(1.0))
    left, right = named.select(F.col("shape").alias("a"), F.col("name").alias("x")), named.select(F.col("shape").alias("b"), F.col("name").alias("y"))
    spelt = pairs.unionByName(alone).join(left, "a").join(right, "b").filter("x <> y and (a <> b or x < y)")
    return spelt.select(F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"), "similarity")


def variant_classes(names: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(name, person, n_links) for every name with a surname that stands for a person: how many other names are linked to
    it. The names themselves are never paired, so a person of many spellings costs no more than their number."""
    pairs, members, owners = linked_shapes(names, threshold)
    sizes = members.groupBy("shape").agg(F.count("*").alias("size"))
    ways = pairs.select(F.col("a").alias("shape"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("shape"), F.col("a").alias("other")))
    links = ways.join(sizes.select(F.col("shape").alias("other"), "size"), "other").groupBy("shape").agg(F.sum("size").alias("more"))
    return members.join(owners, "shape").join(sizes, "shape").join(links, "shape", "left").select("name", "person", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))


def all_names(faculty: DataFrame, candidates: DataFrame, papers: DataFrame) -> DataFrame:
    """Every name of the three columns, once per table's distinct spelling."""
    authors = papers.select(F.explode("authors").alias("a")).select(F.col("a.name").alias("name"))
    return faculty.select("name").unionByName(candidates.select("name")).unionByName(authors).distinct()
