"""Text cut off by field limits: a hashed logistic regression trained on artificial cuts.

Values taken as intact (a bounded sample) are cut to make positives: at random places, within the first words of a
paragraph, and at the length limits of their source; the same values, whole or cut behind a complete sentence or list
entry, are the negatives. The features are the closing characters and words, the punctuation and form of the last line,
the distance of the length to the next limit of the record's source, and statistics over all records: how often the last
word occurs, and how often it ends a sentence. The model then scores every record. With no intact value to learn from
nothing is found.

The texts are read twice: once for the endings of all records and the counts of all words, which are written in short
columns, and once for the sample.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.canonical import SPACES, squeeze
from skein.runtime import cut, frame, join_small, spread

#: Bound of the sample of labelled records that the model is fitted on.
TRAINING_RECORDS = 20_000
TAIL = 400
#: Share of the distinct texts with an omission mark from which a common ending is a way of writing, and the texts it needs at least.
USUAL_SHARE, USUAL_TEXTS = 0.05, 5
#: A length is a limit of a source where at least so many distinct texts have it, and so many deviations more than the lengths around it.
LIMIT_TEXTS, LIMIT_DEVIATIONS, AROUND = 4, 5.0, 10
#: Lengths up to so far below a limit are near it; limits are not looked for in texts shorter than LEAST_LENGTH.
NEAR, LEAST_LENGTH = 15, 40
BITS = 15

#: Signs of omission as they are put after a cut.
_MARK = re.compile(r"(?:[ ]?[\[(](?:\.{3}|%s|more|read more|continued)[\])]|%s|\.{3,}|%s)+$" % (chr(0x2026), chr(0x2026), chr(0xFFFD)))
_MARKS = ["", "", "", "", "", "...", chr(0x2026), " [more]", " [...]"]
_CLOSERS = "\"')]}" + "".join(map(chr, (0x201D, 0x2019, 0xBB, 0x201C)))
_ENDERS = ".!?" + "".join(map(chr, (0x3002, 0xFF01, 0xFF1F)))

_LAST_WORD = re.compile(r"[^\W_]+$")
_INNER_WORD = re.compile(r"([^\W_]+)[\W_]*$")


def ending(text: str) -> tuple[str, str, str, str]:
    """(core, omission mark, last word, closing words) of a text; the core is its tail without the mark."""
    tail = text.rstrip(SPACES)[-TAIL:]
    m = _MARK.search(tail, max(0, len(tail) - 40))
    mark = m.group(0) if m else ""
    core = tail[: len(tail) - len(mark)].rstrip(SPACES)
    word = _LAST_WORD.search(core[-60:].rpartition(" ")[2])
    return core, mark, word.group(0).lower() if word else "", " ".join(tail[-200:].split()[-3:])


def _word_counts(texts: list[str]) -> list[tuple[str, int, int]]:
    """(word, times, times before a full stop) over some texts, other than at their ends."""
    tokens: Counter[str] = Counter()
    for text in texts:
        tokens.update(text.split()[:-1])
    counts: dict[str, list[int]] = {}
    for token, n in tokens.items():
        m = _INNER_WORD.search(token)
        if m:
            c = counts.setdefault(m.group(1).lower(), [0, 0])
            c[0] += n
            if token.rstrip(_CLOSERS)[-1:] in _ENDERS:
                c[1] += n
    return [(w, a, b) for w, (a, b) in counts.items()]


_SHORT = ["doc_id", "source", "length", "text_hash", "shape", "mark", "word", "phrase"]


def _survey(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(endings, words) of all records, from one reading: endings are (doc_id, source, length, text_hash, shape, mark,
    word, phrase), shape null for blank texts; words are (word, word_n, word_ends)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, texts = [], []
            for doc, source, text in batch[["doc_id", "source", "text"]].itertuples(index=False):
                if text is None:
                    rows.append((doc, source, None, None, None, None, None, None, None, None))
                    continue
                texts.append(text)
                core, mark, word, phrase = ending(text)
                blank = not core and not mark
                digest = xxhash.xxh64_intdigest(" ".join(text.lower().split())) >> 1
                rows.append((doc, source, len(text), digest, None if blank else shape(core, mark), mark, word, phrase, None, None))
            rows += [(None, None, None, None, None, None, w, None, n, e) for w, n, e in _word_counts(texts)]
            yield frame(rows, [*_SHORT, "word_n", "word_ends"])

    kind = dict(documents.dtypes)["doc_id"]
    both = cut(spread(documents).mapInPandas(run, f"doc_id {kind}, source string, length int, text_hash long, shape string, mark string, word string, phrase string, word_n long, word_ends long"))
    words = both.filter("word_n is not null").groupBy("word").agg(F.sum("word_n").alias("word_n"), F.sum("word_ends").alias("word_ends"))
    return both.filter("word_n is null").select(*_SHORT), words


def _limits(ends: DataFrame) -> DataFrame:
    """(source, limit): lengths that far more distinct texts of a source have than the lengths around them lead to
    expect, whatever their share of the source."""
    counts = ends.filter(F.col("length") >= LEAST_LENGTH).select("source", "length", "text_hash").distinct().groupBy("source", "length").agg(F.count("*").alias("n"))
    around = Window.partitionBy("source").orderBy("length").rangeBetween(-AROUND, AROUND)  # distinct lengths, not records
    expected = (F.sum("n").over(around) - F.col("n")) / (2 * AROUND)
    return counts.withColumn("e", expected).filter((F.col("n") >= LIMIT_TEXTS) & (F.col("n") >= F.col("e") + LIMIT_DEVIATIONS * F.sqrt("e") + 1)).select("source", F.col("length").alias("limit"))


def _distances(limits: DataFrame) -> DataFrame:
    """(source, length, distance): how far the lengths up to NEAR below a limit are from the next one."""
    near = limits.select("source", "limit", F.explode(F.sequence(F.lit(0), F.lit(NEAR))).alias("distance"))
    return near.groupBy("source", (F.col("limit") - F.col("distance")).alias("length")).agg(F.min("distance").alias("distance"))


def _usual(ends: DataFrame) -> DataFrame:
    """(phrase, usual): closing words with an omission mark that many distinct texts share, as writers put them.

    Copies count once, and the limit is a share of all texts with a mark, so that cuts that happen to end alike don't
    become usual as a table grows. There can be no more of them than 1 / USUAL_SHARE.
    """
    counts = cut(ends.filter("mark <> '' and phrase <> ''").select("phrase", "text_hash").distinct().groupBy("phrase").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") >= max(USUAL_TEXTS, USUAL_SHARE * total)).select("phrase", F.lit(True).alias("usual"))


def _closed(core: str) -> bool:
    """Whether a text without omission mark ends like a complete sentence."""
    return core.rstrip(_CLOSERS)[-1:] in _ENDERS if core else False


_LIST = re.compile(r"^\s*(?:[-*+%s]|\d+[.)])\s+" % chr(0x2022))
_LINK = re.compile(r"(?:https?://|www\.|[\w.+-]+@)[\w.-]+\S*$")
_REFERENCE = re.compile(r"[\])]$")


def _last_line(core: str) -> tuple[str, bool]:
    """The last line, and whether a blank line comes before it."""
    head, _, line = core.rpartition("\n")
    return line.strip(), head.endswith("\n") or not head


def _kind_of_line(core: str) -> str:
    line, apart = _last_line(core)
    words = line.split()
    if _LIST.match(line):
        return "list"
    if re.match(r"^[A-Z]\w+(?: \w+)?: ", line):
        return "label"
    if apart and 2 <= len(words) <= 5 and all(w[:1].isupper() for w in words) and "\n" in core:
        return "sign"
    return "prose"


def _structured(core: str) -> bool:
    """Whether a text that doesn't end in a full stop still looks intact: used to label training values only."""
    return bool(_LINK.search(core)) or bool(_REFERENCE.search(core)) or _kind_of_line(core) in ("list", "label", "sign")


def _bin(n: float) -> str:
    return "0" if not n else "few" if n < 3 else "some" if n < 10 else "many"


def _away(distance: float | None) -> str:
    """How far a length is from the next limit of its source."""
    return "far" if distance is None or distance != distance else "at" if distance == 0 else "close" if distance <= 3 else "near"


def shape(core: str, mark: str) -> str:
    """What the features need of an ending, in a short string."""
    line, apart = _last_line(core)
    words = line.split()
    last = core[-1:]
    stripped = core.rstrip(_CLOSERS)[-1:]
    closing = "ender" if stripped in _ENDERS and stripped else "lower" if last.islower() else "upper" if last.isupper() else "digit" if last.isdigit() else "closer" if last in _CLOSERS and last else last
    marked = "none" if not mark else "word" if "more" in mark or "cont" in mark else "bad" if chr(0xFFFD) in mark else "dots"
    link = "link" if _LINK.search(core) else "ref" if _REFERENCE.search(core) and closing != "ender" else "plain"
    size = min(len(words), 9)
    return "\x1f".join((closing, marked, _kind_of_line(core), link, str(apart), str(size), core[-2:] if not core[-2:].isalpha() else "ab", f"{words[0][:12] if words else ''},{size <= 5}"))


def features(shape_: str, distance: float | None, word: str, word_n: float, word_ends: float, usual: bool) -> list[int]:
    """Indices of the hashed features of one ending."""
    closing, marked, kind, link, apart, size, two, first = shape_.split("\x1f")
    often, ends, known, away = "many" if usual else "few", _bin(word_ends), _bin(word_n), _away(distance)
    names = [
        f"closing={closing}", f"mark={marked}", f"kind={kind}", f"link={link}", f"away={away}", f"apart={apart}",
        f"mark,often={marked},{often}", f"mark,closing={marked},{closing}", f"closing,kind={closing},{kind}", f"closing,link={closing},{link}",
        f"kind,known={kind},{known}", f"kind,ends={kind},{ends}", f"known={known}", f"kind,size={kind},{size}", f"kind,away={kind},{away}",
        f"closing,away={closing},{away}", f"closing,apart,size={closing},{apart},{size}", f"word={word[:20]}", f"two={two}",
        f"closing,kind,link,mark={closing},{kind},{link},{marked}", f"kind,link,known={kind},{link},{known}", f"head={first}",
    ]
    return [xxhash.xxh32_intdigest(n) & ((1 << BITS) - 1) for n in names]


_SENTENCE = re.compile(r"[.!?](?=\s)")
_LINE_BREAK = re.compile(r"(?<=\S)\n")
_PARAGRAPH = re.compile(r"\n\s*\n")


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Labelled endings from intact texts: whole, cut behind a sentence or line, cut somewhere within, within the first
    words of a paragraph, and at a limit of the source."""
    for batch in batches:
        rows = []
        for doc, source, text, limits, usual in batch[["doc_id", "source", "text", "limits", "usual"]].itertuples(index=False):
            core, mark, _, _ = ending(text)
            limits = list(limits) if limits is not None else []
            if not (usual is True if mark else _closed(core) or (len(text) not in limits and _structured(core))):
                continue
            rnd = random.Random(xxhash.xxh64_intdigest(str(doc)))
            made = [(text, 0)]
            if len(text) >= 60:
                breaks = [m.end() for m in _SENTENCE.finditer(text)] + [m.start() for m in _LINE_BREAK.finditer(text)]
                natural = [b for b in breaks if b > 20 and (_closed(text[max(0, b - TAIL) : b].rstrip()) or text[b : b + 1] == "\n" and _kind_of_line(text[max(0, b - TAIL) : b]) == "list")]
                if natural:
                    made.append((text[: rnd.choice(natural)], 0))
                heads = [m.end() for m in _PARAGRAPH.finditer(text) if m.end() > 20]
                within = [n for n in limits if n < len(text) - 3]
                places = [rnd.randrange(30, len(text) - 3), rnd.randrange(30, len(text) - 3), rnd.choice(heads) + rnd.randrange(2, 14) if heads else None, rnd.choice(within) if within else None]
                for k, place in enumerate(places):
                    piece = text[:place] if place else ""
                    left = piece.rstrip()
                    if not left or _closed(left) or _LINK.search(left) or text[len(left) :].lstrip(" ")[:1] in ("", "\n") or left in text[-3:]:
                        continue
                    sign = rnd.choice(_MARKS)
                    # a limit holds for the value with its mark, so the mark takes the place of text
                    made.append((left[: place - len(sign)].rstrip() + sign if k == 3 and sign else (left if rnd.random() < 0.5 else piece) + sign, 1))
            for value, label in made:
                core, mark, word, phrase = ending(value)
                if core or mark:
                    rows.append((source, len(value), shape(core, mark), word, phrase, label))
        yield frame(rows, ["source", "length", "shape", "word", "phrase", "label"])


def _arguments(batch: pd.DataFrame) -> Iterator[tuple]:
    filled = batch.fillna({"word_n": 0, "word_ends": 0, "word": ""})
    return zip(filled["shape"], filled["distance"], filled["word"], filled["word_n"], filled["word_ends"], filled["usual"].map(lambda v: v is True or v == 1), strict=True)


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"label": batch["label"], "x": [features(*r) for r in _arguments(batch)]})


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 1.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on rows of feature indices, by Adagrad on the full gradient; classes weigh the same."""
    w, b = np.zeros(1 << BITS), 0.0
    seen, seen_b = np.full(1 << BITS, 1e-8), 1e-8
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1) + b, -30, 30)))
        g = (p - y) * weight
        grad = np.bincount(x.ravel(), np.repeat(g, x.shape[1]), 1 << BITS) + decay * w / len(w)
        seen += grad * grad
        seen_b += g.sum() ** 2
        w -= rate * grad / np.sqrt(seen) * 0.3
        b -= rate * g.sum() / np.sqrt(seen_b) * 0.3
    return w, b


def score_truncation(documents: DataFrame, training_records: int = TRAINING_RECORDS) -> DataFrame:
    """(doc_id, source, score, truncated) for every record; source is trimmed and in lower case, null as ''.

    Records with null or blank text score 0. A doc_id that occurs twice is scored twice. Columns of the input other
    than doc_id, text and source play no role.
    """
    docs = documents.select("doc_id", F.lower(squeeze(F.col("source"))).alias("source"), "text")
    ends, counts = _survey(docs)
    with_text = ends.filter("shape is not null")
    phrases, limits = _usual(with_text), cut(_limits(with_text))
    near = cut(_distances(limits))
    share = min(1.0, training_records / max(ends.count(), 1))
    picked = docs.filter(F.length("text") > 0)
    if share < 1:
        picked = picked.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    # limits of a source are few: each needs LIMIT_TEXTS texts of one length
    marked = with_text.filter("mark <> ''").join(F.broadcast(phrases), "phrase").select("doc_id", "usual").distinct()
    sample = join_small(join_small(picked, limits.groupBy("source").agg(F.sort_array(F.collect_set("limit")).alias("limits")), ["source"], "left"), marked, ["doc_id"], "left", salts=1)
    lessons = cut(sample.select("doc_id", "source", "text", "limits", "usual").mapInPandas(_examples, "source string, length int, shape string, word string, phrase string, label int"))
    asked = with_text.select("word").unionByName(lessons.select("word")).distinct()
    vocabulary = cut(counts.join(asked, "word", "left_semi"))

    def known(rows: DataFrame) -> DataFrame:
        joined = join_small(join_small(rows, vocabulary, ["word"], "left", salts=8), near, ["source", "length"], "left")
        return joined.join(F.broadcast(phrases), "phrase", "left")  # at most 1 / USUAL_SHARE phrases

    rows = known(lessons).mapInPandas(_vectors, "label int, x array<int>").toPandas()  # at most six short rows per sampled record
    if len(rows) == 0 or rows["label"].nunique() < 2:
        return docs.select("doc_id", "source", F.lit(0.0).alias("score"), F.lit(False).alias("truncated"))
    model = documents.sparkSession.sparkContext.broadcast(fit(np.array(rows["x"].tolist()), rows["label"].to_numpy(float)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = model.value
        for batch in batches:
            x = np.array([features(*r) for r in _arguments(batch)], dtype=int).reshape(len(batch), -1)
            p = 1 / (1 + np.exp(-np.clip(w[x].sum(1) + b, -30, 30))) if len(batch) else np.empty(0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "score": p})

    scored = known(with_text).select("doc_id", "source", "shape", "distance", "word", "word_n", "word_ends", "usual").mapInPandas(score, f"doc_id {dict(docs.dtypes)['doc_id']}, source string, score double")
    blank = ends.filter("shape is null").select("doc_id", "source", F.lit(0.0).alias("score"))
    return scored.unionByName(blank).withColumn("truncated", _over(F.col("score")))


def _over(score: Column) -> Column:
    return score >= 0.5


def truncation_rates(scored: DataFrame) -> DataFrame:
    """(source, n_records, n_truncated, share) per source."""
    return scored.groupBy("source").agg(F.count("*").alias("n_records"), F.count_if("truncated").alias("n_truncated")).withColumn("share", F.round(F.col("n_truncated") / F.col("n_records"), 6))
