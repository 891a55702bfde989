"""Landed responses of web sources, parsed into records: HTML listings and profiles, JSON feeds, author and paper
searches. Landing itself is done by skein.sources.transport; everything here works on columns of text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.canonical import squeeze
from skein.operators import matching
from skein.runtime import frame, spread

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset(("script", "style", "template"))


class Element:
    """A node of a page: tag, attributes, children (elements and strings)."""

    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []

    @property
    def classes(self) -> set[str]:
        return set(self.attributes.get("class", "").split())

    def walk(self) -> Iterator[Element]:
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Element)]

    def first(self, *classes: str, tag: str | None = None) -> Element | None:
        """The first descendant in document order with one of the classes or the tag."""
        return next((e for e in self.walk() if (tag and e.tag == tag) or e.classes & set(classes)), None)

    def text(self) -> str:
        out: list[str] = []
        stack: list[Element | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in _SILENT:
                stack += reversed(node.children)
        return " ".join(" ".join(out).split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#page", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node: Element | None = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:  # an end tag without a start tag closes nothing
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


@dataclass(frozen=True)
class Layout:
    """Classes and attributes by which a site marks the parts of its listing and profile pages."""

    cards: tuple[str, ...] = ("person-card", "entity", "faculty-card")
    name: tuple[str, ...] = ("name-link", "entity-name")
    title: tuple[str, ...] = ("person-title", "entity-title")
    department: tuple[str, ...] = ("person-department", "entity-department")
    key: str = "data-person-id"
    role: str = "data-role"
    next_page: tuple[str, ...] = ("pagination-next",)
    last_page: tuple[str, ...] = ("pagination-end",)
    summary: tuple[str, ...] = ("research-summary",)
    biography: tuple[str, ...] = ("biography",)
    area: tuple[str, ...] = ("research-area",)
    affiliation: tuple[str, ...] = ("affiliation",)
    lab: tuple[str, ...] = ("lab-link",)
    publication: tuple[str, ...] = ("publication-title",)


def _value(node: Element | None) -> str | None:
    return (node.text() or None) if node is not None else None


def read_listing(html: str | None, url: str, layout: Layout = Layout()) -> tuple[list[dict], str | None, list[str]]:  # noqa: B008
    """(records, address of the next page, errors). Without an explicit next or last marker the page is an error: a
    listing is complete only when its end was seen. A card without name is an error and gives no record."""
    root = parse(html)
    errors, records = [], []
    for card in (e for e in root.walk() if layout.key in e.attributes or e.classes & set(layout.cards)):
        head = card.first(*layout.name) or card.first(tag="h2")
        name = _value(head)
        if not name:
            errors.append(f"{url}: a card without a name")
            continue
        link = head if head.tag == "a" else head.first(tag="a")
        href = link.attributes.get("href") if link is not None else None
        records.append({"source_key": card.attributes.get(layout.key) or None, "name": name, "profile_url": urljoin(url, href) if href else None, "title": _value(card.first(*layout.title)), "department": _value(card.first(*layout.department)), "role": card.attributes.get(layout.role) or None})
    if not records and not errors:
        errors.append(f"{url}: no cards")
    more = root.first(*layout.next_page)
    ended = root.first(*layout.last_page) is not None or (more is not None and more.attributes.get("aria-disabled") == "true")
    following = None
    if more is not None and not ended:
        target = more.attributes.get("href") or next((e.attributes["href"] for e in more.walk() if e.attributes.get("href")), None)
        following = urljoin(url, target) if target else None
    if following is None and not ended:
        errors.append(f"{url}: neither a next page nor an end")
    return records, following, errors


def read_profile(html: str | None, url: str, layout: Layout = Layout()) -> dict:  # noqa: B008
    root = parse(html)
    lab = root.first(*layout.lab)
    lab_link = lab if lab is None or lab.tag == "a" else lab.first(tag="a")
    affiliations = [{"school": e.attributes.get("data-school") or e.text(), "department": e.attributes.get("data-department") or None} for e in root.walk() if e.classes & set(layout.affiliation)]
    return {
        "name": _value(root.first(tag="h1")), "title": _value(root.first(*layout.title)), "affiliations": affiliations,
        "research_areas": list(dict.fromkeys(t for e in root.walk() if e.classes & set(layout.area) and (t := e.text()))),
        "research_summary": _value(root.first(*layout.summary)), "biography": _value(root.first(*layout.biography)),
        "lab_text": lab.text() or None if lab is not None else None,
        "known_titles": list(dict.fromkeys(t for e in root.walk() if e.classes & set(layout.publication) and (t := e.text()))),
        "identifiers": {e.attributes["data-identifier"]: e.attributes.get("href") or e.text() for e in root.walk() if e.attributes.get("data-identifier")},
        "lab_url": urljoin(url, lab_link.attributes["href"]) if lab_link is not None and lab_link.attributes.get("href") else None,
    }


_LISTING = "page_url string, position int, source_key string, name string, profile_url string, title string, department string, role string, next_url string, errors array<string>"
_PROFILE = "page_url string, name string, title string, affiliations array<struct<school:string,department:string>>, research_areas array<string>, research_summary string, biography string, lab_url string, lab_text string, known_titles array<string>, identifiers map<string,string>"


def listings(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:  # noqa: B008
    """One row per card of landed pages (url, body), and one with position -1 per page for its next_url and errors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, body in batch[["url", "body"]].itertuples(index=False):
                records, following, errors = read_listing(body, url, layout)
                rows += [{"page_url": url, "position": n, **r, "next_url": None, "errors": []} for n, r in enumerate(records)]
                rows.append({"page_url": url, "position": -1, "next_url": following, "errors": errors})
            yield frame(rows, [c.split()[0] for c in _LISTING.split(", ")])

    return spread(pages.select("url", "body")).mapInPandas(run, _LISTING)


def is_complete(parsed: DataFrame) -> DataFrame:
    """(complete, n_pages, n_errors) of a parsed listing: no errors, and exactly one page without a successor."""
    pages = parsed.filter("position = -1")
    return pages.agg(F.count("*").alias("n_pages"), F.sum(F.size("errors")).alias("n_errors"), F.count_if(F.col("next_url").isNull()).alias("_ends")).select(((F.coalesce(F.col("n_errors"), F.lit(1)) == 0) & (F.col("_ends") == 1)).alias("complete"), "n_pages", F.coalesce("n_errors", F.lit(0)).alias("n_errors"))


def audit(parsed: DataFrame, host: str) -> DataFrame:
    """(n_pages, n_errors, n_listed, n_linked, n_unlinked, n_repeated, n_foreign, has_cycle) of a parsed listing: cards
    with and without a link, keys or addresses listed more than once, links to other hosts, and whether a page follows
    itself or two pages have the same successor."""
    pages, cards = parsed.filter("position = -1"), parsed.filter("position >= 0")
    foreign = ~F.lower("profile_url").rlike(f"^https?://{host.replace('.', '[.]')}(?:[:/?#]|$)")
    listed = cards.agg(F.count("*").alias("n_listed"), F.count("profile_url").alias("n_linked"), F.count_if(F.col("profile_url").isNull()).alias("n_unlinked"), F.count_if(foreign).alias("n_foreign"))
    repeated = cards.groupBy(F.coalesce("source_key", "profile_url").alias("k")).count().filter("k is not null").agg(F.count_if(F.col("count") > 1).alias("n_repeated"))
    turns = pages.groupBy("next_url").agg(F.count("*").alias("n"), F.bool_or(F.col("next_url") == F.col("page_url")).alias("own")).filter("next_url is not null").agg(F.coalesce(F.bool_or((F.col("n") > 1) | F.col("own")), F.lit(False)).alias("has_cycle"))
    seen = pages.agg(F.count("*").alias("n_pages"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("n_errors"))
    return seen.crossJoin(listed).crossJoin(repeated).crossJoin(turns)  # four single rows


def with_profiles(parsed: DataFrame, profile_pages: DataFrame, layout: Layout = Layout(), home: str | None = None) -> DataFrame:  # noqa: B008
    """Listed persons with what their profile page says: a crawl of the listing and of every profile.

    A person whose page is missing or has no name keeps the row of the listing, with `profile_error`; persons without a
    link have none to miss. Fields of the profile come first, those of the listing fill in; `home` is the affiliation of
    persons whose profile names none.
    """
    cards = parsed.filter("position >= 0").select("source_key", "profile_url", F.col("name").alias("_name"), F.col("title").alias("_title"), "department", "role")
    found = profiles(profile_pages, layout).withColumnRenamed("page_url", "profile_url").dropDuplicates(["profile_url"])
    joined = cards.join(found, "profile_url", "left")
    error = F.when(F.col("profile_url").isNotNull() & F.col("name").isNull(), "the profile page could not be read")
    homes = F.array(F.struct(F.coalesce(F.lit(home), F.lit("")).alias("school"), F.col("department").alias("department")))
    return joined.select(
        "source_key", "profile_url", F.coalesce("name", "_name").alias("name"), F.coalesce("title", "_title").alias("title"), "role",
        F.when(F.size("affiliations") > 0, F.col("affiliations")).when(F.lit(home).isNotNull(), homes).otherwise(F.array().cast("array<struct<school:string,department:string>>")).alias("affiliations"),
        "research_areas", "research_summary", "biography", "lab_url", "lab_text", "known_titles", "identifiers", error.alias("profile_error"),
    )


def with_feed(parsed: DataFrame, people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persons, outcome): a listing reconciled with the people feed instead of a crawl of profiles.

    persons: (listing_id, feed_id, how) of matching.reconcile, listing_id being the page and position; outcome: one row
    of matching.completeness, complete only if the listing is, too.
    """
    cards = parsed.filter("position >= 0").select(F.concat_ws("#", "page_url", "position").alias("listing_id"), F.col("profile_url").alias("url"), "name")
    found = matching.reconcile(cards, people.filter("problem is null").select(F.col("person_id").alias("feed_id"), "url", "name"))
    both = matching.completeness(found).withColumnRenamed("complete", "_matched").crossJoin(is_complete(parsed).select("complete"))  # two single rows
    return found, both.select((F.col("complete") & F.col("_matched")).alias("complete"), "n_matched", "n_unmatched", "n_left_over", "n_repeated")


def profiles(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:  # noqa: B008
    """One row per landed profile page (url, body)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"page_url": url, **read_profile(body, url, layout)} for url, body in batch[["url", "body"]].itertuples(index=False)]
            yield frame(rows, ["page_url", "name", "title", "affiliations", "research_areas", "research_summary", "biography", "lab_url", "lab_text", "known_titles", "identifiers"])

    return spread(pages.select("url", "body")).mapInPandas(run, _PROFILE)


def plain_text(html: Column) -> Column:
    """Text of a page without scripts and styles, words one space apart."""
    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: parse(v).text(), na_action="ignore")

    return run(html)


# --- JSON ------------------------------------------------------------------------------------------------------------

_PAPER = "paperId string, title string, abstract string, year int, publicationDate string, url string, externalIds map<string,string>, authors array<struct<name:string>>, venue string, fieldsOfStudy array<string>"


def _present(c: Column) -> Column:
    return F.nullif(squeeze(c), F.lit(""))


def _paper(p: Column) -> Column:
    """A paper as given by a catalogue, trimmed; blank authors are dropped."""
    return F.struct(
        _present(p["paperId"]).alias("external_id"), _present(p["title"]).alias("title"), _present(p["abstract"]).alias("abstract"), p["year"].alias("year"),
        _present(p["publicationDate"]).alias("publication_date"), _present(p["url"]).alias("url"), _present(p["externalIds"]["DOI"]).alias("doi"),
        F.filter(F.transform(F.coalesce(p["authors"], F.array().cast("array<struct<name:string>>")), lambda a: squeeze(a["name"])), lambda n: n != "").alias("authors"),
        _present(p["venue"]).alias("venue"), p["fieldsOfStudy"].alias("fields_of_study"),
    )


def papers(responses: DataFrame, start_year: int | None = None, most: int | None = None) -> DataFrame:
    """Papers of landed result pages (author_id, page, body), in page order; rows without id or title are dropped.

    Years before start_year are skipped, unknown ones kept; `most` caps what is kept per author.
    """
    read = responses.select("author_id", "page", F.from_json("body", f"data array<struct<{', '.join(x.replace(' ', ':', 1) for x in _PAPER.split(', '))}>>")["data"].alias("d"))
    flat = read.select("author_id", "page", F.posexplode("d").alias("pos", "p")).select("author_id", "page", "pos", _paper(F.col("p")).alias("x")).select("author_id", "page", "pos", "x.*")
    kept = flat.filter("external_id is not null and title is not null")
    if start_year is not None:
        kept = kept.filter(F.col("year").isNull() | (F.col("year") >= start_year))
    if most is not None:
        kept = kept.withColumn("_n", F.row_number().over(Window.partitionBy("author_id").orderBy("page", "pos"))).filter(F.col("_n") <= most).drop("_n")
    return kept.drop("page", "pos")


def offsets_advance(responses: DataFrame) -> DataFrame:
    """(author_id, advances): whether the `next` of every result page (author_id, page, body) is greater than the one
    before it, so that paging came to an end."""
    read = responses.select("author_id", "page", F.get_json_object("body", "$.next").cast("long").alias("next"))
    before = F.lag("next").over(Window.partitionBy("author_id").orderBy("page"))
    return read.withColumn("_ok", F.coalesce(F.col("next") > before, F.lit(True))).groupBy("author_id").agg(F.bool_and("_ok").alias("advances"))


def accepted(responses: DataFrame) -> DataFrame:
    """Responses (status, body) to go on with: a refused key (401, 403) is an error; other failures have no body, so that
    what is read from them is incomplete."""
    refused = F.when(F.col("status").isin(401, 403), F.raise_error(F.concat(F.lit("refused with status "), F.col("status"))))
    return responses.withColumn("body", F.when(F.col("status").isin(401, 403), refused.cast("string")).when(F.col("status") < 400, F.col("body")))


def authors(responses: DataFrame) -> DataFrame:
    """Candidates of landed author searches (person_id, body): (person_id, author_id, name, affiliations, titles,
    complete). A malformed candidate makes its whole response incomplete."""
    shape = "data array<struct<authorId:string,name:string,affiliations:array<string>,papers:array<struct<paperId:string,title:string>>>>"
    read = responses.select("person_id", F.from_json("body", shape)["data"].alias("d"))
    bad = F.col("d").isNull() | F.exists("d", lambda a: _present(a["authorId"]).isNull() | _present(a["name"]).isNull())
    flat = read.withColumn("complete", ~bad).select("person_id", "complete", F.explode_outer("d").alias("a"))
    return flat.filter("a.authorId is not null and a.name is not null").select(
        "person_id", _present(F.col("a.authorId")).alias("author_id"), _present(F.col("a.name")).alias("name"), F.coalesce("a.affiliations", F.array().cast("array<string>")).alias("affiliations"),
        F.filter(F.transform("a.papers", lambda p: squeeze(p["title"])), lambda t: t != "").alias("titles"), "complete")


def feed(pages: DataFrame, host: str, prefix: str) -> DataFrame:
    """People of landed feed pages (page, total, body): (person_id, url, name, content_html, problem).

    problem is null for sound rows, else missing (id, link, name or content), foreign (other host or path) or repeated
    (the id occurred before).
    """
    shape = "array<struct<id:bigint,link:string,title:struct<rendered:string>,content:struct<rendered:string>>>"
    flat = pages.select("page", F.posexplode_outer(F.from_json("body", shape)).alias("pos", "p"))
    seen = F.row_number().over(Window.partitionBy("p.id").orderBy("page", "pos"))
    home = F.lower("p.link").rlike(f"^https?://{host.replace('.', '[.]')}{prefix}")
    gap = F.col("p.id").isNull() | _present(F.col("p.link")).isNull() | _present(F.col("p.title.rendered")).isNull() | F.col("p.content.rendered").isNull()
    problem = F.when(gap, "missing").when(~home, "foreign").when(seen > 1, "repeated")
    return flat.select(F.col("p.id").alias("person_id"), F.col("p.link").alias("url"), F.col("p.title.rendered").alias("name"), F.col("p.content.rendered").alias("content_html"), problem.alias("problem"))


def feed_is_complete(pages: DataFrame, people: DataFrame) -> DataFrame:
    """(complete): totals, and numbers of pages where pages have n_pages, agree on all pages and with what is there, and
    no row has a problem."""
    counted = (F.count_distinct("n_pages"), F.max("n_pages")) if "n_pages" in pages.columns else (F.lit(1), F.count_distinct("page"))
    totals = pages.agg(F.count_distinct("total").alias("k"), F.max("total").alias("t"), F.count_distinct("page").alias("seen"), counted[0].alias("pk"), counted[1].alias("p"))
    rows = people.agg(F.count_if(F.col("problem").isNull()).alias("n"), F.count("problem").alias("bad"))
    sound = (F.col("k") == 1) & (F.col("t") == F.col("n")) & (F.col("bad") == 0) & (F.col("pk") == 1) & (F.col("p") == F.col("seen"))
    return totals.crossJoin(rows).select(F.coalesce(sound, F.lit(False)).alias("complete"))  # two single rows
