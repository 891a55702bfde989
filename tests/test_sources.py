from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from skein.sources import landing, transport
from skein.sources.versions import Store
from skein.streaming.absence import follow

PAGE = """<div class="person-card" data-person-id="7" data-role="staff"><h2><a class="name-link" href="/p/7">Ann <b>Cole</b></a></h2><span class="person-title">Prof</span>
<p>unclosed<div class="person-department">Rivers</div></div><article class="entity"><h2 class="entity-name">Bob</h2></article><article class="entity"><p>nameless</p></article>{end}"""


def test_listing(spark):
    pages = [("https://x.org/1", PAGE.format(end='<div class="pagination-next"><a href="?page=2">more</a></div>')), ("https://x.org/2", '<div class="entity"><h2>Cy</h2></div><a class="pagination-next" aria-disabled="true"></a>'), ("https://x.org/3", "<p>changed</p>")]
    parsed = landing.listings(spark.createDataFrame(pages, "url string, body string"))
    rows = {(r.page_url[-1], r.position): r for r in parsed.collect()}
    assert (rows["1", 0].name, rows["1", 0].profile_url, rows["1", 0].title, rows["1", 0].department, rows["1", 0].role) == ("Ann Cole", "https://x.org/p/7", "Prof", "Rivers", "staff")
    assert rows["1", 1].name == "Bob" and rows["1", 1].profile_url is None and len(rows["1", -1].errors) == 1 and rows["1", -1].next_url == "https://x.org/1?page=2"
    assert rows["2", -1].errors == [] and rows["2", -1].next_url is None and len(rows["3", -1].errors) == 2
    assert landing.is_complete(parsed).first().complete is False
    assert landing.is_complete(parsed.filter("page_url like '%2'")).first().complete is True


def test_profile_and_text(spark):
    body = '<h1>Ann</h1><div class="affiliation" data-school="S" data-department="D"></div><ul><li class="research-area">a<li class="research-area">b</ul><div class="research-summary">we <a href=x>study</a> it</div><a class="lab-link" href="lab">Lab</a><script>no</script>'
    r = landing.profiles(spark.createDataFrame([("https://x.org/p/", body), ("https://x.org/q", None)], "url string, body string")).orderBy("page_url").collect()
    assert (r[0].name, r[0].research_summary, r[0].lab_url) == ("Ann", "we study it", "https://x.org/p/lab") and r[0].affiliations[0].school == "S" and r[1].name is None
    assert spark.createDataFrame([(body,)], "b string").select(landing.plain_text(F.col("b")).alias("t")).first().t.endswith("Lab")


def test_crawls_and_audit(spark):
    listing = [("https://x.org/1", PAGE.format(end='<a class="pagination-next" aria-disabled="true"></a>').replace('<article class="entity"><p>nameless</p></article>', '<article class="entity"><h2><a href="https://y.org/p">Cy</a></h2></article>'))]
    parsed = landing.listings(spark.createDataFrame(listing, "url string, body string"))
    r = landing.audit(parsed, "x.org").first()
    assert (r.n_pages, r.n_errors, r.n_listed, r.n_linked, r.n_unlinked, r.n_repeated, r.n_foreign, r.has_cycle) == (1, 0, 3, 2, 1, 0, 1, False)
    page = '<h1>Ann B. Cole</h1><i class="publication-title">On Rivers</i><a data-identifier="orcid" href="https://o.org/1">o</a><a class="lab-link" href="/l">The Lab</a>'
    got = {r.name: r for r in landing.with_profiles(parsed, spark.createDataFrame([("https://x.org/p/7", page)], "url string, body string"), home="Home").collect()}
    assert set(got) == {"Ann B. Cole", "Bob", "Cy"} and got["Cy"].profile_error and not got["Bob"].profile_error and got["Ann B. Cole"].title == "Prof"
    ann = got["Ann B. Cole"]
    assert ann.known_titles == ["On Rivers"] and ann.identifiers == {"orcid": "https://o.org/1"} and ann.lab_text == "The Lab" and ann.affiliations[0].school == "Home" and ann.affiliations[0].department == "Rivers"
    people = spark.createDataFrame([(1, "https://x.org/p/7", "A", None), (2, "https://x.org/b", "Bob", None), (3, "https://y.org/p", "Cy", None), (4, "https://x.org/z", "Z", "missing")], "person_id long, url string, name string, problem string")
    found, outcome = landing.with_feed(parsed, people)
    assert sorted(r.how for r in found.collect()) == ["name", "url", "url"] and outcome.first().complete is True
    assert landing.with_feed(parsed, people.filter("person_id > 1"))[1].first().complete is False


def test_paging_and_refusals(spark):
    pages = spark.createDataFrame([("a", 1, '{"next": 10}'), ("a", 2, '{"next": 20}'), ("a", 3, "{}"), ("b", 1, '{"next": 10}'), ("b", 2, '{"next": 10}')], "author_id string, page int, body string")
    assert {r.author_id: r.advances for r in landing.offsets_advance(pages).collect()} == {"a": True, "b": False}
    answers = spark.createDataFrame([(200, "x"), (500, "y")], "status int, body string")
    assert sorted((r.status, r.body) for r in landing.accepted(answers).collect()) == [(200, "x"), (500, None)]
    with pytest.raises(Exception, match="refused"):
        landing.accepted(spark.createDataFrame([(403, "x")], "status int, body string")).collect()
    feed = spark.createDataFrame([(1, 1, 2, "[]")], "page int, total int, n_pages int, body string")
    assert landing.feed_is_complete(feed, spark.createDataFrame([(1, None)], "person_id int, problem string")).first().complete is False


def test_records_and_schemas(spark, tmp_path):
    from skein.contracts import migrate
    from skein.functions.records import envelope, with_entry

    df = spark.createDataFrame([({"a": "1"}, "n"), (None, None)], "m map<string,string>, name string")
    assert [r.m for r in df.select(with_entry(F.col("m"), "a", F.lit(2)).alias("m")).collect()] == [{"a": "2"}, {"a": "2"}]
    assert json.loads(df.select(envelope(["name"], F.lit("s"), F.col("m")).alias("e")).first().e) == {"record": {"name": "n"}, "source": "s", "payload": {"a": "1"}}
    store = Store(spark, f"file://{tmp_path}/store")
    store.publish({"t": spark.createDataFrame([(1,)], "x int")})
    assert migrate(store, {"t": "x long, y string", "u": "z int"}) == ["t"] and migrate(store, {"t": "x long, y string"}) == []
    assert tuple(store.read("t").first()) == (1, None)
    with pytest.raises(ValueError, match="doesn't have"):
        migrate(store, {"t": "x long"})


def test_json_sources(spark):
    paper = {"paperId": " p1 ", "title": "T", "year": 2020, "externalIds": {"DOI": "10.1/x"}, "authors": [{"name": " A "}, {"name": ""}, {}], "extra": 1}
    pages = [("a", 1, json.dumps({"data": [paper, {"paperId": "p2"}, {"paperId": "p3", "title": "U", "year": 1990}, {"paperId": "p4", "title": "V"}]})), ("a", 2, "broken")]
    got = {r.external_id: r for r in landing.papers(spark.createDataFrame(pages, "author_id string, page int, body string"), start_year=2000).collect()}
    assert set(got) == {"p1", "p4"} and got["p1"].doi == "10.1/x" and got["p1"].authors == ["A"]
    assert landing.papers(spark.createDataFrame(pages, "author_id string, page int, body string"), most=1).count() == 1
    searches = [(1, json.dumps({"data": [{"authorId": "9", "name": "N", "papers": [{"title": "T"}]}]})), (2, json.dumps({"data": [{"authorId": "8"}, {"authorId": "7", "name": "M"}]}))]
    found = {r.author_id: (r.complete, r.titles) for r in landing.authors(spark.createDataFrame(searches, "person_id int, body string")).collect()}
    assert found == {"9": (True, ["T"]), "7": (False, None)}
    people = [{"id": 1, "link": "https://x.org/f/a", "title": {"rendered": "A"}, "content": {"rendered": "c"}}, {"id": 2, "link": "https://evil.org/f/b", "title": {"rendered": "B"}, "content": {"rendered": ""}}, {"id": 1, "link": "https://x.org/f/a", "title": {"rendered": "A"}, "content": {"rendered": "c"}}]
    feed = spark.createDataFrame([(1, 3, json.dumps(people))], "page int, total int, body string")
    rows = landing.feed(feed, "x.org", "/f/")
    assert sorted((r.person_id, r.problem or "") for r in rows.collect()) == [(1, ""), (1, "repeated"), (2, "foreign")]
    assert landing.feed_is_complete(feed, rows).first().complete is False


def test_transport_paces_repeats_and_lands(spark, tmp_path):
    clock, slept, answers, asked = [0.0], [], [429, 520, 200, 200], []

    def open_(url, headers):
        asked.append(url)
        return transport.Response(url, answers.pop(0), {"retry-after": "3"} if len(answers) == 3 else {}, b"\xffok")

    def sleep(s):
        slept.append(round(s, 3))
        clock[0] += s

    t = transport.Transport(spacing=5, open=open_, clock=lambda: clock[0], sleep=sleep, jitter=lambda: 0.0)
    landing_ = transport.Landing(spark, f"file://{tmp_path}/landed")
    assert landing_.fetch("u", t)["body"].endswith("ok") and landing_.fetch("u", t)["status"] == 200 and slept == [3.0, 2.0, 2.0, 3.0]
    assert transport.Landing(spark, f"file://{tmp_path}/landed").all(["u", "v", "u"], t) == 3 and asked == ["u", "u", "u", "v"]
    assert slept[-1] == 5.0 and sorted(r.url for r in landing_.responses().collect()) == ["u", "v"]
    with pytest.raises(RuntimeError, match="404"):
        transport.Transport(open=lambda u, h: transport.Response(u, 404, {}, b"")).get("u")
    assert [transport.worth_repeating(s) for s in (400, 429, 500, 599, 600)] == [False, True, True, True, False]
    date = datetime(2024, 1, 1, 0, 0, 30, tzinfo=timezone.utc)
    assert transport.asked_pause("Mon, 01 Jan 2024 00:00:30 GMT", date.timestamp() - 10) == 10 and transport.asked_pause("soon", 0) is None and transport.asked_pause(None, 0) is None and transport.asked_pause("2.5", 0) == 2.5


def test_versions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    one = spark.createDataFrame([(1,)], "x int")
    assert store.manifest() == {} and store.publish({"t": one}) == {"t": 1}
    store.publish({"t": store.read("t").unionByName(spark.createDataFrame([(2,)], "x int"))})
    assert sorted(r.x for r in store.read("t").collect()) == [1, 2] and store.manifest() == {"t": 2}
    with pytest.raises(ValueError, match="violations"):
        store.publish({"t": one}, checks=(one,))
    assert store.manifest() == {"t": 2}


def test_streaming_absences(spark, tmp_path):
    shape = "k string, v string, snapshot_id string, fetched_at timestamp, complete boolean"
    for n, (keys, complete) in enumerate([("ab", True), ("a", False), ("a", True), ("a", True)]):
        rows = [(k, str(n), f"s{n}", datetime(2024, 1, 1 + n), complete) for k in keys]
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        store = Store(spark, f"file://{tmp_path}/store")
        start = lambda: spark.createDataFrame([], "k string, v string, is_active boolean, missed int, last_seen timestamp")
        stream = spark.readStream.schema(shape).parquet(f"{tmp_path}/in")
        follow(stream, store, ["k"], ["v"], f"{tmp_path}/check", start).awaitTermination()
    state = {r.k: (r.v, r.is_active, r.missed) for r in store.read("state").collect()}
    assert state == {"a": ("3", True, 0), "b": ("0", False, 2)}
