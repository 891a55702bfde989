"""Markup and truncation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skein.llm import markup, truncation


def elements(text):
    return markup.elements(markup.read(text))


HTML = """<!-- <h2>no</h2> --><style>h1{}</style><P class=x>Text<h2 id=a>A &amp; <em>B</em></h2><ul><li>one <i>x</i><li>two &lt;b&gt;</ul>
<pre class="c"><code>a &lt; b
  c(&amp;d)</code></pre><script>var t = '<h3>no</h3>'</script><div>\\[E = m c^2\\]</div><p>so $x_1$ holds, at $5 or $6</p><p>&nbsp;</p><h3>open"""


def test_html():
    assert elements(HTML) == [("heading", "A & B"), ("list_item", "one x"), ("list_item", "two <b>"), ("code", "a < b c(&d)"), ("formula", "E = m c^2"), ("formula", "x_1"), ("heading", "open")]
    assert elements("<head><title>no</title><h2>yes</h2>") == [("heading", "yes")] and elements("<noscript><h2>yes</h2></noscript>") == [("heading", "yes")]
    assert elements("<p>so $f(x)$ and $" + "a+" * 300 + "b$ at $5/h or $6 a day, $7 - $8</p>") == [("formula", "f(x)"), ("formula", "a+" * 300 + "b")]
    text = markup.clean_text(markup.read(HTML))
    for part in ("## A & B", "- one x\n- two <b>", "```\na < b\n  c(&d)\n```", "$$E = m c^2$$", "so $x_1$ holds, at $5 or $6"):
        assert part in text
    assert "no" not in text.split() and "<" not in text.replace("a < b", "").replace("two <b>", "")


def test_pages_that_were_escaped_twice():
    import html

    assert elements(html.escape(HTML)) == elements(HTML)
    assert elements("a &lt;b and c&gt; d &lt;p") == []


def test_nested_lists_keep_every_item():
    assert elements("<ul><li>a<ul><li>b</li><li>c</li></ul></li><li><p>d</p></li></ul>") == [("list_item", x) for x in "abcd"]


MARKDOWN = """Intro with [a link](https://x.org/y) and **bold**, not C*-algebras.

## Head *one* ##

- item `a`
- item b & c
  goes on

1. first
2) second

Under
-----

```r
x <- "*y*"
```

    indented(code)

    more

$$a^2 + b^2$$ and inline $\\beta$ but $5 and $6.
"""


def test_markdown():
    assert elements(MARKDOWN) == [
        ("heading", "Head one"), ("list_item", "item a"), ("list_item", "item b & c goes on"), ("list_item", "first"), ("list_item", "second"), ("heading", "Under"),
        ("code", 'x <- "*y*"'), ("code", "indented(code) more"), ("formula", "a^2 + b^2"), ("formula", "\\beta"),
    ]
    assert "a link and bold, not C*-algebras" in markup.clean_text(markup.read(MARKDOWN))


WIKI = """Text with '''bold''' and [[Page|a link]], [https://x.org outer].<ref>note</ref>{{cn|{{x}}}}
== Head ''one'' ==
# first
# '''second'''
*third
<math>x < y</math>
<pre>
if (a < b) { &c; }
</pre>
<syntaxhighlight lang="x">
d &lt; e
</syntaxhighlight>
"""


def test_wiki():
    assert elements(WIKI) == [("heading", "Head one"), ("list_item", "first"), ("list_item", "second"), ("list_item", "third"), ("formula", "x < y"), ("code", "if (a < b) { &c; }"), ("code", "d < e")]
    text = markup.clean_text(markup.read(WIKI))
    assert "Text with bold and a link, outer." in text and "note" not in text


LATEX = r"""Words~\cite{a} with \textbf{bold}, {\it slanted} \href{https://x}{text}. % remark
\section*{Head \emph{one}}\label{s}
\begin{itemize}
\item first \& best
\item \textit{second}
\end{itemize}
\begin{equation}
a_1 = \frac{b}{c}
\end{equation}
\[ \hat{x} \] and $y_2$.
\begin{verbatim}
100% \sure
\end{verbatim}
"""


def test_latex():
    assert elements(LATEX) == [("heading", "Head one"), ("list_item", "first & best"), ("list_item", "second"), ("formula", r"a_1 = \frac{b}{c}"), ("formula", r"\hat{x}"), ("formula", "y_2"), ("code", r"100% \sure")]
    assert "Words with bold, slanted text." in markup.clean_text(markup.read(LATEX))


@pytest.mark.parametrize("text", ["Ranked #1 of 40 teams [2], the group shares half_life data.", "C*-algebras and H_2 storage", "it costs $5 or $6 at a * b", "", "  \n ", "AT&T & others; 3 < 4"])
def test_plain_text_has_no_elements(text):
    assert elements(text) == []


def test_broken_markup_is_survived():
    for text in ("<p", "<ul><li", "</div></p>", "\\begin{verbatim}", "```\nx", "{{{{", "$$", "<pre>", "&#xFFFFFFF;&#0;&bad;", "\x00<h1>x"):
        markup.clean_text(markup.read(text))
    assert markup.decode("&#233;&eacute;&amp &unknown; &#xD800;") == "éé&amp &unknown; &#xD800;"


@pytest.mark.parametrize("section", ["<![foo[x]]>", "<![ x>", "<![>", "<![1 x]>"])
def test_unknown_sections_end_no_page(spark, section):
    page = f"<h1>A</h1><p>before</p>{section}<ul><li>one</li><li>two</li></ul><pre>code</pre>"
    assert elements(page) == [("heading", "A"), ("list_item", "one"), ("list_item", "two"), ("code", "code")]
    got = markup.clean_documents(spark.createDataFrame([(1, None, page)], "key long, host string, text string")).first()
    assert len(got.elements) == 4 and "before" in got.text_clean and got.text_clean.endswith("```\ncode\n```")


def test_a_failing_parser_is_no_result(monkeypatch):
    def fail(self, tag, attrs):
        raise ValueError(tag)

    monkeypatch.setattr(markup._Page, "handle_starttag", fail)
    with pytest.raises(ValueError, match="h1"):
        markup.read_html("<h1>A</h1>")


def test_long_texts_take_linear_time():
    import time

    began = time.perf_counter()
    for unit in ("**a ", "$$ a\n", "$a ", "{{", "[[", "[a](", "<ref>", "<pre>", "<math>", "\\(", "\\begin{equation}", "\\textbf{", "```\n", "# a\n", "- a\n", "_a ", "''", "x"):
        blocks = markup.read(unit * (100_000 // len(unit)))
        markup.elements(blocks)
        markup.clean_text(blocks)
    assert time.perf_counter() - began < 30


def test_documents_and_boilerplate(spark):
    pages = [(n, "h.org", f"<div class=top>Home About Contact</div><nav><ul><li>Menu {chr(97)}</li></ul></nav><p>Unique text number {n}.</p><h2>Overview</h2><p>See page {n}</p>") for n in range(40)]
    pages += [(100, None, None), (101, "h.org", ""), (102, "o.org", "<p>Home About Contact</p>"), (103, None, "plain"), (103, None, "plain")]
    df = spark.createDataFrame(pages, "key long, host string, text string").withColumn("page", F.lit("clash"))
    got = markup.clean_documents(df).collect()
    assert len(got) == len(pages)
    rows = {r.key: r for r in got}
    assert "Home" not in rows[3].text_clean and "Menu" not in rows[3].text_clean and "Unique text number 3." in rows[3].text_clean
    assert [(e.kind, e.text) for e in rows[3].elements] == [("list_item", "Menu a"), ("heading", "Overview")]
    assert rows[100].text_clean is None and rows[100].elements == [] and rows[101].text_clean == "" and rows[102].text_clean == "Home About Contact"
    assert markup.clean_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("paragraphs", [1, 5, 20])
def test_a_footer_in_a_shared_paragraph_is_removed(spark, paragraphs):
    body = lambda n: "".join(f"<p>Page {n} says {k} things of its own.</p>" for k in range(paragraphs))
    pages = [(n, "h.org", f"<body>{body(n)}<p>All rights reserved.</p></body>") for n in range(60)]
    got = markup.clean_documents(spark.createDataFrame(pages, "key long, host string, text string")).collect()
    for r in got:
        assert "rights" not in r.text_clean and r.text_clean.count("of its own") == paragraphs


def test_low_branches_go_and_rare_contents_stay(spark):
    page = lambda n: f"<div class=main><p>Own text {n}.</p></div><div class=side><p>Visit us</p><p>Open daily</p></div>" + ("<div class=note><p>Closed in May</p></div>" if n < 12 else "")
    df = spark.createDataFrame([(n, "h.org", page(n)) for n in range(30)] + [(100 + n, "two.org", page(0)) for n in range(2)], "key long, host string, text string")
    rows = markup.cut(markup.parsed(df))
    branches, contents = markup.noise(rows)
    side = [markup._hash(x) for x in ("div.side", "div.side>p")]
    assert {(r.host, r.node) for r in branches.collect()} >= {("h.org", x) for x in side}
    assert ("h.org", markup._hash("div.main")) not in {(r.host, r.node) for r in branches.collect()}
    text = {r.key: r.text_clean for r in markup.clean_documents(df).collect()}
    assert text[20] == "Own text 20." and "Visit" in text[100]
    nodes, contents = markup.style_tree(rows)
    main = {r.content: (r.shown, r.pages) for r in contents.filter(F.col("node") == markup._hash("div.side>p")).filter("host = 'h.org'").collect()}
    assert set(main.values()) == {(30, 30)}


def test_headings_are_never_lost_to_the_tree(spark):
    pages = [(n, "h.org", f"<h2>Biography</h2><ul><li>Rivers</li></ul><footer><h3>Contact</h3><p>Same</p></footer><p>Text {n}</p>") for n in range(25)]
    for r in markup.clean_documents(spark.createDataFrame(pages, "key long, host string, text string")).collect():
        assert [(e.kind, e.text) for e in r.elements] == [("heading", "Biography"), ("list_item", "Rivers"), ("heading", "Contact")]
        assert r.text_clean == f"## Biography\n\n- Rivers\n\nText {r.key}"


def corpus(n=1500):
    rnd = random.Random(6)
    nouns, verbs = ["rivers", "deltas", "stones", "mosses", "glaciers", "turbines"], ["carry", "shape", "measure", "explain", "limit"]
    sentence = lambda: f"The {rnd.choice(nouns)} {rnd.choice(verbs)} {rnd.choice(['slow', 'cold', 'steady', 'hidden'])} {rnd.choice(nouns)} with {rnd.choice(['care', 'patience', 'instruments'])}."
    rows, cut = [], set()
    for k in range(n):
        text = " ".join(sentence() for _ in range(rnd.randrange(3, 12)))
        kind = rnd.random()
        if kind < 0.08:
            end = rnd.randrange(40, len(text) - 8)
            piece = text[:end].rstrip()
            if piece[-1] not in ".":
                text = piece + rnd.choice(["", "", "...", chr(0x2026), " [more]"])
                cut.add(k)
        elif kind < 0.16:
            text += rnd.choice(["\n\n- Cold rivers\n- Steady stones", "\n\nAnn B. Cole", " See https://x.org/a", " [12]", "\n\nContact: a@x.org", " (Updated in 2024.)"])
        rows.append((k, text, rnd.choice(["s1", "S1 ", "s2", None]), "clash"))
    return rows, cut


def test_truncation_on_held_out_cuts(spark):
    rows, cut = corpus()
    extra = [(5000, None, "s1", ""), (5001, "   ", "s1", ""), (5002, "", None, ""), (5003, "w " * 60000 + "end.", "s1", "")]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, source string, score string")
    scored = truncation.score_truncation(df)
    got = {r.doc_id: r for r in scored.collect()}
    found = {k for k, r in got.items() if r.truncated}
    assert len(got) == len(rows) + 4
    assert len(found & cut) >= 0.95 * len(cut) and len(found - cut) <= 0.05 * len(cut)
    assert not {5000, 5001, 5002, 5003} & found and got[5000].score == 0.0
    rates = {r.source: r for r in truncation.truncation_rates(scored).collect()}
    assert set(rates) == {"s1", "s2", ""} and sum(r.n_truncated for r in rates.values()) == len(found)


def test_truncation_without_anything_to_learn(spark):
    shape = "doc_id long, text string, source string"
    assert truncation.score_truncation(spark.createDataFrame([], shape)).count() == 0
    one = truncation.score_truncation(spark.createDataFrame([(1, None, None), (1, None, None)], shape)).collect()
    assert [(r.score, r.truncated) for r in one] == [(0.0, False)] * 2


def test_cuts_that_end_alike_are_cuts_in_copies_and_in_large_tables(spark):
    rows, cut = corpus()
    whole = max((r[1] for r in rows if r[0] not in cut and r[1]), key=len)
    copy = whole[: len(whole) // 2].rsplit(" ", 2)[0] + " then the..."
    copies = [(7000 + k, copy, "s1", "") for k in range(8)]
    # six texts that were cut behind the same words, among two hundred others with a mark
    texts = [r[1] for r in rows if r[0] not in cut and r[1] and len(r[1]) > 200]
    same = [(8000 + k, texts[k][: 100 + k].rsplit(" ", 1)[0] + " within the new...", "s2", "") for k in range(6)]
    other = [(9000 + k, texts[k % len(texts)][: 60 + k % 90].rsplit(" ", 1)[0] + f" word{k}...", "s2", "") for k in range(200)]
    df = spark.createDataFrame(rows + copies + same + other, "doc_id long, text string, source string, score string")
    found = {r.doc_id for r in truncation.score_truncation(df).filter("truncated").collect()}
    assert {r[0] for r in copies + same} <= found
