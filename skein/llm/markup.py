"""Markup residue in text documents: clean text that keeps headings, lists, code blocks and formulas.

Every document is parsed once, whatever its notation (HTML, Markdown, wiki, LaTeX), into blocks that hang on the branches
of its tree. The trees of one host are merged into a site style tree: a node is a path of presentation (tags with their
class); for every node the pages that have it are counted, the ways in which they present its children, and the contents
beneath it. A content that k of the m pages of its node show has the importance 1 - log k / log m, so 0 if all pages show
it. The importance of a branch is the mean of all contents beneath it, mixed with the entropy of its presentations. A
branch is noise if it and all branches beneath it are of low importance; a content is noise if its own importance is low
and at least half of the pages of its node show it. Noise is removed from the text of each page.

Headings, list items, code blocks and formulas are all listed as elements, since the statement leaves out none of them;
those outside navigation containers are never removed from the text either.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.canonical import SPACE
from skein.runtime import cut, is_small, join_small, spread

#: Importance below which a branch or content is noise, pages that a node needs for it to be told, and weight of the contents.
LOW_IMPORTANCE, MIN_PAGES, GAMMA = 0.15, 3, 0.9
#: Share of a node's pages that must show a content for it to be noise, so that large hosts lose no more than small ones.
SHOWN = 0.5

_SPACES = re.compile(f"[{SPACE}]+")
_ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


def decode(text: str) -> str:
    """Character references with their semicolon; anything else with an ampersand stays."""

    def one(m: re.Match) -> str:
        name = m.group(1)
        if name[0] != "#":
            return html5.get(name + ";", m.group(0))
        code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else m.group(0)

    return _ENTITY.sub(one, text)


def squeeze(text: str) -> str:
    return _SPACES.sub(" ", text).strip(" ")


class Block:
    """A piece of a page: kind is text, heading, list_item, code or formula; path is its presentation."""

    __slots__ = ("kind", "level", "path", "text")

    def __init__(self, kind: str, text: str, path: str = "", level: int = 0) -> None:
        self.kind, self.text, self.path, self.level = kind, text, path, level


# --- HTML ------------------------------------------------------------------------------------------------------------

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Stands for an ampersand within the parser; a code point that is no character.
_AND = chr(0xFDD0)
_SKIPPED = frozenset("script style title".split())
_CONTAINERS = ("nav", "header", "footer", "aside", "form")
_SECTION = re.compile(r"<!\[(?:temp|cdata|ignore|include|rcdata|if|else|endif)(?![-_.a-z0-9])", re.IGNORECASE)
#: Tags that an opening tag closes, as long as no tag of the second set lies between.
_ENDS = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}


class _Page(HTMLParser):
    """Reads a page into blocks in document order. Nested list items and blocks each give their own text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, str]] = []
        self.buffer: list[str] = []

    def _flush(self) -> None:
        raw, self.buffer = "".join(self.buffer).replace(_AND, "&"), []
        tags = [t for t, _ in self.open]
        path = ">".join(t + (f".{c}" if c else "") for t, c in self.open if t in _BLOCK)
        if "pre" in tags:
            if raw.strip():
                self.blocks.append(Block("code", raw.strip("\n"), path))
            return
        if not raw.strip():
            return
        heading = next((t for t in reversed(tags) if re.fullmatch("h[1-6]", t)), None)
        kind = "heading" if heading else "list_item" if self._in_item(tags) else "text"
        self.blocks += formulas(raw, kind, path, int(heading[1]) if heading else 0)

    @staticmethod
    def _in_item(tags: list[str]) -> bool:
        for t in reversed(tags):
            if t in ("li", "dd", "dt"):
                return True
            if t in ("ul", "ol", "table"):
                return False
        return False

    def _hidden(self) -> bool:
        return any(t in _SKIPPED for t, _ in self.open)

    def _close(self, at: int) -> None:
        self._flush()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._hidden():
            return
        if tag in _VOID:
            if tag == "br":
                self.buffer.append("\n")
            elif tag == "hr":
                self._flush()
            return
        names = [t for t, _ in self.open]
        if tag in _ENDS:
            closes, stops = _ENDS[tag]
            for k in range(len(names) - 1, -1, -1):
                if names[k] in stops:
                    break
                if names[k] in closes:
                    self._close(k)
                    break
        elif tag in _BLOCK and "p" in names and tag not in ("td", "th", "tr"):
            k = len(names) - 1 - names[::-1].index("p")
            self._close(k)  # a paragraph ends where another block begins
        if re.fullmatch("h[1-6]", tag):  # so does a heading
            for k, (t, _) in enumerate(self.open):
                if re.fullmatch("h[1-6]", t):
                    self._close(k)
                    break
        if tag in _BLOCK:
            self._flush()
        css = next((v or "" for a, v in attrs if a == "class"), "")
        self.open.append((tag, css))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        names = [t for t, _ in self.open]
        if tag not in names:
            return
        k = len(names) - 1 - names[::-1].index(tag)
        if tag in ("em", "i", "b", "strong", "a", "span") and any(t in _BLOCK for t in names[k + 1 :]):
            return  # a stray inline end tag closes no block
        if tag in _BLOCK:
            self._close(k)
        else:
            del self.open[k:]

    def handle_data(self, data: str) -> None:
        if not self._hidden():
            self.buffer.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A section of a kind that the parser doesn't know is a comment up to its >, as in browsers, and no error."""
        return super().parse_marked_section(i, report) if _SECTION.match(self.rawdata, i) else self.parse_bogus_comment(i, report)


def read_html(text: str) -> list[Block]:
    page = _Page()
    page.feed(text.replace("&", _AND))  # references are decoded later, and only those with a semicolon
    page.close()
    page._flush()
    for b in page.blocks:
        if b.kind != "formula":
            b.text = decode(b.text)
    return page.blocks


# --- formulas --------------------------------------------------------------------------------------------------------

#: Delimiters of formulas. Openers are paired with the next closer of their kind by bisection, so that texts full of
#: openers without closers take no more than linear time.
_DELIMITER = re.compile(r"\$\$|\\\[|\\\]|\\\(|\\\)|\\(?:begin|end)\{(?:equation|align|gather|multline|eqnarray|displaymath|math)\*?\}|\$")
_CLOSER = {"$$": "$$", "\\[": "\\]", "\\(": "\\)", "$": "$"}
_TEX = re.compile(r"[\\^_={}<>+*/]|^\s*\w\s*$|^\w{1,3}\([^()]{1,40}\)$")
#: What follows a dollar sign where it stands for money.
_AMOUNT = re.compile(r"\d[\d,.]*(?:\s+\w{2,}|\s*[-/]\s*\w{2,}\s)")
_LABEL = re.compile(r"\\label\{[^{}]*\}")

def _inline(text: str, a: int, b: int) -> bool:
    """Whether single dollar signs at a and b enclose a formula and not amounts of money."""
    body = text[a + 1 : b]
    before, after = text[a - 1 : a], text[b + 1 : b + 2]
    tight = body and not body[0].isspace() and not body[-1].isspace() and body[-1] != "\\" and "\n\n" not in body and not _AMOUNT.match(body)
    return bool(tight) and not (before.isalnum() or before == "\\") and not after.isalnum() and bool(_TEX.search(body))


def _spans(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, TeX source, inline) of the formulas of a text, in order."""
    found = [(m.start(), m.end(), m.group(0)) for m in _DELIMITER.finditer(text) if text[m.start() - 1 : m.start()] != "\\" or m.group(0)[0] == "\\"]
    places: dict[str, list[int]] = {}
    for n, (_, _, sign) in enumerate(found):
        places.setdefault(sign, []).append(n)
    out, n = [], 0
    while n < len(found):
        start, end, sign = found[n]
        closer = sign.replace("begin", "end") if sign.startswith("\\begin") else _CLOSER.get(sign)
        k = bisect_right(places.get(closer, []), n) if closer else 0
        if closer and k < len(places.get(closer, [])):
            m = places[closer][k]
            body = text[end : found[m][0]]
            if body.strip() and (sign != "$" or _inline(text, start, found[m][0])):
                out.append((start, found[m][1], _LABEL.sub("", body) if sign.startswith("\\begin") else body, sign in ("$", "\\(")))
                n = m + 1
                continue
        n += 1
    return out


def formulas(raw: str, kind: str, path: str, level: int = 0) -> list[Block]:
    """A run of text as blocks: what is around its formulas stays one block of the kind, the formulas follow as blocks."""
    spans = _spans(raw)
    if not spans:
        return [Block(kind, raw, path, level)]
    found, parts, around, at = [], [], [], 0
    for start, end, tex, inline in spans:
        found.append(Block("formula", decode(tex).strip(), path))
        body = squeeze(decode(tex))
        around.append(raw[at:start])
        parts += [raw[at:start], f" ${body}$ " if inline else f"\n\n$${body}$$\n\n"]
        at = end
    around.append(raw[at:])
    if not "".join(around).strip():
        return found
    # the formula's place within the text is kept; as an element it is listed behind it
    return [Block(kind, "".join(parts) + raw[at:], path, level), *found]


# --- Markdown, wiki, LaTeX -------------------------------------------------------------------------------------------

_LINK_MD = re.compile(r"!?\[([^\]\[\n]{0,500})\]\([^()\s]{0,500}(?:\([^()\n]{0,200}\))?[^()\n]{0,200}\)")


def _plain_markdown(s: str) -> str:
    s = _LINK_MD.sub(r"\1", s)
    s = re.sub(r"`([^`\n]{1,500})`", r"\1", s)
    s = re.sub(r"(\*\*|__)(?=\S)([^\n]{1,300}?)(?<=\S)\1", r"\2", s)
    s = re.sub(r"(?<![\w*])\*(?=[^\s*])([^*\n]{1,300}?)(?<=[^\s*])\*(?![\w*])", r"\1", s)
    s = re.sub(r"(?<![\w_])_(?=[^\s_])([^_\n]{1,300}?)(?<=[^\s_])_(?![\w_])", r"\1", s)
    return decode(s)


def _plain_wiki(s: str) -> str:
    s = _without(_without(re.sub(r"<ref[^<>/]*/>", "", s), _REF, "</ref>"), _COMMENT, "-->")
    for _ in range(4):
        s, n = re.subn(r"\{\{[^{}]{0,2000}\}\}", "", s)
        if not n:
            break
    s = re.sub(r"\[\[(?:[^\[\]|]{0,500}\|)?([^\[\]|]{0,500})\]\]", r"\1", s)
    s = re.sub(r"\[(?:https?:)?//[^\s\]]{1,2000} ([^\]\[]{1,500})\]", r"\1", s)
    s = re.sub(r"'{2,5}", "", s)
    return decode(re.sub(r"</?(?:b|i|em|strong|span|small|sub|sup|br|nowiki|u)\b[^>]*>", "", s))


def _plain_latex(s: str) -> str:
    s = re.sub(r"(?<!\\)%[^\n]*", "", s)
    s = re.sub(r"~?\\(?:cite|ref|label|footnote|index|eqref)[pt]?\*?(?:\[[^\]]*\])*\{[^{}]*\}", "", s)
    s = re.sub(r"\\href\{[^{}]*\}", "", s)
    for _ in range(4):
        s, n = re.subn(r"\\(?:textbf|textit|emph|texttt|textsc|underline|text|textrm|url|mbox)\s*\{([^{}]*)\}", r"\1", s)
        s, k = re.subn(r"\{\\(?:it|bf|em|tt|sc|itshape|bfseries)\s+([^{}]*)\}", r"\1", s)
        if not n + k:
            break
    s = re.sub(r"\\([&%$#_{}])", r"\1", s)
    s = re.sub(r"\\\\|~", " ", s)
    return re.sub(r"(?<![\\$])[{}]", "", s) if "$" not in s else s


def _lines_to_blocks(text: str, plain, item, heading) -> list[Block]:  # noqa: ANN001
    """Paragraphs, list items and headings of a line-based notation; `item` and `heading` recognise a line."""
    blocks: list[Block] = []
    para: list[str] = []
    lines = text.split("\n")

    def flush() -> None:
        if para:
            body = "\n".join(para)
            para.clear()
            if body.strip():
                blocks.extend(_clean(formulas(body, "text", "p"), plain))

    k = 0
    while k < len(lines):
        line = lines[k]
        head = heading(lines, k, not para)
        if head:
            level, title, used = head
            flush()
            blocks.extend(_clean(formulas(title, "heading", f"h{level}", level), plain))
            k += used
            continue
        entry = item(line)
        if entry is not None:
            flush()
            k += 1
            # an item goes on over indented lines
            while k < len(lines) and lines[k].startswith(("  ", "\t")) and lines[k].strip() and item(lines[k]) is None:
                entry += " " + lines[k].strip()
                k += 1
            blocks.extend(_clean(formulas(entry, "list_item", "ul>li"), plain))
            continue
        if not line.strip():
            flush()
        else:
            para.append(line)
        k += 1
    flush()
    return blocks


def _clean(blocks: list[Block], plain) -> list[Block]:  # noqa: ANN001
    for b in blocks:
        if b.kind != "formula":
            parts = re.split(r"(\$\$.*?\$\$|\$[^$\n]+\$)", b.text, flags=re.DOTALL)
            b.text = "".join(p if n % 2 and any(f.kind == "formula" for f in blocks) else plain(p) for n, p in enumerate(parts))
    return blocks


_OPEN_FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})[^`]*$")
_PRE = re.compile(r"<(pre|syntaxhighlight|source)\b[^<>]*>", re.IGNORECASE)
_MATH = re.compile(r"<(math)\b[^<>]*>", re.IGNORECASE)
_VERBATIM = re.compile(r"\\begin\{(verbatim\*?|lstlisting|minted|Verbatim)\}(?:\[[^\]\n]{0,500}\])?(?:\{\w+\})?")
_REF = re.compile(r"<ref\b[^<>/]*>")
_COMMENT = re.compile(r"<!--")


def _closed_by(text: str, opening: re.Pattern, close) -> Iterator[tuple[re.Match, int, int]]:  # noqa: ANN001
    """(opening, end of the inner part, end of the closing sign) of what an opening and its closing sign enclose; a sign
    that was once not found isn't looked for again, so that the time stays linear."""
    at, missing = 0, set()
    folded = text.lower()
    while m := opening.search(text, at):
        sign = close(m).lower()
        end = -1 if sign in missing else folded.find(sign, m.end()) if len(folded) == len(text) else text.find(close(m), m.end())
        if end < 0:
            missing.add(sign)
            at = m.end()
            continue
        at = end + len(sign)
        yield m, end, at


def _without(text: str, opening: re.Pattern, close: str) -> str:
    out, at = [], 0
    for m, _, end in _closed_by(text, opening, lambda m: close):
        out.append(text[at : m.start()])
        at = end
    return "".join(out) + text[at:]


def _around(text: str, opening: re.Pattern, close, make, rest) -> list[Block]:  # noqa: ANN001
    """Blocks of what stands between opening and closing signs, and of the text around."""
    out, at = [], 0
    for m, inner, end in _closed_by(text, opening, close):
        out += rest(text[at : m.start()])
        out.append(make(text[m.end() : inner]))
        at = end
    return out + rest(text[at:])


def _fenced(text: str, rest) -> list[Block]:  # noqa: ANN001
    """Code between fences, and the blocks of the text around; a fence without an end is text."""
    lines = text.split("\n")
    stripped = [x.strip() for x in lines]
    closers: dict[str, list[int]] = {"`": [], "~": []}
    for n, x in enumerate(stripped):
        if len(x) >= 3 and x[0] in closers and set(x) == {x[0]}:
            closers[x[0]].append(n)
    out, at, n = [], 0, 0
    while n < len(lines):
        m = _OPEN_FENCE.match(lines[n])
        if m:
            signs = closers[m.group(1)[0]]
            k = bisect_right(signs, n)
            while k < len(signs) and len(stripped[signs[k]]) < len(m.group(1)):
                k += 1
            if k < len(signs):
                out += rest("\n".join(lines[at:n]))
                out.append(Block("code", "\n".join(lines[n + 1 : signs[k]]).strip("\n"), "pre"))
                at = n = signs[k] + 1
                continue
        n += 1
    return out + rest("\n".join(lines[at:]))


def read_markdown(text: str) -> list[Block]:
    def item(line: str) -> str | None:
        m = re.match(r"^ {0,3}(?:[-*+]|\d{1,9}[.)])[ \t]+(\S.*)$", line)
        return m.group(1) if m and not re.fullmatch(r"(?:[-*_] *){3,}", line.strip()) else None

    def heading(lines: list[str], k: int, fresh: bool):  # noqa: ANN202
        m = re.match(r"^ {0,3}(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?[ \t]*$", lines[k])
        if m and m.group(2):
            return len(m.group(1)), m.group(2), 1
        if fresh and k + 1 < len(lines) and lines[k].strip() and item(lines[k]) is None and not lines[k].startswith("    "):
            under = lines[k + 1].strip()
            if re.fullmatch(r"=+|-{2,}", under):
                return (1 if under[0] == "=" else 2), lines[k].strip(), 2
        return None

    def indented(part: str) -> list[Block]:
        out, buf, code = [], [], []
        rest = lambda: _lines_to_blocks("\n".join(buf), _plain_markdown, item, heading)
        lines, fresh, listed = part.split("\n"), True, False
        for k, line in enumerate(lines):
            deep = re.match(r"^(?: {4}|\t)", line) is not None and bool(line.strip())
            blank_then_deep = not line.strip() and code and next((bool(re.match(r"^(?: {4}|\t)\S?", x)) for x in lines[k + 1 :] if x.strip()), False)
            if deep and (code or (fresh and not listed)) or blank_then_deep:
                if not code:
                    out += rest()
                    buf.clear()
                code.append(re.sub(r"^(?: {4}|\t)", "", line))
                continue
            if code:
                out.append(Block("code", "\n".join(code).strip("\n"), "pre"))
                code = []
            buf.append(line)
            fresh = not line.strip()
            if line.strip():
                listed = item(line) is not None
        if code:
            out.append(Block("code", "\n".join(code).strip("\n"), "pre"))
            return out
        return out + rest()

    return _fenced(text, indented)


def read_wiki(text: str) -> list[Block]:
    def item(line: str) -> str | None:
        m = re.match(r"^[*#]+[ \t]*([^\s*#].*|\S.*)$", line)
        return m.group(1) if m else None

    def heading(lines: list[str], k: int, fresh: bool):  # noqa: ANN202, ARG001
        m = re.match(r"^(={1,6})\s*(.+?)\s*\1\s*$", lines[k])
        return (len(m.group(1)), m.group(2), 1) if m else None

    body_of = lambda part: _lines_to_blocks(part, _plain_wiki, item, heading)

    def inner(part: str) -> list[Block]:
        # formulas stand within the lines; they are turned into the common notation first
        out, at = [], 0
        for m, end, past in _closed_by(part, _MATH, lambda m: "</math>"):
            body = part[m.end() : end]
            out += [part[at : m.start()], f"\\({body}\\)" if body.strip() else ""]
            at = past
        return body_of("".join(out) + part[at:])

    bare = _without(text, _COMMENT, "-->")
    return _around(bare, _PRE, lambda m: f"</{m.group(1)}>", lambda code: Block("code", decode(re.sub(r"</?code\b[^<>]*>", "", code)).strip("\n"), "pre"), inner)


def read_latex(text: str) -> list[Block]:
    item = lambda line: m.group(1) if (m := re.match(r"^\s*\\item(?:\[[^\]]*\])?\s*(\S.*)$", line)) else None
    braces = r"((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)"
    title = re.compile(r"^\s*\\(part|chapter|section|subsection|subsubsection|paragraph)\*?(?:\[[^\]]*\])?\{" + braces + r"\}(?:\s*\\label\{[^}]*\})?\s*(.*)$")
    levels = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5}

    def heading(lines: list[str], k: int, fresh: bool):  # noqa: ANN202, ARG001
        m = title.match(lines[k])
        if not m:
            return None
        if m.group(3).strip():  # text goes on behind the heading
            lines.insert(k + 1, m.group(3))
        return levels[m.group(1)], m.group(2), 1

    def body(part: str) -> list[Block]:
        part = re.sub(r"^\s*\\(?:begin|end)\{(?:itemize|enumerate|description|document|quote|center|abstract)\}(?:\[[^\]]*\])?\s*$", "", part, flags=re.MULTILINE)
        part = re.sub(r"\\(?:documentclass|usepackage|maketitle|bibliography)\S*", "", part)
        return _lines_to_blocks(part, _plain_latex, item, heading)

    def outer(part: str) -> list[Block]:
        part = re.sub(r"(?<!\\)%[^\n]*", "", part)
        return body(part)

    return _around(text, _VERBATIM, lambda m: f"\\end{{{m.group(1)}}}", lambda code: Block("code", code.strip("\n"), "pre"), outer)


_TAGS = re.compile(r"<(?:p|div|ul|ol|li|h[1-6]|br|table|span|em|strong|section|article)\b[^>]*>", re.IGNORECASE)
_SIGNS = {
    "latex": re.compile(r"\\(?:begin|end)\{|\\(?:sub)*section\b|\\(?:textbf|textit|emph|cite|item|href|label)\b|\{\\(?:it|bf|em)\s|(?<=\s)% \w"),
    "wiki": re.compile(r"<ref\b|\{\{|\[\[|'''|''|^=+ .*? =+\s*$|<math\b|<syntaxhighlight\b|<pre>\s*$|\[https?://\S+ ", re.MULTILINE),
    "markdown": re.compile(r"\[[^\]\[\n]{1,500}\]\([^)\s(]{1,500}\)|\*\*|^ {0,3}(?:```|~~~)|^#{1,6} |^\S[^\n]*\n(?:={3,}|-{3,})\s*$|^ {0,3}(?:[-+]|\d+[.)]) |^ {4}\S", re.MULTILINE),
}


_ESCAPED = re.compile(r"&lt;/?(?:p|div|ul|ol|li|h[1-6]|br|pre|table|span|section)\b", re.IGNORECASE)


def unescape(text: str) -> str:
    """A page whose tags were all escaped once more than they should be, with that level of escapes taken off."""
    for _ in range(2):
        if _TAGS.search(text) or len(_ESCAPED.findall(text)) < 2:
            break
        text = decode(text)
    return text


def notation(text: str) -> str:
    """html, markdown, wiki, latex or plain, by the signs that occur most."""
    text = unescape(text)
    if len(_TAGS.findall(text)) >= 1 and not re.search(r"'''|\[\[|\{\{|^==", text, re.MULTILINE):
        return "html"
    scores = {name: len(p.findall(text)) for name, p in _SIGNS.items()}
    hashes = re.findall(r"(?:^# [^\n]*\n?){2,}", text, re.MULTILINE)
    if hashes:  # numbered entries under each other, not headings
        scores["wiki"] += 2 * len(hashes)
        scores["markdown"] -= sum(h.count("\n# ") + 1 for h in hashes)
    best = max(scores, key=lambda n: scores[n])
    if scores[best] > 0:
        return best
    if re.search(r"<(?:pre|code|b|i|a)\b", text, re.IGNORECASE):
        return "html"
    return "markdown" if re.search(r"^\* \S|\\[\[(]|\$", text, re.MULTILINE) else "plain"


_READERS = {"html": read_html, "markdown": read_markdown, "wiki": read_wiki, "latex": read_latex}


def read(text: str, kind: str | None = None) -> list[Block]:
    """The blocks of a document in any of the notations; a plain text is one block per paragraph."""
    text = unescape(text)
    kind = kind or notation(text)
    if kind == "plain":
        return [Block("text", decode(p), "p") for p in re.split(r"\n[ \t]*\n", text) if p.strip()]
    return [b for b in _READERS[kind](text) if b.text.strip()]


def element_texts(blocks: list[Block]) -> list[str | None]:
    """The text of every block that is a structural element; None for the others."""
    out: list[str | None] = []
    some = any(b.kind == "formula" for b in blocks)
    for b in blocks:
        text = "" if b.kind == "text" else squeeze(b.text)
        if some and b.kind in ("heading", "list_item"):
            text = squeeze(re.sub(r"\$\$(.*?)\$\$|\$([^$]+)\$", lambda m: m.group(1) or m.group(2) or "", text))
        out.append(text or None)
    return out


def elements(blocks: list[Block]) -> list[tuple[str, str]]:
    """(kind, text) of the structural elements, in order."""
    return [(b.kind, t) for b, t in zip(blocks, element_texts(blocks), strict=True) if t]


def lines(blocks: list[Block]) -> list[str | None]:
    """Every block as a part of plain text: headings behind # signs, items behind dashes, code between fences, formulas
    in $$; None for a formula that stands in the block before it already."""
    out: list[str | None] = []
    for n, b in enumerate(blocks):
        if b.kind == "formula":
            body = squeeze(b.text)
            out.append(None if n and blocks[n - 1].kind != "formula" and body in squeeze(blocks[n - 1].text) else f"$${body}$$")
        elif b.kind == "heading":
            out.append("#" * max(1, b.level) + " " + squeeze(b.text))
        elif b.kind == "list_item":
            out.append("- " + squeeze(b.text))
        elif b.kind == "code":
            out.append(f"```\n{b.text}\n```")
        else:
            out.append("\n".join(y for y in (squeeze(x) for x in b.text.split("\n")) if y))
    return out


def clean_text(blocks: list[Block]) -> str:
    """Blocks as plain text, a blank line apart, list items one line apart."""
    out = [x for x in lines(blocks) if x is not None]
    return "".join(part if not n else ("\n" if part.startswith("- ") and out[n - 1].startswith("- ") else "\n\n") + part for n, part in enumerate(out))


def joined_lines(parts: Column) -> Column:
    """`clean_text` of an array of lines without nulls."""
    apart = lambda x, n: F.when(n == 0, "").when(x.startswith("- ") & F.element_at(parts, n).startswith("- "), "\n").otherwise("\n\n")
    return F.array_join(F.transform(parts, lambda x, n: F.concat(apart(x, n), x)), "")


# --- site style tree -------------------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z]+://(?:[^/@]*@)?([^/:?#]*)", 1))


def _loose(b: Block) -> bool:
    """Whether a block may be removed: text, and structure within navigation containers."""
    return b.kind == "text" or bool({t.split(".")[0] for t in b.path.split(">")} & set(_CONTAINERS))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


_BLOCK_TYPE = "array<struct<line:string,kind:string,element:string,content:bigint,nodes:array<bigint>,loose:boolean>>"
_STYLE_TYPE = "array<struct<node:bigint,style:bigint>>"


def _lists(rows: list[list[tuple]], kinds: list[pa.DataType], names: list[str]) -> pa.Array:
    """Rows of tuples as an Arrow array of lists of structs, column by column."""
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    columns = list(zip(*[t for r in rows for t in r], strict=True)) or [()] * len(kinds)
    structs = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def _tree(blocks: list[Block], known: dict[str, int]) -> tuple[list[tuple], list[tuple]]:
    """(blocks with the nodes above them, how each node presents its children) of one page."""
    rows, children = [], {}
    texts, parts = element_texts(blocks), lines(blocks)
    for b, element, line in zip(blocks, texts, parts, strict=True):
        steps, path, nodes = b.path.split(">"), "", []
        for k, step in enumerate(steps):
            path = f"{path}>{step}" if k else step
            node = known.get(path)
            if node is None:
                node = known[path] = _hash(path)
            nodes.append(node)
            child = steps[k + 1] if k + 1 < len(steps) else f"#{b.kind}"
            run = children.setdefault(node, [])
            if not run or run[-1] != child:
                run.append(child)
        rows.append((line, b.kind, element, _hash(squeeze(b.text)), nodes, _loose(b)))
    return rows, [(node, _hash(">".join(run))) for node, run in children.items()]


def parsed(pages: DataFrame) -> DataFrame:
    """(key, page, host, notation, blocks, styles) of pages (key, host, text): every text is parsed here and only here.

    page is a hash of host and text, so that copies of a page count as one. Null texts have null blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            notations, blocks, styles = [], [], []
            for text in batch.column("text").to_pylist():
                kind = None if text is None else notation(text)
                rows, ways = ([], []) if text is None else _tree(read(text, kind), known)
                notations.append(kind)
                blocks.append(rows)
                styles.append(ways)
            known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("page"), batch.column("host"), pa.array(notations, pa.string()),
                 _lists(blocks, [pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_()], ["line", "kind", "element", "content", "nodes", "loose"]),
                 _lists(styles, [pa.int64(), pa.int64()], ["node", "style"])],
                names=["key", "page", "host", "notation", "blocks", "styles"],
            )

    kind = pages.schema["key"].dataType.simpleString()
    rows = spread(pages.select("key", "host", "text")).select("key", F.xxhash64("host", "text").alias("page"), "host", "text")
    return rows.mapInArrow(run, f"key {kind}, page long, host string, notation string, blocks {_BLOCK_TYPE}, styles {_STYLE_TYPE}")


def style_tree(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, contents) of the merged trees of all hosts.

    pages: (page, host, blocks, styles). nodes: (host, node, pages, importance, highest), highest being the greatest
    importance of the node and all nodes beneath it; contents: (host, node, content, shown, pages, importance) of the
    blocks that may be removed, node being the one they hang on. All pages are counted, copies once.
    """
    sites = pages.filter(F.coalesce(F.col("host"), F.lit("")) != "")
    ways = sites.select("host", "page", F.explode("styles").alias("s")).select("host", "page", "s.node", "s.style").distinct().groupBy("host", "node", "style").agg(F.count("*").alias("k"))
    shape = cut(ways.groupBy("host", "node").agg(F.sum("k").alias("pages"), F.sum(F.col("k") * F.log("k")).alias("klogk")))
    # -sum p log p to the base of m, with p = k / m; one page alone is taken to be important
    entropy = F.when(F.col("pages") > 1, 1 - F.col("klogk") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    shape = shape.select("host", "node", "pages", entropy.alias("presentation"))
    found = sites.select("host", "page", F.explode("blocks").alias("b")).select("host", "page", F.col("b.nodes").alias("nodes"), F.col("b.content").alias("content"), F.col("b.loose").alias("loose")).distinct()
    shown = cut(found.groupBy("host", "nodes", "content").agg(F.count("*").alias("shown"), F.bool_or("loose").alias("loose")).withColumn("node", F.element_at("nodes", -1)))
    importance = F.when(F.col("pages") > 1, 1 - F.log("shown") / F.log("pages")).otherwise(1.0)
    contents = cut(join_small(shown, shape, ["host", "node"]).select("host", "nodes", "node", "content", "shown", "pages", "loose", F.greatest(importance, F.lit(0.0)).alias("importance")))
    leaves = cut(contents.groupBy("host", "nodes").agg(F.sum("shown").alias("w"), F.sum(F.col("shown") * F.col("importance")).alias("x")))
    beneath = leaves.select("host", F.explode("nodes").alias("node"), "w", "x").groupBy("host", "node").agg((F.sum("x") / F.sum("w")).alias("mean"))
    scored = cut(beneath.join(shape, ["host", "node"]).select("host", "node", "pages", (GAMMA * F.col("mean") + (1 - GAMMA) * F.col("presentation")).alias("importance")))
    pairs = leaves.select("host", F.posexplode("nodes").alias("p", "node"), "nodes").select("host", "node", F.explode(F.expr("slice(nodes, p + 1, size(nodes))")).alias("under")).distinct()
    highest = pairs.join(scored.select("host", F.col("node").alias("under"), F.col("importance").alias("i")), ["host", "under"]).groupBy("host", "node").agg(F.max("i").alias("highest"))
    return scored.join(highest, ["host", "node"]), contents.filter("loose").drop("nodes", "loose")


def noise(pages: DataFrame, low: float = LOW_IMPORTANCE, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """(branches, contents) to be removed: (host, node) and (host, node, content)."""
    nodes, contents = style_tree(pages)
    branches = nodes.filter((F.col("highest") < low) & (F.col("pages") >= min_pages)).select("host", "node")
    low_contents = contents.filter((F.col("importance") < low) & (F.col("pages") >= min_pages) & (F.col("shown") >= SHOWN * F.col("pages"))).select("host", "node", "content")
    return cut(branches), cut(low_contents)


def clean_documents(pages: DataFrame) -> DataFrame:
    """(key, text_clean, notation, elements) for every row of pages (key, host, text).

    elements: array of (kind, text) of all headings, list items, code blocks and formulas. Null texts give null and an
    empty array, blank ones the empty string; repeated rows are kept; columns other than the three are not used. Hosts
    with fewer than MIN_PAGES pages, and pages without a host, keep their whole text.
    """
    rows = cut(parsed(pages))
    branches, contents = noise(rows)
    drops = None
    if not (is_small(branches, 0) and is_small(contents, 0)):
        # hashes of blocks meet the noise, not the texts
        blocks = rows.select("page", "host", F.posexplode("blocks").alias("pos", "b")).filter("b.loose").select("page", "host", "pos", F.col("b.content").alias("content"), F.col("b.nodes").alias("nodes")).distinct()
        low = join_small(blocks.withColumn("node", F.element_at("nodes", -1)), contents, ["host", "node", "content"]).select("page", "pos")
        within = join_small(blocks.select("page", "host", "pos", F.explode("nodes").alias("node")), branches, ["host", "node"]).select("page", "pos")
        drops = low.unionByName(within).groupBy("page").agg(F.collect_set("pos").alias("drops"))  # blocks of one page
    joined = rows.withColumn("drops", F.lit(None).cast("array<int>")) if drops is None else join_small(rows, drops, ["page"], "left")
    kept = F.filter("blocks", lambda b, n: b["line"].isNotNull() & ~F.coalesce(F.array_contains("drops", n), F.lit(False)))
    found = F.transform(F.filter("blocks", lambda b: b["element"].isNotNull()), lambda b: F.struct(b["kind"].alias("kind"), b["element"].alias("text")))
    return joined.select("key", F.transform(kept, lambda b: b["line"]).alias("_lines"), "notation", found.alias("elements")).select(
        "key", F.when(F.col("notation").isNotNull(), joined_lines(F.col("_lines"))).alias("text_clean"), "notation", "elements")


def pages_of(feed: DataFrame, faculty: DataFrame) -> DataFrame:
    """Both marked-up columns as pages: key is (source_table, record_id)."""
    a = feed.select(F.struct(F.lit("people_feed").alias("source_table"), F.col("wp_person_id").alias("record_id")).alias("key"), host_of(F.col("profile_url")).alias("host"), F.col("content_html").alias("text"))
    b = faculty.select(F.struct(F.lit("raw_faculty").alias("source_table"), F.col("record_id").alias("record_id")).alias("key"), host_of(F.coalesce("source_url", "profile_url")).alias("host"), F.col("biography").alias("text"))
    return a.unionByName(b)
