"""Main text of web pages: blocks pass points up the tree, the best container and its siblings are kept."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts of one slice of a batch, in bytes: what a worker holds at once besides one page.
SLICE = 4 << 20

# ---- fixed values: kinds of elements and the words by which class and id name what is not the article

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript object "
    "ol optgroup option p pre search section summary svg table tbody td template tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are paragraphs of their parent; other blocks hold paragraphs.
PARAGRAPH = HEADING | frozenset("address caption dd dt figcaption legend li p pre summary td th".split())
CLOSES_P = BLOCK - frozenset("body caption head html legend noscript object optgroup option svg tbody td template tfoot th thead tr".split())
#: A p, and an item, is looked for no higher than these.
HOLDS_P = frozenset("body button caption html object table td template th".split())
HOLDS_ITEM = BLOCK - frozenset("address div p li dd dt".split())
#: Never text of the article.
DROPPED = frozenset("aside audio button canvas datalist dialog footer head label map menu nav noscript object search select svg template video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NEVER = frozenset(
    "ad ads adsense adslot adv advert advertisement advertisements advertising adverts breadcrumb breadcrumbs ccpa colophon comment commentlist comments consent cookie cookies copyright disqus footer gdpr lightbox login "
    "menu modal nav navbar navigation newsletter outbrain overlay pager pagination paywall popup recirculation recommendations recommended related replies reply respond share sharebar sharing sidebar sidenav signup "
    "snackbar social sponsor sponsored sponsors submenu subscribe subscription taboola toast".split())
RARELY = frozenset("alert announcement announcements banner header masthead notice notices notification notifications promo promotion tagcloud tags teaser toolbar widget widgets".split())
COMMENT = frozenset("comment commentlist comments disqus replies reply respond".split())
GOOD = frozenset("article body content entry main page post story text".split())
NOT = frozenset("has no not with without".split())

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![^\s/])(hidden)(?![^\s/])", re.I)
_CLASS = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[A-Za-z]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_COMMA = re.compile("[,،、，]")


def _kind(name: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """Of an element: whether it is never article, rarely, of comments, and whether it looks like the article."""
    never, rarely, comment, good = name in DROPPED, name in ("form", "header", "fieldset"), False, name in ("article", "main")
    if not attributes or not _CLASS.search(attributes):
        return never, rarely, comment, good
    for key, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if hidden or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            never = True
        elif key == "role":
            never |= value in ROLES
            good |= value in ("main", "article")
        elif key == "itemprop":
            good |= value == "articleBody"
        elif key in ("class", "id"):
            last = ""
            for word in map(str.lower, _WORD.findall(_CASE.sub(" ", value))):
                if last not in NOT:
                    never |= word in NEVER
                    rarely |= word in RARELY
                    comment |= word in COMMENT
                    good |= word in GOOD
                last = word
    return never, rarely, comment, good


class Page:
    """A page as a tree of its blocks; inline elements stand in it only where their class speaks against them."""

    def __init__(self, html: str):
        self.parent, self.tag, self.kind = [-1], ["html"], [(False, False, False, False)]
        self.blocks: list[tuple[int, list[tuple[int, str, bool]]]] = []  # of each block its node and its pieces: node, text, whether linked
        self._open, self._at = [0], {"html": [0]}  # nodes on the way down, and where in it each name stands
        self._scope = [(-1, -1, -1, -1, -1)]  # place of the p, item, cell, row and row group that a tag may close
        self._pieces: list[tuple[int, str, bool]] = []
        self._link = -1  # depth at which a link is open
        self._inner: dict[str, int] = {}  # inline elements inside one of their name that is a node
        self._read(html)
        self._flush()

    def _flush(self) -> None:
        if self._pieces:
            at = self._open[-1]
            while self.tag[at] not in BLOCK:
                at = self.parent[at]
            self.blocks.append((at, self._pieces))
            self._pieces = []

    def _push(self, name: str, kind: tuple[bool, bool, bool, bool]) -> None:
        p, item, cell, row, rows = self._scope[-1]
        here, block = len(self._open), name in BLOCK
        if block:
            self._flush()
        self._scope.append((
            here if name == "p" else -1 if name in HOLDS_P else p, here if name in ("li", "dd", "dt") else -1 if name in HOLDS_ITEM else item,
            here if name in ("td", "th") else -1 if name == "table" else cell, here if name == "tr" else -1 if name == "table" else row,
            here if name in ("thead", "tbody", "tfoot") else -1 if name == "table" else rows))
        self.parent.append(self._open[-1])
        self.tag.append(name)
        self.kind.append(kind)
        self._at.setdefault(name, []).append(here)
        self._open.append(len(self.tag) - 1)

    def _pop(self, to: int) -> None:
        """Closes all from place `to` of the way down."""
        if any(self.tag[i] in BLOCK for i in self._open[to:]):
            self._flush()
        for i in reversed(self._open[to:]):
            self._at[self.tag[i]].pop()
        del self._open[to:], self._scope[to:]
        if self._link >= to:
            self._link = -1

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._at.get(name):
            return
        if name in CLOSES_P and self._scope[-1][0] > 0:
            self._pop(self._scope[-1][0])
        p, item, cell, row, rows = self._scope[-1]
        if name in ("li", "dd", "dt") and item > 0 and (name == "li") == (self.tag[self._open[item]] == "li"):
            self._pop(item)
        elif name in ("td", "th") and cell > 0:
            self._pop(cell)
        elif name == "tr" and row > 0:
            self._pop(row)
        elif name in ("thead", "tbody", "tfoot") and rows > 0:
            self._pop(rows)
        elif name in HEADING and self.tag[self._open[-1]] in HEADING or name in ("option", "optgroup") and self.tag[self._open[-1]] == "option":
            self._pop(len(self._open) - 1)
        if name == "body" and self._at.get("head"):
            self._pop(self._at["head"][-1])
        if name == "br":
            self._pieces.append((self._open[-1], " ", False))
        elif name == "hr":
            self._flush()
        elif name == "a":
            self._link = len(self._open) if "href" in attributes.lower() else -1
        if name in VOID:
            return
        kind = _kind(name, attributes)
        if name in BLOCK or kind[0] or kind[1]:
            self._push(name, kind)
        elif self._at.get(name):
            self._inner[name] = self._inner.get(name, 0) + 1

    def _close(self, name: str) -> None:
        if name == "a":
            self._link = -1
        if name == "br":
            self._pieces.append((self._open[-1], " ", False))
        places = self._at.get(name)
        if not places or name in ("html", "body"):
            return
        if self._inner.get(name):
            self._inner[name] -= 1
        elif name in ("article", "main", "table", "tr", "td", "th", "section", "div", "nav", "aside", "footer", "header") or places[-1] > self._scope[-1][2]:
            self._pop(places[-1])

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            tag = html.find("<", at)
            if tag < 0:
                tag = end
            if tag > at:
                self._say(html[at:tag])
            at, after = tag + 1, html[tag + 1 : tag + 2]
            if after.isascii() and after.isalpha() or after == "/" and html[tag + 2 : tag + 3].isascii() and html[tag + 2 : tag + 3].isalpha():
                found = _TAG.match(html, at)
                if not found:  # the page ends inside a tag
                    return
                name, at = found[2].lower(), found.end()
                if found[1]:
                    self._close(name)
                    continue
                self._start(name, found[3])
                if name in RAW:
                    close = _END[name].search(html, at)
                    if not close:
                        return
                    at = html.find(">", close.end()) + 1 or end
            elif html.startswith("!--", at):
                close = at + 3 if html.startswith((">", "->"), at + 3) else html.find("-->", at + 3)
                at = html.find(">", close) + 1 if close >= 0 else end
            elif after in ("!", "?", "/"):
                at = html.find(">", at) + 1 or end
            elif tag < end:
                self._say("<")

    def _say(self, text: str) -> None:
        self._pieces.append((self._open[-1], unescape(text) if "&" in text else text, self._link >= 0))

    # ---- what is the article

    def text(self) -> str:
        """Blocks of the best container, one a line."""
        n, parent = len(self.tag), self.parent
        chars, links, articles = [0] * n, [0] * n, [0] * n
        for _, pieces in self.blocks:
            for node, text, linked in pieces:
                size = len(text) - text.count(" ")
                chars[node] += size
                links[node] += size * linked
        own = list(chars)
        for i in range(n - 1, 0, -1):
            never, _, _, _ = self.kind[i]
            articles[i] += self.tag[i] in ("article", "main") and not never
            for sums in (chars, links, articles):
                sums[parent[i]] += sums[i]
        gone = self._gone(own, chars, links, articles)

        kept, score, size, linked = [], [0.0] * n, [0] * n, [0] * n
        for node, pieces in self.blocks:
            stay = [x for x in pieces if not gone[x[0]]]
            text = " ".join("".join(t for _, t, _ in stay).split())
            if not text:
                continue
            kept.append((node, text))
            size[node] += len(text)
            linked[node] += min(len(text), sum(len(t) for _, t, a in stay if a))
            points, up = min(len(text) / 25, 1) + len(_COMMA.findall(text)) + min(len(text) // 100, 3), node
            if self.tag[node] in PARAGRAPH:
                up = parent[node]
            for k in range(6):  # the parent all, its parent half, those above a third of a half, and so on
                if up < 0:
                    break
                score[up] += points / (1 if k == 0 else 2 if k == 1 else 3 * k)
                up = parent[up]
        if not kept:
            return ""
        for i in range(n - 1, 0, -1):
            size[parent[i]] += size[i]
            linked[parent[i]] += linked[i]
        dense = [b / a if a else 0.0 for a, b in zip(size, linked, strict=True)]
        for i in range(n):
            if size[i] and self.tag[i] not in HEADING:
                score[i] = (score[i] + (25 if self.tag[i] in ("article", "main") else 10 if self.kind[i][3] and self.tag[i] not in ("body", "html") else 0)) * (1 - dense[i])
        best = max((i for i in range(n) if size[i] and (self.tag[i] not in PARAGRAPH or self.tag[i] in ("td", "li", "dd"))), key=lambda i: (score[i], -i), default=0)
        up, holder = best, -1
        while up >= 0:
            if self.tag[up] == "article" or self.tag[up] == "main" and holder < 0:
                holder = up
            up = parent[up] if holder < 0 or self.tag[holder] != "article" else -1
        whole = self._with_siblings(best if holder < 0 else holder, score, size, dense, kept)
        inside = [False] * n
        for i in range(n):
            inside[i] = i in whole or parent[i] >= 0 and inside[parent[i]]
        return "\n".join(text for node, text in kept if inside[node])

    def _gone(self, own: list[int], chars: list[int], links: list[int], articles: list[int]) -> list[bool]:
        """Of each node whether it is left out: by its kind, unless it holds the article, and lists that are all links."""
        n = len(self.tag)
        gone, framed = [False] * n, [False] * n

        def holds_all(i: int) -> bool:
            return articles[0] > 0 and articles[i] == articles[0]

        for i in range(1, n):
            up, (never, _, comment, _) = self.parent[i], self.kind[i]
            framed[i] = framed[up] or self.tag[i] in ("article", "main")
            named = never and self.tag[i] != "body" and (comment or not (holds_all(i) or chars[i] > 0.9 * chars[0]))
            gone[i] = gone[up] or named or self.tag[i] in DROPPED
        left = [0 if g else c for g, c in zip(gone, own, strict=True)]  # what is only rarely not the article is measured against the rest
        for i in range(n - 1, 0, -1):
            left[self.parent[i]] += left[i]
        for i in range(1, n):
            tag, up, rarely = self.tag[i], self.parent[i], self.kind[i][1]
            if left[i] > 0.5 * left[0] or tag == "body":
                rarely = False
            elif rarely:
                rarely = not (holds_all(i) or tag in ("article", "main") or tag == "header" and framed[up])
            elif tag in ("ul", "ol"):
                rarely = links[i] > 0.9 * chars[i] > 0
            gone[i] = gone[i] or gone[up] or rarely
        return gone

    def _with_siblings(self, top: int, score: list[float], size: list[int], dense: list[float], kept: list[tuple[int, str]]) -> set[int]:
        """top, the headings right before it, and its siblings that score like it or read like it."""
        out, up = {top}, self.parent[top]
        if up < 0:
            return out
        texts: dict[int, list[str]] = {}
        for node, text in kept:
            while node >= 0 and self.parent[node] != up:
                node = self.parent[node]
            if node >= 0:
                texts.setdefault(node, []).append(text)
        near = sorted(texts)
        for i in reversed([i for i in near if i < top]):
            if self.tag[i] not in HEADING or dense[i] > 0.5:
                break
            out.add(i)
        for i in near:
            same = self.tag[i] == self.tag[top] if self.tag[top] in ("article", "main") else True
            if i == top or not same or dense[i] >= 0.25:
                continue
            if self.tag[i] in PARAGRAPH:
                like = self.tag[top] not in ("article", "main") and (size[i] > 80 or self.tag[up] != "body" and texts[i][-1][-1:] in ".!?")
            else:
                like = score[i] >= max(10, 0.2 * score[top]) or same and self.tag[top] not in ("article", "main") and self.tag[up] != "body" and any(len(t) > 80 for t in texts[i])
            if like:
                out.add(i)
        return out


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one line feed; empty for a page without one."""
    return Page(html).text() if html else ""


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages without their html, and out, the main text of each whole page, and n_chars, its code points.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments and hidden parts go, by element, role, and the
    words of class and id; what holds the article stays whatever it is called. Each block of what is left gives points
    for length and commas to the containers above it, all, half, a sixth...; containers are discounted by their share of
    linked text; the best, or the article or main element that it is in, is kept with like siblings and the headings before it. Within a block, white
    space is one space. Null, empty and broken pages give what they hold, empty text if nothing. Equal pages give equal
    texts; columns named out and n_chars are replaced. Work is linear in a page's length, and a worker holds a few MB of
    pages at once.
    """
    rest = [f for f in pages.schema.fields if f.name not in (html, out, "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, len(rest)):
                texts = [main_text(x.as_py()) for x in part.column(len(rest))]
                cols = [*part.columns[: len(rest)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=[*(f.name for f in rest), out, "n_chars"])

    return pages.select(*[pages[f.name] for f in rest], pages[html]).mapInArrow(run, T.StructType([*rest, T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())]))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    first = held = 0
    for i, x in enumerate(batch.column(column)):
        size = len(x.as_buffer()) if x.is_valid else 0
        if held and held + size > SLICE:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)
