"""Main text of web pages by consensus host paths.

Every page's containers are scored by the text of their own blocks against its links.  A container votes
for its generalised tag-class path (digits become N) on its host; Spark sums the votes of all pages of a host,
and the pages are extracted again from the elements on the winning path.  A page without such an element
falls back on its own best container, then on its body.

Inside the container, menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments go, by tag or by class, id and role tokens; a compound of a token and a word of the text's own stays.  Character references are decoded, white
space inside a block becomes one space, blocks are joined by one line feed.

Null and empty html: an empty text.  Markup that never closes is closed where its parent ends.  Of paths with equal votes
the last by name wins; repeated rows each give their row and their vote; other columns of pages are not read.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import beside

#: A quote means a quoted value right after an equals sign only; elsewhere it is a character of a name or value.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: Tags of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
DROPPED = frozenset("script style noscript template iframe svg nav header footer aside form button select textarea input label menu dialog head title object embed canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article main section div body td center".split())
#: Tags that an opening tag of the key closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Where closing stops.
SCOPE = frozenset("html body article main section div td th table ul ol dl nav aside header footer form blockquote".split())
#: Tokens of class, id and role that mark what is no article.
JUNK = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar side rail widget widgets footer "
    "header masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comments comment disqus respond replies reply pagination pager skip copyright legal disclaimer search complementary contentinfo".split()
)


#: Words that mark no article in any compound, and words of compounds that say nothing of what is inside.
CLEAR = frozenset("adsense advert adverts advertisement advertising breadcrumb breadcrumbs sidebar navbar navigation cookie cookies consent gdpr newsletter disqus pagination footer sponsored".split())
PLAIN = frozenset("a area article articles bar block blocks body bottom box button buttons col column container content count element entry form global group head heading holder icon icons inner item items js label left link links list main module outer page panel post posts primary right row secondary section site slot stories story sub title top unit wrap wrapper zone".split())


def _marks(token: str, inside: bool) -> bool:
    """Whether a token of a class, id or role marks what is no article: a word of JUNK, or a compound of such and words that say nothing.

    `share-price` is text, `share-buttons` is not.  A header inside the article itself is its own.
    """
    parts = [x for x in re.split(r"[^a-z]+", token) if x]
    found = JUNK.intersection(parts)
    if inside:
        found -= {"header", "masthead"}
    return bool(found) and (bool(CLEAR.intersection(parts)) or all(x in JUNK or x in PLAIN for x in parts))


def _junk(tag: str, attrs: str, inside: bool = False) -> bool:
    if tag in DROPPED:
        return True
    if not attrs.strip() or tag in ("html", "body", "article", "main"):
        return "hidden" in attrs.split() if attrs else False
    for k, a, b, c in _ATTR.findall(attrs):
        if k.lower() in ("class", "id", "role") and any(_marks(x, inside) for x in entities.unescape(a or b or c).lower().split()):
            return True
        if k.lower() == "style" and re.search(r"display\s*:\s*none", a or b or c, re.I):
            return True
    return False


def _step(tag: str, attrs: str) -> str:
    """Tag with its classes, digits generalised."""
    if "class" not in attrs:
        return tag
    for k, a, b, c in _ATTR.findall(attrs):
        if k.lower() == "class":
            return ".".join([tag, *sorted({re.sub(r"\d+", "N", x).replace("/", "_") for x in (a or b or c).split()})])
    return tag


class Page:
    """Nodes (parent, tag, number of path, junk) and text blocks (node, text, letters inside links) of one page.

    A path is a number, known by the number of the path above it and its last step, so that deep pages stay small.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.junk, self.inside = [-1], [""], [0], [False], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(-1, "")]
        self.blocks: list[tuple[int, str, int]] = []
        stack, text, linked, inlink = [0], [], 0, 0
        owner, at, n = 0, 0, len(source)

        def flush():
            nonlocal linked
            if text:
                own = " ".join(entities.unescape("".join(text)).split())
                if own:
                    self.blocks.append((owner, own, linked))
                text.clear()
            linked = 0

        while at < n:
            m = _TOKEN.search(source, at)
            start = m.start() if m else n
            if start > at and not self.junk[stack[-1]]:
                piece = source[at:start]
                if not text:
                    owner = next(x for x in reversed(stack) if self.tag[x] in BLOCK or x == 0)
                text.append(piece)
                if inlink:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            tag = (m[1] or "").lower()
            if not tag:
                continue
            if source[m.start() + 1] == "/":
                if tag == "a":
                    inlink = max(0, inlink - 1)
                if tag in BLOCK:
                    flush()
                for i in range(len(stack) - 1, 0, -1):
                    own = self.tag[stack[i]]
                    if own == tag:
                        del stack[i:]
                        break
                    if own in SCOPE and tag not in SCOPE:
                        break
                continue
            if tag in BLOCK:
                flush()
                closes = CLOSES.get(tag, ()) + (("p",) if tag != "br" else ())
                for i in range(len(stack) - 1, 0, -1):
                    own = self.tag[stack[i]]
                    if own in closes:
                        del stack[i:]
                        break
                    if own in SCOPE and own not in closes:
                        break
            if tag in VOID or m[2].endswith("/") and tag not in RAW:
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if tag == "a":
                inlink += 1
            top = stack[-1]
            self.parent.append(top)
            self.tag.append(tag)
            self.path.append(self._path(self.path[top], _step(tag, m[2])) if tag in BLOCK else self.path[top])
            self.junk.append(self.junk[top] or _junk(tag, m[2], self.inside[top]))
            self.inside.append(self.inside[top] or tag in ("article", "main"))
            stack.append(len(self.tag) - 1)
        flush()

    def _path(self, above: int, step: str) -> int:
        own = self.paths.setdefault((above, step), len(self.steps))
        if own == len(self.steps):
            self.steps.append((above, step))
        return own

    def _written(self, path: int) -> str:
        out = []
        while path:
            path, step = self.steps[path]
            out.append(step)
        return "".join(f"/{x}" for x in reversed(out))

    def _known(self, path: str) -> int | None:
        """Number of a written path, if the page has it."""
        at: int | None = 0
        for step in path.split("/")[1:]:
            at = self.paths.get((at, step))
            if at is None:
                return None
        return at

    def votes(self) -> dict[str, float]:
        """Score of each container path: a block's text counts for its container, half for the next one out, less for links."""
        score: dict[int, float] = {}
        for node, text, linked in self.blocks:
            worth = (len(text) - 2 * linked) * (1.0 if len(text) >= 40 or text[-1:] in ".!?" else 0.3) + 10 * text.count(",")
            share = 1.0
            while node > 0 and share > 0.2:
                if self.tag[node] in CONTAINER:
                    score[node] = score.get(node, 0.0) + worth * share
                    share /= 2
                node = self.parent[node]
        out: dict[int, float] = {}
        for node, s in score.items():
            if self.tag[node] in ("article", "main"):
                s *= 1.5
            out[self.path[node]] = max(out.get(self.path[node], 0.0), s)
        return {self._written(p): s for p, s in out.items()}

    def best(self) -> tuple[str, float]:
        votes = self.votes()
        return max(votes.items(), key=lambda v: (v[1], v[0])) if votes else ("", 0.0)

    def text(self, path: str | None) -> str:
        """Blocks under the elements on path, else under the page's best container, else all."""
        for written in (path, None, "") if path else (None, ""):
            own = self._known(self.best()[0] if written is None else written)
            if own is None:
                continue
            inside = [False] * len(self.tag)
            for i in range(len(self.tag)):
                inside[i] = self.path[i] == own or i > 0 and inside[self.parent[i]]
            found = [t for node, t, _ in self.blocks if inside[node]]
            if found:
                return "\n".join(found)
        return ""


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: the container path with most votes of each host; a page's vote is its score's share, so no page outweighs another."""

    def vote(batches):
        for b in batches:
            rows: list[tuple[str, str, float]] = []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                votes = Page(source or "").votes()
                total = sum(max(0.0, v) for v in votes.values())
                rows += [(host, p, v / total) for p, v in votes.items() if v > 0]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.float64()))], ["host", "path", "score"])

    votes = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(vote, "host string, path string, score double")
    summed = votes.groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("score", "path")).alias("path"))


def extract(pages: DataFrame, paths: DataFrame) -> DataFrame:
    """page_id, url, text for every row of pages(page_id, url, html)."""

    def read(batches):
        for b in batches:
            texts = [Page(x).text(p) if x else "" for x, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", F.col("html").cast("string"), host_of(F.col("url")).alias("host"))
    rows = beside(rows, paths, "host", how="left").select("page_id", "url", "html", "path")  # one path a host: the pages stay where they are
    return rows.mapInArrow(read, pages.select("page_id", "url").schema.add("text", "string"))
