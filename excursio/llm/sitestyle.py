"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a style node stands for all elements with the same path of
tags (with their class or id) from the body. It knows how many pages have it, how its children are
arranged on them, and how often each block of text occurs in it. Menus, notices and other
templates look and read the same on many pages; articles don't. A node's importance is made of entropies:

- presentation: ``-sum p log_m p`` over the arrangements of children (m pages; 1 for a single page);
- content: ``1 - mean(log_m c)`` over its blocks, where a block occurs on ``c`` of the ``m`` pages;
- an inner node: ``(1 - g**l) * presentation + g**l * sum p_i importance(child_i)``, l children, g = 0.9.

A branch all of whose nodes are below a threshold is removed from every page. Elements whose tag or name says
what they are don't wait for evidence: scripts, navigation, forms, comments and the like always go. A node that is,
or is inside, ``article`` or ``main`` gets a bonus to its importance; the tree decides over it like over the others.

Pages are parsed twice: once for the statistics, once for the text. In between only counts of hashes
are shuffled, so a host with a third of all pages is summed up in parallel.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.llm import workers
from excursio.shared import write_shared

#: Elements without content, elements that never hold the article, and those that do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video head title".split())
NEVER = RAW | frozenset("nav header footer aside form button select textarea menu dialog option label fieldset".split())
ALWAYS = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: What ends an open ``p`` and what ends an open element of the same kind.
CLOSES_P = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr option optgroup legend summary".split())
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table div article section main body".split())
#: Words in a class or id that name what an element is for.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "respond replies disqus pagination pager toolbar widget skip copyright".split()
)
#: Words that say an element has, or hasn't, something of that kind beside its content.
WITH = frozenset("has have no with without".split())
GAMMA = 0.9
LEAST_IMPORTANCE = 0.3
#: What being an article, or inside one, adds to a node's importance.
BONUS = 0.15
#: Below so many pages a host's statistics say nothing.
LEAST_PAGES = 5
#: Elements nested deeper than this belong to the style node at this depth.
DEPTH = 24

_WORD = re.compile(r"[^\W\d_]+")


class _Page(HTMLParser):
    """Blocks of a page with their style nodes, and the arrangement of children of each node."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []  # style, text
        self.children: dict[str, list[str]] = {}
        # (tag, style, removed); removed elements and all inside are left out.
        self._open: list[tuple[str, str, bool]] = [("", "", False)]
        self._text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._close_within("p", "button")
        if tag in SIBLINGS:
            for k in range(len(self._open) - 1, 0, -1):
                if self._open[k][0] in SIBLINGS[tag]:
                    self._pop(k)
                elif self._open[k][0] in SCOPES:
                    break
        if tag == "br":
            self._text.append("\n")
            return
        if tag in VOID:
            if tag in BLOCKS:
                self._end_block()
            return
        _, style, removed = self._open[-1]
        if tag not in BLOCKS and tag not in NEVER:
            self._open.append((tag, style, removed))
            return
        self._end_block()
        names = {w.lower() for k, v in attrs if k in ("class", "id", "role") and v for w in _WORD.findall(v)}
        own = ".".join([tag, *sorted(names)])
        below = style + "/" + own if style.count("/") < DEPTH else style
        removed = removed or self._unwanted(tag, names, "/article" in style)
        if not removed:
            self.children.setdefault(style, []).append(own)
        self._open.append((tag, below, removed))

    @staticmethod
    def _unwanted(tag, names, inside):
        if tag == "header" or names & NAMES == {"header"}:
            return not inside  # the header of an article has its title
        return tag in NEVER or (tag != "main" and names.isdisjoint(WITH) and not names.isdisjoint(NAMES))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k][0] == tag:
                self._pop(k)
                return
            # An unmatched inline end tag doesn't close blocks.
            if tag not in BLOCKS and tag not in NEVER and self._open[k][0] in BLOCKS:
                return
        if tag in ("p", "br"):
            self._end_block()

    def _close_within(self, tag, scope):
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k][0] == tag:
                self._pop(k)
                return
            if self._open[k][0] in BLOCKS or self._open[k][0] == scope:
                return

    def _pop(self, k):
        if any(tag in BLOCKS or tag in NEVER for tag, *_ in self._open[k:]):
            self._end_block()
        del self._open[k:]

    def handle_data(self, data):
        if not self._open[-1][2]:
            self._text.append(data)

    def _end_block(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                _, style, _ = next(x for x in reversed(self._open) if x[0] in BLOCKS or x[0] == "")
                self.blocks.append((style, text))

    def finish(self):
        self.close()
        self._end_block()
        return self


def parsed(html: str | None) -> _Page:
    page = _Page()
    if html:
        page.feed(html)
    return page.finish()


def _ancestors(style: str):
    while style:
        yield style
        style = style.rpartition("/")[0]
    yield ""


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _observed(batches):
    """Per page: a signature of its kept content, its style nodes, arrangements and blocks."""
    for batch in batches:
        out = {k: [] for k in ("host", "page", "facts")}
        for host, html in zip(batch["host"].tolist(), batch["html"].tolist()):
            page = parsed(html)
            facts = [{"style": s, "kind": 0, "value": _hash("\0".join(c))} for s, c in page.children.items()]
            facts += [{"style": s, "kind": 1, "value": v} for s, v in sorted({(s, _hash(t)) for s, t in page.blocks})]
            present = {"", *page.children, *(a for s, _ in page.blocks for a in _ancestors(s))}
            facts += [{"style": s, "kind": 2, "value": 0} for s in sorted(present)]
            out["host"].append(host)
            out["page"].append(_hash("\0".join(f"{s}\1{t}" for s, t in page.blocks)))
            out["facts"].append(facts)
        yield pd.DataFrame(out)


def _marked(style: str) -> bool:
    return any(part.split(".")[0] in ALWAYS for part in style.split("/"))


def _weak_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """Style nodes of one host whose importance, and that of all nodes below, is low: one row with all of them.

    ``rows`` has a row per style node: pages, entropy of its arrangements, mean ``log_m c`` and number of its blocks.
    """
    node = {s: (p, e, c, b) for s, p, e, c, b in zip(rows["style"], rows["pages"], rows["entropy"], rows["content"], rows["blocks"])}
    below: dict[str, list[str]] = {}
    for style in node:
        if style:
            parent = style.rpartition("/")[0]
            below.setdefault(parent, []).append(style)
    importance: dict[str, float] = {}
    for style in sorted(node, key=lambda s: -s.count("/")):
        pages, entropy, content, blocks = node[style]
        children = [c for c in below.get(style, []) if c in importance]
        parts = []
        if blocks:
            parts.append((1 - content, pages))
        if children:
            total = sum(node[c][0] for c in children)
            inner = sum(node[c][0] / total * importance[c] for c in children)
            weight = GAMMA ** len(children)
            parts.append(((1 - weight) * entropy + weight * inner, total))
        importance[style] = sum(a * w for a, w in parts) / sum(w for _, w in parts) if parts else 1.0
    low: set[str] = set()
    for style, x in importance.items():  # from the leaves up
        alike = all(c in low for c in below.get(style, []))
        if style and alike and x + BONUS * _marked(style) < LEAST_IMPORTANCE and node[style][0] >= LEAST_PAGES:
            low.add(style)
    weak = sorted(s for s in low if not any(a in low for a in list(_ancestors(s))[1:]))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "weak": [weak]})


def host_of(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def style_trees(pages: DataFrame) -> DataFrame:
    """For each host (``host``) the style nodes to remove (``weak``); hosts without any are left out.

    Equal pages of a host count once. Only hashes are counted; what comes together for a host is one row
    for each of its style nodes.
    """
    workers.ready(pages.sparkSession)
    observed = pages.where(F.col("host").isNotNull()).select("host", "html").mapInPandas(
        _observed, "host string, page long, facts array<struct<style:string,kind:int,value:long>>"
    )
    facts = observed.dropDuplicates(["host", "page"]).select("host", F.explode("facts").alias("fact")).select("host", "fact.*")
    counts = write_shared(facts.groupBy("host", "style", "kind", "value").agg(F.count(F.lit(1)).alias("c")), "styles")
    arrangement, block, presence = (F.col("kind") == k for k in (0, 1, 2))
    nodes = counts.groupBy("host", "style").agg(
        F.max(F.when(presence, F.col("c"))).alias("pages"),
        F.coalesce(F.sum(F.when(arrangement, F.col("c"))), F.lit(0)).alias("arranged"),
        F.sum(F.when(arrangement, F.col("c") * F.ln("c"))).alias("arrangement_logs"),
        F.coalesce(F.avg(F.when(block, F.ln("c"))), F.lit(0.0)).alias("block_log"),
        F.count_if(block).alias("blocks"),
    )
    several = F.col("pages") > 1
    n = F.col("arranged")
    described = nodes.select(
        "host",
        "style",
        "pages",
        F.when(several & (n > 0), (F.ln(n) - F.col("arrangement_logs") / n) / F.ln("pages")).otherwise(1.0).alias("entropy"),
        F.when(several, F.col("block_log") / F.ln("pages")).otherwise(0.0).alias("content"),
        "blocks",
    )
    weak = described.groupBy("host").applyInPandas(_weak_nodes, "host string, weak array<string>")
    return weak.where(F.size("weak") > 0)


def _extracted(batches):
    for batch in batches:
        out = []
        for html, weak in zip(batch["html"].tolist(), batch["weak"].tolist()):
            gone = frozenset(weak) if weak is not None else frozenset()
            out.append("\n".join(t for s, t in parsed(html).blocks if not gone or gone.isdisjoint(_ancestors(s))))
        yield batch[["page_id", "url"]].assign(text=out)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page: ``page_id``, ``url``, ``text``, ``n_chars``.

    Character references are decoded, white space within a block becomes one space, blocks are
    joined by a line break. Null, empty and broken HTML give what text there is, or none. Pages without
    a host (null or odd addresses) are judged by their own elements only. Repeated rows are kept;
    an empty table gives an empty result; other columns aren't used.
    """
    workers.ready(pages.sparkSession)
    held = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    trees = write_shared(style_trees(held), "trees")
    texts = held.join(trees, "host", "left").select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "weak").mapInPandas(
        _extracted, "page_id string, url string, text string"
    )
    return texts.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
