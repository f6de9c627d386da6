"""Main text of web pages, with a style tree of each site.

Pages of one host are merged: elements with the same path (tags, classes and ids from the
root) are one node of the site's tree. Two importances, both entropies to the base of the
number of pages m that have the node, are computed over all pages of the host:

* content: a text that stands in all pages alike has entropy 1 over the pages, one that is
  in a single page has 0; the importance is one less the mean over the node's texts;
* presentation: the entropy of the child sequences seen under the node. A menu or a notice
  looks the same everywhere, an article does not.

A leaf is removed if its content and the presentation of its parent are both of low
importance, or if its own text is: one less the entropy of that text over the pages, if it
stands on half (``COMMON``) of the pages with that node. This holds inside ``article`` and ``main`` as outside. They are a prior only: on a page with text
in them, a leaf outside is removed below ``OUTSIDE`` and not only below ``threshold``.
Copies of an article are still articles, so pages of a host with the same body (the text in
``article`` or ``main``, or else all text) count as one page together.

Elements that are no text (``BOILERPLATE``) are removed in any case. Class and role tokens
that name other parts (``NOISE``) are a prior the tree can refute: where the children
of such a node, without repeats, differ from page to page like those of an article
(``REFUTED``), its text is judged as any other. Ids count only outside ``article`` and
``main``, where they are no anchors, and never on headings. A name does not reach into a
``main`` below it, nor may names alone take all the ``article`` text of a page.

The trees are counts: (host, node, text) rows are added up where they are read and
shuffled as sums, so a host with a third of all pages is no group in any task. What comes
back to the pages is, per host, the list of its low nodes and texts, whose nodes were seen on
``min_pages`` pages or more, and of its refuted names. It is sent to all tasks if there are at most
``BROADCAST_NODES`` of them, and joined by host otherwise.

Defined cases: null and empty html give the empty text; a null or odd url is the host "";
unclosed elements end with their parent; text after an unclosed comment or script is not
shown, as browsers do; repeated pages are pages.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from flowlake.session import scratch_path

#: Elements that are never main text.
BOILERPLATE = frozenset(
    "head script style noscript template iframe object svg canvas nav header footer aside form menu dialog button select "
    "option textarea input fieldset datalist map".split()
)
#: Whole tokens of class, id or role that mark other parts of a page.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment "
    "comments disqus reply replies pagination pager toolbar search complementary contentinfo "
    "ad-box ad-banner ad-container ad-slot cookie-banner cookie-consent cookie-notice site-header site-footer site-nav main-nav "
    "nav-menu page-header page-footer side-bar share-buttons social-share related-posts related-articles comment-list "
    "comments-section newsletter-signup search-form".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements without content, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Elements that end an open one of the second kind inside the third.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ARTICLE = frozenset(["article", "main"])
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<[!?][^>]*>"
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
MARKS = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[A-Za-z]+")
#: Low nodes and texts of all hosts, or bodies with copies, 16 bytes each, that are sent to all tasks at most.
BROADCAST_NODES = 1_000_000
#: Below this a leaf outside a page's article or main is removed; from this presentation on a name is refuted.
OUTSIDE, REFUTED = 0.4, 0.8
#: Share of the pages with its node on which a text stands that is low by itself.
COMMON = 0.5
STYLE, TEXT, NAMED = 0, 1, 2
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass(eq=False)
class Node:
    tag: str
    path: str
    noise: bool
    inside: bool
    #: Paths of the elements around it, or itself, that a name marks.
    named: tuple[str, ...] = ()
    children: list[str] = field(default_factory=list)


@dataclass
class Leaf:
    """A block of text, with its place in the tree."""

    text: str
    node: str
    parent: str
    inside: bool
    named: tuple[str, ...] = ()


def number(*parts: str) -> int:
    """A signed 64-bit number for a node or a text."""
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


#: Tells what is low for leaves outside an article or main from what is low for all.
FURTHER = number("outside")


def read_page(page: str) -> tuple[list[Leaf], list[Node]]:
    """The text blocks outside marked boilerplate, in order, and the container elements."""
    root = Node("", "", False, False)
    stack, leaves, closed, pending, at = [root], [], [root], [], 0

    def flush() -> None:
        if pending:
            parts: dict[tuple[str, ...], list[str]] = {}
            for named, part in pending:
                parts.setdefault(named, []).append(part)
            pending.clear()
            block = next(n for n in reversed(stack) if n.tag in BLOCKS or not n.tag)
            parent = stack[max(0, stack.index(block) - 1)]
            for named, part in parts.items():
                text = " ".join(entities.unescape("".join(part)).split())
                if text:
                    leaves.append(Leaf(text, block.path, parent.path, block.inside, named))

    def pop_to(index: int) -> None:
        del stack[index:]

    def open_at(tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in until:
                return None
        return None

    size = len(page)
    while at < size:
        found = MARKUP.search(page, at)
        start = found.start() if found else size
        if start > at and not stack[-1].noise:
            pending.append((stack[-1].named, page[at:start]))
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if tag in BLOCKS or tag == "br":
                flush()
            index = open_at({tag}, frozenset())
            if index is not None:
                pop_to(index)
            continue
        attributes = found[3] if found[2] else found[6]
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?![A-Za-z0-9])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCKS:
            flush()
            if tag in SIBLINGS:
                index = open_at(*SIBLINGS[tag])
            else:
                index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCKS), None)
                index = index if index is not None and stack[index].tag == "p" else None
            if index is not None:
                pop_to(index)
        elif tag == "br":
            pending.append((stack[-1].named, " "))
        parent = stack[-1]
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        marks = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in MARKS.finditer(attributes)]
        words = sorted({w for _, value in marks for w in NAME.findall(value)})
        noise = parent.noise or tag in BOILERPLATE and not (tag == "header" and parent.inside)
        if tag in ("html", "body"):
            noise = False
        anchor = parent.inside or tag in ARTICLE or tag in HEADINGS
        tokens = {token for kind, value in marks if kind != "id" or not anchor for token in value.split()}
        marked = not noise and tag not in ("html", "body", "main") and not NOISE.isdisjoint(tokens)
        container = tag in BLOCKS or bool(words)
        path = f"{parent.path}>{tag}{'.'.join(['', *words])}" if container else parent.path
        if len(path) > 500:  # a deep path by its number, so that depth costs no room
            path = f"#{number(path)}"
        named = () if tag == "main" else (*parent.named, path) if marked and path not in parent.named else parent.named
        node = Node(tag, path, noise, parent.inside or tag in ARTICLE and not noise, named)
        if container and not noise:
            if not marked:
                parent.children.append(tag)
            closed.append(node)
        stack.append(node)
    flush()
    return leaves, closed


def page_counts(page: str) -> list[tuple[int, int, int, int, bool]]:
    """(kind, node, feature, times, first of its node) for the texts, child sequences and named elements of a page."""
    leaves, nodes = read_page(page)
    texts = Counter((number("text", leaf.node), number(leaf.text)) for leaf in leaves)
    styles = Counter((number("style", node.path), number(*node.children)) for node in nodes if node.children)
    names = Counter(
        (number("named", node.path), number(*[tag for tag, _ in groupby(node.children)])) for node in nodes if node.named and node.named[-1] == node.path
    )
    out, seen = [], set()
    for kind, counted in ((TEXT, texts), (STYLE, styles), (NAMED, names)):
        for (node, feature), n in counted.items():
            out.append((kind, node, feature, n, node not in seen))
            seen.add(node)
    return out


def body_number(host: str, page: str) -> int:
    """A number for the host and the body of a page."""
    leaves = [leaf for leaf in read_page(page)[0] if not leaf.named]
    return number("body", host, *([leaf.text for leaf in leaves if leaf.inside] or [leaf.text for leaf in leaves]))


def judged(page: str, low: set[int]) -> tuple[list[str], int]:
    """The texts of a page that stay, and how many leaves the tree removed."""
    leaves, _ = read_page(page)
    left = [leaf for leaf in leaves if all(number("named", path) in low for path in leaf.named)]
    left = left or [leaf for leaf in leaves if leaf.inside]
    marked = any(leaf.inside for leaf in left)
    keep = []
    for leaf in left:
        prior = FURTHER if marked and not leaf.inside else 0
        node = number("text", leaf.node)
        own = node ^ number(leaf.text) ^ prior in low
        if not own and not (node ^ prior in low and number("style", leaf.parent) ^ prior in low):
            keep.append(leaf.text)
    return keep, len(left) - len(keep)


def main_text(page: str, low: set[int]) -> str:
    return "\n".join(judged(page, low)[0])


def with_host(pages: DataFrame, url: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), HOST, 1))
    return pages.withColumn("__host", host)


def counts(pages: DataFrame, url: str = "url", html: str = "html", copies: DataFrame | None = None, least: float = math.inf) -> DataFrame:
    """Sums of every node of every host; texts on ``least`` pages or more have rows of their own (``feature``).

    ``copies`` has the bodies (``__body``) that ``n`` pages share; each of these counts as 1 / n page."""
    rows = with_host(pages, url).select(F.col("__host").alias("host"), F.col(f"`{html}`").cast("string").alias("html")).filter("html is not null")
    if copies is None:
        rows = rows.withColumn("w", F.lit(1.0))
    else:
        rows = rows.withColumn("__body", body_of("host", "html")).join(copies, "__body", "left")
        rows = rows.select("host", "html", (1 / F.coalesce("n", F.lit(1))).alias("w"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(host, w, *row) for host, page, w in zip(*(c.to_pylist() for c in batch.columns)) for row in page_counts(page)]
            columns = list(zip(*found)) or [[]] * 7
            kinds = (pa.string(), pa.float64(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "w", "kind", "node", "feature", "n", "first"])

    counted = rows.mapInArrow(count, "host string, w double, kind tinyint, node bigint, feature bigint, n bigint, first boolean")
    features = counted.groupBy("host", "kind", "node", "feature").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), F.sum(F.col("w") * F.col("n") * F.log(F.col("n").cast("double"))).alias("n_log_n"),
        F.sum("w").alias("on"), F.sum(F.when(F.col("first"), F.col("w")).otherwise(0.0)).alias("first"),
    )
    # Entropy of each text over the pages, and of the node's features over their pages.
    spread = F.greatest(F.col("n") * F.log("n") - F.col("n_log_n"), F.lit(0.0))
    own = F.when((F.col("kind") == TEXT) & (F.col("on") >= least), F.col("feature"))
    return features.groupBy("host", "kind", "node", own.alias("feature")).agg(
        F.sum("first").alias("pages"), F.sum("n").alias("n"), F.sum(spread).alias("spread"),
        F.sum(F.greatest(F.col("on") * F.log("on"), F.lit(0.0))).alias("on_log_on"), F.sum("on").alias("on"),
    )


def node_importances(counted: DataFrame) -> DataFrame:
    nodes = counted.groupBy("host", "kind", "node").agg(
        F.round(F.sum("pages"), 6).alias("pages"), *[F.sum(c).alias(c) for c in ("n", "spread", "on_log_on", "on")],
    )
    scale = F.log(F.greatest(F.col("pages"), F.lit(2.0)))
    return nodes.select(
        "host", "kind", "node", "pages",
        (1 - F.col("spread") / F.col("n") / scale).alias("content"),
        ((F.log("on") - F.col("on_log_on") / F.col("on")) / scale).alias("presentation"),
    )


def importances(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, is_text, node, pages, content, presentation) of every text, style and named node of every host."""
    found = node_importances(counts(pages, url, html))
    return found.select("host", (F.col("kind") == TEXT).alias("is_text"), "node", "pages", "content", "presentation")


@F.pandas_udf(LongType())
def body_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for host, page in batches:
        yield pd.Series([body_number(h, p) for h, p in zip(host.tolist(), page.tolist())], dtype="int64")


def sent(small: DataFrame, purpose: str, schema: str) -> tuple[DataFrame, bool]:
    """The table, stored, and whether it is small enough to be sent to all tasks."""
    path = scratch_path(small.sparkSession, purpose)
    small.write.parquet(path)
    stored = small.sparkSession.read.schema(schema).parquet(path)
    return stored, stored.count() <= BROADCAST_NODES


def low_nodes(pages: DataFrame, url: str, html: str, threshold: float, min_pages: int) -> tuple[DataFrame, bool]:
    """(host, node): low nodes and texts, and refuted names; and whether they are few."""
    spark = pages.sparkSession
    rows = with_host(pages, url).select("__host", F.col(f"`{html}`").cast("string").alias("html")).filter("html is not null")
    copies = rows.groupBy(body_of("__host", "html").alias("__body")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies, few = sent(copies, "page-copies", "__body bigint, n bigint")
    # A text on fewer pages cannot be low: its entropy is at most the logarithm of their number.
    least = min_pages ** (1 - max(threshold, OUTSIDE)) - 1e-6
    counted = counts(pages, url, html, F.broadcast(copies) if few else copies, least)
    path = scratch_path(spark, "style-trees")
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    nodes = node_importances(counted).filter(F.col("pages") >= min_pages)
    importance = F.when(F.col("kind") == TEXT, F.col("content")).otherwise(F.col("presentation"))
    of_nodes = nodes.filter(F.col("kind") != NAMED).select("host", "node", importance.alias("importance"), F.lit(1.0).alias("on"))
    scale = F.log(F.greatest(F.col("pages"), F.lit(2.0)))
    texts = counted.filter("feature is not null").drop("pages").join(nodes.filter(F.col("kind") == TEXT).select("host", "node", "pages"), ["host", "node"])
    of_texts = texts.select("host", F.col("node").bitwiseXOR(F.col("feature")).alias("node"), (1 - F.col("spread") / F.col("n") / scale).alias("importance"), (F.col("on") / F.col("pages")).alias("on"))
    judged = of_nodes.unionByName(of_texts)
    refuted = nodes.filter((F.col("kind") == NAMED) & (F.col("presentation") >= REFUTED))
    low = judged.filter((F.col("importance") < threshold) & (F.col("on") >= COMMON)).select("host", "node")
    further = judged.filter(F.col("importance") < OUTSIDE).select("host", F.col("node").bitwiseXOR(F.lit(FURTHER)).alias("node"))
    return sent(low.unionByName(further).unionByName(refuted.select("host", "node")), "low-nodes", "host string, node bigint")


def extract(pages: DataFrame, url: str = "url", html: str = "html", threshold: float = 0.2, min_pages: int = 5) -> DataFrame:
    """The rows of ``pages`` with their main ``text`` and its length ``n_chars``."""
    low, few = low_nodes(pages, url, html, threshold, min_pages)
    low = low.groupBy("host").agg(F.collect_set("node").alias("__low")).withColumnRenamed("host", "__host")
    low = F.broadcast(low) if few else low

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, nodes in batches:
            out = [main_text(p, set(n)) if p else "" for p, n in zip(page.tolist(), nodes.tolist())]
            yield pd.Series(out, dtype=object)

    joined = with_host(pages, url).join(low, "__host", "left")
    nodes = F.coalesce("__low", F.array().cast("array<bigint>"))
    found = joined.withColumn("text", text_of(F.col(f"`{html}`").cast("string"), nodes))
    return found.withColumn("n_chars", F.length("text").cast("bigint")).drop("__host", "__low")
