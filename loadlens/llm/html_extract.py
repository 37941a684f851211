"""Main text of web pages by site style trees."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import small_batches, write_table
from loadlens.session import as_lookup

_BLOCKS = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends an open element of these kinds.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_RAW = "script|style|noscript|template|textarea|svg|math|iframe|object|canvas|video|audio|xmp"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])[^>]*/>|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-z!?][^<>]*(?:>|(?=<)|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements and name parts that stand for no content, and for content, before any page is seen.
_NOISE_TAGS = frozenset("nav header footer aside form head button select menu dialog fieldset search".split())
_NOISE_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright discussion "
    "disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo related "
    "reply responses search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
_MAIN_TAGS = frozenset(("article", "main"))
#: Elements that hold the page or the article: their names never make them boilerplate.
_WHOLE_TAGS = frozenset(("article", "body", "html", "main"))
#: A name that begins so tells a state of its element, not what it is.
_STATES = frozenset("has is js no not on with without".split())
#: What may follow the kind in a name without changing it.
_HOLDERS = frozenset("area bar block body box container content footer form group header holder inner item items link links list panel row section slot thread top unit widget wrap wrapper".split())
_MAIN_NAMES = frozenset("article content entry main post story".split())

#: Pages whose weight the tree of all hosts has against the tree of one host.
BACKOFF_PAGES = 50
#: Weight of a node's own presentation against the content below it.
PRESENTATION = 0.1
KEEP_ABOVE = 0.5


def _kind(name: str) -> int:
    """-1 for a name of boilerplate, 1 of content, 0 for any other.

    A name of several parts is what its last part says (``site-footer``), or
    its first one before a mere holder (``comment-list``).
    """
    parts = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    if not parts or parts[0] in _STATES:
        return 0
    while len(parts) > 1 and parts[-1] in _HOLDERS and parts[-1] not in _NOISE_NAMES:
        parts.pop()
    return -1 if parts[-1] in _NOISE_NAMES else 1 if parts[-1] in _MAIN_NAMES else 0


def _role(tag: str, names: list[str]) -> int:
    """-1 for boilerplate by kind, 1 for content, 0 where only the pages can tell.

    A name of content on an element outweighs one of boilerplate.
    """
    if tag in _NOISE_TAGS:
        return -1
    kinds = {_kind(word) for n in names for word in n.split()}
    if tag in _MAIN_TAGS or 1 in kinds:
        return 1
    return -1 if -1 in kinds and tag not in _WHOLE_TAGS else 0


def blocks_of(page: str) -> list[tuple[str, int, str]]:
    """(path of block elements, role, text) of a page's text blocks in page order.

    Tolerates unclosed and stray tags. The role is -1 inside boilerplate by
    kind, even within the article, 1 inside the article, else 0. Blocks
    without text are left out.
    """
    found: list[tuple[str, int, str]] = []
    stack: list[tuple[str, str, int]] = []  # tag, path, role
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                path, role = (stack[-1][1], stack[-1][2]) if stack else ("", 0)
                found.append((path, role, text))

    def close_to(i: int) -> None:
        if any(tag in _BLOCKS for tag, _, _ in stack[i:]):
            flush()
        del stack[i:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            buffer.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if m[2]:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if i is not None:
                close_to(i)
            elif tag in _BLOCKS:
                flush()
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                buffer.append(" ")
            continue
        if tag in _BLOCKS:
            flush()
            # A new block ends an open paragraph; a new cell, row or list item its neighbour.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in _ENDS.get(tag, ()):
                    close_to(i)
                    break
                if stack[i][0] in _BLOCKS:
                    break
        path, role = (stack[-1][1], stack[-1][2]) if stack else ("", 0)
        if tag in _BLOCKS:
            names = [a or b or c for a, b, c in _NAME.findall(m[4])] if m[4] else []
            own = _role(tag, names)
            # A header inside the article holds its title; all other boilerplate stays so.
            if tag == "header" and role == 1 and own == -1 and not names:
                own = 0
            role = -1 if role == -1 or own == -1 else max(role, own)
            key = ".".join([tag, *sorted(re.sub(r"\d+", "0", n) for n in names)])
            path = f"{path}/{key}"
        if not m[4].endswith("/"):
            stack.append((tag, path, role))
    if at < len(page):
        buffer.append(html.unescape(page[at:]))
    flush()
    return found


def _log_share(k: str, m: str):
    """log of k to the base m; 0 where there is one page only."""
    return F.when(F.col(m) > 1, F.log(F.col(k)) / F.log(F.col(m))).otherwise(F.lit(0.0))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, importance) of every node of the merged trees.

    Pages of a host are merged by path. A leaf's content importance is 1 less
    the mean entropy of its blocks' texts over the host's pages: a text on all
    pages has entropy 1, one on a single page 0. A node's presentation
    importance is the entropy of its pages' child sequences. A node combines
    both, the content over all leaves below it; the tree of all hosts backs
    up hosts of few pages. ``pages`` has page, host, html.
    """
    small_batches(pages.sparkSession, 200)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for host, page in zip(pdf["host"], pdf["html"]):
                blocks = blocks_of(page)
                seen = {(p, xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))) for p, role, t in blocks if role == 0}
                rows += [(host, p, np.uint64(h).astype(np.int64), False) for p, h in seen]
                children: dict[str, list[str]] = {}
                for p, role, _ in blocks:
                    steps = p.split("/")
                    for i in range(1, len(steps)):
                        below = children.setdefault("/".join(steps[:i]), [])
                        if not below or below[-1] != steps[i]:
                            below.append(steps[i])
                rows += [
                    (host, p, np.uint64(xxhash.xxh64_intdigest("/".join(c))).astype(np.int64), True) for p, c in children.items() if p
                ]
            yield pd.DataFrame(rows, columns=["host", "path", "feature", "style"])

    marks = pages.select("host", "html").mapInPandas(run, "host string, path string, feature long, style boolean")
    counted = write_table(marks.groupBy("host", "path", "feature", "style").agg(F.count(F.lit(1)).alias("k")), "marks")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("m"))
    everywhere = sizes.agg(F.sum("m").alias("m")).first()[0] or 0

    def level(found: DataFrame, host: str) -> DataFrame:
        leaves = found.where("NOT style").select(host, "path", (F.col("k") * _log_share("k", "m")).alias("h"), F.col("k").alias("w"))
        above = F.transform(
            F.sequence(F.lit(2), F.size(F.split("path", "/"))), lambda i: F.array_join(F.slice(F.split("path", "/"), 1, i), "/")
        )
        content = leaves.select(host, F.explode(above).alias("path"), "h", "w").groupBy(host, "path").agg((1 - F.sum("h") / F.sum("w")).alias("content"))
        styles = found.where("style").withColumn("n", F.lit(1.0))
        total = styles.groupBy(host, "path").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.log("k")).alias("klog"), F.first("m").alias("m"))
        spread = F.when(F.col("all") > 1, (F.log("all") - F.col("klog") / F.col("all")) / F.log("all")).otherwise(F.lit(1.0))
        shape = total.select(host, "path", spread.alias("shape"))
        both = content.join(shape, [host, "path"], "left")
        mixed = (1 - PRESENTATION) * F.col("content") + PRESENTATION * F.coalesce(F.col("shape"), F.col("content"))
        return both.select(host, "path", mixed.alias("importance"))

    own = level(counted.join(sizes, "host"), "host").join(sizes, "host")
    merged = counted.groupBy("path", "feature", "style").agg(F.sum("k").alias("k")).withColumn("m", F.lit(everywhere)).withColumn("site", F.lit("*"))
    whole = level(merged, "site").select("path", F.col("importance").alias("overall"))
    m, c = F.col("m"), F.lit(float(BACKOFF_PAGES))
    return own.join(whole, "path").select("host", "path", ((m * F.col("importance") + c * F.col("overall")) / (m + c)).alias("importance"))


def site_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages``: its main text, blocks joined by a newline.

    A block inside boilerplate by kind (menus, footers, adverts, ...) goes; a
    block inside the article stays; any other block stays if every node above
    it has an importance over ``KEEP_ABOVE`` in its site's style tree. NULL
    html is empty and gives empty text, a NULL url is a site of its own,
    repeated rows give repeated rows.
    """
    small_batches(pages.sparkSession, 200)
    whole = pages.select("page_id", "url", site_of().alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    low = style_tree(whole.select("host", "html")).where(F.col("importance") <= KEEP_ABOVE)
    per_host = as_lookup(low.groupBy("host").agg(F.array_join(F.collect_set("path"), "\n").alias("low")))
    joined = whole.join(per_host, "host", "left").select("page_id", "url", "html", F.coalesce("low", F.lit("")).alias("low"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for page, low_paths in zip(pdf["html"], pdf["low"]):
                out = set(low_paths.split("\n")) if low_paths else set()
                kept = []
                for path, role, text in blocks_of(page):
                    if role == 0 and out:
                        steps = path.split("/")
                        role = -1 if any("/".join(steps[:i]) in out for i in range(2, len(steps) + 1)) else 0
                    if role >= 0:
                        kept.append(text)
                texts.append("\n".join(kept))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    return joined.mapInPandas(run, "page_id long, url string, text string")
