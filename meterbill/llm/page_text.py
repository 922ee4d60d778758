"""Main text of web pages: page structure, and a host suffix array where the structure is silent.

A page that marks its main content (``article``, ``main``, ``role=main``, ``itemprop=articleBody``) is taken at its word:
the blocks inside it, without nested navigation, asides, forms, adverts, notices, sharing bars and comments.  On a page
without such marks, everything in the body that is no such element is a candidate, and boilerplate is found by
a suffix array over the host: all candidate token streams of the host's pages are concatenated, suffixes are
sorted by their first ``RUN`` tokens, and neighbours that agree in them and come from distinct pages are long
repeated substrings.  A run is boilerplate if it recurs on a ``SHARE`` of the host's distinct pages and on ``LEAST_PAGES`` at least;
near copies of a page (five-word shingles, similarity 0.8) count as one, so an article under several urls keeps its text.
Blocks whose tokens such runs cover (``COVERED`` of them) are removed, unique runs are kept.

An element is furniture by its name, its role, being hidden, or a class or id all of whose words name furniture or its
place (``ad-box``, ``reader-comments``); one word among others (``share-price``, ``menu-design``) or a heading's id is no reason.

The suffix array alone gives wrong texts where articles share paragraphs (syndicated text, licence
lines): see the README for how much it would remove.  So on marked pages the host's array is built over both sides of the marks:
a run that recurs inside them and in the host's furniture (what the marks and names leave out) as well names a block, and an exact
check of the markup follows: the block goes if an element around it, inside the marks, has a furniture word among others
in its class or id (``promo-strip``).  Neither a recurring text nor such a word is enough by itself.

Scale: the array is never whole.  A suffix is a row (host, digest of its first RUN tokens, page); sorting and
comparing neighbours is a partial aggregate per (host, digest), so a host with a third of all pages is dealt over
all tasks.  Every page is parsed once, in time linear in its length, and written; unmarked pages' candidate tokens are
shuffled, of marked pages the furniture's suffixes, and of their main content those that a Bloom filter of repeated furniture lets through.

Defined cases: NULL or empty html gives an empty text; a page without a host (NULL url, no scheme) is compared with no other; pages of equal
content count as one page when runs are compared, so repeated rows keep their texts; unclosed elements end with their
parent; a quote that never ends is no quote, and from a tag that no ``>`` ends outside quotes, quotes count no more; texts are handled
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.llm import ngram_join
from meterbill.llm.common import chunks, map_chunks, stored
from meterbill.llm.wordhash import run_hashes, word_hashes
from meterbill.operators.membership import key_filter

RUN = 8
COVERED = 0.7
SHARE = 0.1
LEAST_PAGES = 3

# Element names of HTML by role, and words in class or id attributes that name page furniture.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = {"head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "math", "iframe", "object", "canvas",
           "select", "button", "dialog", "menu", "audio", "video", "map", "datalist", "applet", "fieldset"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
          "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
          "caption", "legend"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "banners", "breadcrumb",
             "breadcrumbs", "comment", "comments", "disqus", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
             "popup", "modal", "overlay", "menu", "menus", "nav", "navbar", "navigation", "sidebar", "sidebars", "footer", "masthead",
             "newsletter", "subscribe", "subscription", "signup", "login", "promo", "promotion", "sponsor", "sponsored", "share",
             "sharing", "social", "related", "recommended", "recommendations", "toolbar", "widget", "widgets", "skip", "pagination",
             "pager", "outbrain", "taboola", "paywall", "alert", "topbar", "searchbox", "search"}
HEADERS = {"header", "topheader", "siteheader", "pageheader"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "toolbar", "form"}

# Words that say where furniture stands or what holds it; with FURNITURE they make up a furniture name.
PLACES = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "center", "col", "column",
          "container", "content", "desktop", "fixed", "form", "global", "google", "group", "head", "header", "holder", "icon", "icons", "inner",
          "item", "items", "js", "left", "link", "links", "list", "main", "message", "mobile", "module", "more", "news", "outer", "page", "panel",
          "post", "posts", "primary", "reader", "readers", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "stories",
          "story", "text", "title", "tools", "top", "unit", "user", "users", "wrap", "wrapper"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS_ITS_KIND = {"p", "li", "dd", "dt", "tr", "td", "th", "option"}
SEEN_THROUGH = {"b", "i", "em", "strong", "span", "a", "u", "font", "small", "td", "th", "p"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*+)", re.S)
# the rest of a tag: a quote counts after an equals sign; nothing is tried twice, so a page is read in linear time
TAG_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _furniture(name: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is page furniture; ``inside``: within marked main content."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    if name in ("html", "body", "main") or name in HEADINGS:
        return False
    for token in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        parts = {p.lower() for p in NAME_PARTS.findall(token)}
        if parts & FURNITURE and parts <= FURNITURE | PLACES or not inside and parts & HEADERS and parts <= HEADERS | PLACES:
            return True
    return False


def _doubtful(name: str, attrs: dict[str, str]) -> bool:
    """Whether a class or id has a furniture word, alone or among others."""
    if name in ("html", "body", "main") or name in HEADINGS:
        return False
    return any(p.lower() in FURNITURE for p in NAME_PARTS.findall(attrs.get("class", "") + " " + attrs.get("id", "")))


def _judged(name: str, inner: str) -> tuple[bool, bool, bool, bool]:
    """(marks main content, is furniture within marked content, is furniture elsewhere, may be furniture) of a start tag."""
    attrs = _attributes(inner) if inner and not inner.isspace() else {}
    marks = name in ("article", "main") or attrs.get("role", "").lower() == "main" or attrs.get("itemprop") == "articleBody"
    return marks, _furniture(name, attrs, True), _furniture(name, attrs, False), _doubtful(name, attrs)


_judged_before = lru_cache(4096)(_judged)       # pages repeat their tags; long ones are not held


def parse(source: str | None) -> tuple[bool, list[str]]:
    """(main content is marked, blocks of text): of the marked content, or else of all that is no furniture."""
    return parse_sides(source)[:2]


def parse_sides(source: str | None) -> tuple[bool, list[str], list[str], list[int]]:
    """``parse``, the other blocks of text (furniture, and what is outside the marked content), and which blocks of marked
    content stand in an element that may be furniture."""
    main: list[str] = []
    rest: list[str] = []
    furniture_: list[str] = []
    doubted: list[int] = []                     # which blocks of the marked content may be furniture
    open_: list[tuple[str, bool, bool, bool]] = []      # element, it is furniture, it marks main content, it may be furniture in it
    at_name: dict[str, list[int]] = {}          # where in open_ the elements of a name are
    opaque: list[int] = []                      # where those are that an element's implied end does not look through
    dropped: list[int] = []                     # where the furniture is
    marked = doubts = 0
    found = False
    held: list[str] = []
    left: list[str] = []                        # what is held of furniture

    def text_of(parts: list[str]) -> str:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        return text

    def flush() -> None:
        if held and (block := text_of(held)):
            if marked and doubts:
                doubted.append(len(main))
            (main if marked else rest).append(block)

    def flush_left() -> None:
        if left and (block := text_of(left)):
            furniture_.append(block)

    def close(depth: int) -> None:
        nonlocal marked, doubts
        while len(open_) > depth:
            name, was_furniture, was_main, was_doubtful = open_.pop()
            at_name[name].pop()
            if name not in SEEN_THROUGH:
                opaque.pop()
            if was_furniture:
                dropped.pop()
            marked -= was_main
            doubts -= was_doubtful

    at, source = 0, source or ""
    end, last, quotes = len(source), source.rfind(">"), True
    while at < end:
        m = TOKEN.search(source, at)
        (left if dropped else held).append(source[at:m.start() if m else end])
        if not m:
            break
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA[") and not dropped:
                held.append(entities.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if at > last:                           # no tag ends any more
            if not dropped:
                held.append(source[m.start():])
            break
        tail = TAG_REST.match(source, at) if quotes else None
        if tail:
            inner, at = tail[1], tail.end()
        else:
            quotes = False
            gt = source.find(">", at)
            inner, at = source[at:gt], gt + 1
        name, closing = m[2].lower(), bool(m[1])
        if name == "br":
            (left if dropped else held).append(" ")
            continue
        if name in BLOCKS:
            flush_left()
        if closing:
            if name in BLOCKS and not dropped:
                flush()
            if at_name.get(name):
                close(at_name[name][-1])
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
            gt = source.find(">", stop.start()) if stop else -1
            at = gt + 1 if gt >= 0 else end
            continue
        if name in BLOCKS and not dropped:
            flush()
        marks, inside, elsewhere, doubtful = (_judged_before if len(inner) <= 200 else _judged)(name, inner)
        if dropped and (name == "body" or marks and not marked and not elsewhere):
            # an unclosed menu or header cannot hold the page's main content, nor an unclosed head its body
            close(dropped[0])
        if name in VOID or inner.endswith("/") and name not in BLOCKS:
            continue
        if name in ENDS_ITS_KIND and at_name.get(name) and at_name[name][-1] >= (opaque[-1] if opaque else 0):
            close(at_name[name][-1])            # such an element ends the open one of its kind
        furniture = inside if marked else elsewhere
        marks = marks and not furniture
        at_name.setdefault(name, []).append(len(open_))
        if name not in SEEN_THROUGH:
            opaque.append(len(open_))
        if furniture:
            dropped.append(len(open_))
        doubtful = doubtful and marked > 0
        doubts += doubtful
        open_.append((name, furniture, marks, doubtful))
        if marks:
            marked += 1
            found = found or not dropped
    flush()
    flush_left()
    return found, (main if found else rest), (rest + furniture_ if found else furniture_), doubted if found else []


def host_of():
    """The url's host as a column, lower-cased; NULL without one."""
    host = F.regexp_extract(F.col("url"), r"(?s)^.*?://([^/?#]*)", 1)
    return F.when(host != "", F.lower(host))


def _tokens(blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all blocks, and each token's block."""
    hashes = [word_hashes(b.lower().encode("utf-8", "surrogatepass")) for b in blocks]
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])


def _run_digests(words: np.ndarray, run_length: int) -> np.ndarray:
    """Digests of the first ``run_length`` tokens of every suffix that has as many."""
    start = np.arange(max(0, len(words) - run_length + 1))
    return run_hashes(words, start, start + run_length).view(np.int64) if len(start) else np.zeros(0, np.int64)


def _parsed(pages: DataFrame, run_length: int = RUN) -> DataFrame:
    """page_id, url, host, marked, text, page, outside, doubted: every page parsed; ``page``: digest of its tokens; ``outside``: the distinct
    runs of what a marked page has besides its main content, NULL on others; ``doubted``: its blocks that may be furniture by a name."""
    def one(batch):
        got = [parse_sides(html) for html in batch.column("html").to_pylist()]
        words = [_tokens(b)[0] for _, b, _, _ in got]
        page = [int(run_hashes(w, np.array([0]), np.array([len(w)])).view(np.int64)[0]) if len(w) else None for w in words]
        outside = [np.unique(_run_digests(_tokens(o)[0], run_length)) if m else None for m, _, o, _ in got]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array([m for m, _, _, _ in got], pa.bool_()),
             pa.array(["\n".join(b) for _, b, _, _ in got], pa.string()), pa.array(page, pa.int64()), pa.array(outside, pa.list_(pa.int64())),
             pa.array([d for _, _, _, d in got], pa.list_(pa.int32()))],
            names=["page_id", "url", "host", "marked", "text", "page", "outside", "doubted"])
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of().alias("host"),
                         F.col("html").cast("string").alias("html"))
    return map_chunks(named, one, "page_id long, url string, host string, marked boolean, text string, page long, outside array<long>, "
                      "doubted array<int>", 64)


def _suffixes(streams: DataFrame, run_length: int) -> DataFrame:
    """(host, h, page, family, pos): suffixes of the pages' tokens, by the digest of their first tokens."""
    def run(batches):
        for piece in chunks(batches, 64):
            hosts, cols = [], [[], [], [], []]
            for host, page, family, text in zip(*[c.to_pylist() for c in piece.columns]):
                digests = _run_digests(_tokens(text.split("\n"))[0], run_length)
                n = len(digests)
                hosts += [host] * n
                for c, x in zip(cols, (digests, np.full(n, page), np.full(n, family), np.arange(n, dtype=np.int32))):
                    c.append(x)
            if hosts:
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string())] + [pa.array(np.concatenate(c)) for c in cols],
                                                 names=["host", "h", "page", "family", "pos"])
    return streams.select("host", "page", "family", "text").mapInArrow(run, "host string, h long, page long, family long, pos int")


def boilerplate(parsed: DataFrame, run_length: int = RUN, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(f_host, f_page, runs): where in each unmarked page the runs begin that recur across its host."""
    streams = parsed.filter("not marked and page is not null and host is not null").groupBy("host", "page").agg(F.min("text").alias("text"))
    # near copies of a page, wherever they are, are one family
    alike = ngram_join.components(streams.groupBy(F.col("page").alias("doc_id")).agg(F.min("text").alias("text")), width=5, percent=80)
    streams = stored(streams.join(alike.select(F.col("doc_id").alias("page"), F.col("component_id").alias("family")), "page"), "pages-streams")
    size = streams.groupBy("host").agg(F.count_distinct("family").alias("families"))
    suffixes = _suffixes(streams, run_length)
    repeated = suffixes.groupBy("host", "h").agg(F.count_distinct("family").alias("n")).filter(F.col("n") >= least) \
        .join(size, "host").filter(F.col("n") >= share * F.col("families")).select("host", "h")
    return suffixes.join(repeated, ["host", "h"]).groupBy(F.col("host").alias("f_host"), F.col("page").alias("f_page")) \
        .agg(F.sort_array(F.collect_set("pos")).alias("runs"))


def inserts(parsed: DataFrame, run_length: int = RUN, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(f_host, f_page, runs): where in each marked page's main content the runs begin that recur on a share of the host's
    distinct pages, in their main content and in their furniture as well."""
    marked = parsed.filter("marked and page is not null and host is not null")
    size = marked.groupBy("host").agg(F.count_distinct("page").alias("pages"))

    def recurring(runs: DataFrame, of: str) -> DataFrame:
        often = runs.groupBy("host", "h").agg(F.count_distinct(of).alias("n")).filter(F.col("n") >= least)
        return often.join(size, "host").filter(F.col("n") >= share * F.col("pages")).select("host", "h")

    furniture = stored(recurring(marked.select("host", "page", F.explode("outside").alias("h")), "page"), "pages-furniture")
    streams = marked.select("host", "page", F.lit(0).cast("long").alias("family"), "text")
    known = _suffixes(streams, run_length).filter(key_filter(furniture.select("h"))("h"))
    hits = stored(known.join(furniture, ["host", "h"], "left_semi").select("host", "page", "h", "pos").distinct(), "pages-inserts")
    # only pages with such a run are compared: near copies are one family
    texts = marked.join(hits.select("page").distinct(), "page", "left_semi").groupBy(F.col("page").alias("doc_id")).agg(F.min("text").alias("text"))
    alike = ngram_join.components(texts, width=5, percent=80).select(F.col("doc_id").alias("page"), F.col("component_id").alias("family"))
    both = recurring(hits.join(alike, "page"), "family")
    return hits.join(both, ["host", "h"]).groupBy(F.col("host").alias("f_host"), F.col("page").alias("f_page")) \
        .agg(F.sort_array(F.collect_set("pos")).alias("runs"))


def extract(pages: DataFrame, run_length: int = RUN, covered: float = COVERED, share: float = SHARE,
            least: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text, n_chars, marked, one row per page."""
    parsed = stored(_parsed(pages, run_length), "pages-parsed")

    def cut(batch):
        texts = []
        for text, runs, marked, doubted in zip(*[batch.column(c).to_pylist() for c in ("text", "runs", "marked", "doubted")]):
            if runs and text:
                blocks = text.split("\n")
                words, block = _tokens(blocks)
                over = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    over[r] += 1
                    over[r + run_length] -= 1
                on = np.bincount(block, np.cumsum(over[:-1]) > 0, len(blocks)) / np.maximum(1, np.bincount(block, minlength=len(blocks)))
                gone = on >= covered
                if marked:                      # the markup has the last word on what it marks
                    gone &= np.isin(np.arange(len(blocks)), doubted)
                text = "\n".join(b for b, g in zip(blocks, gone) if not g)
            texts.append(text)
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("marked")],
                                          names=["page_id", "url", "text", "marked"])

    found = inserts(parsed, run_length, share, least).withColumn("f_marked", F.lit(True))
    if not parsed.filter("not marked and page is not null and host is not null").isEmpty():
        found = found.unionByName(boilerplate(parsed, run_length, share, least).withColumn("f_marked", F.lit(False)))
    found = stored(found, "pages-found")      # small where little recurs: then no text is shuffled
    joined = parsed.join(found, (F.col("host") == F.col("f_host")) & (F.col("page") == F.col("f_page")) & (F.col("marked") == F.col("f_marked")), "left")
    rest = map_chunks(joined.select("page_id", "url", "text", "marked", "runs", "doubted"), cut, "page_id long, url string, text string, marked boolean")
    return rest.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "marked")
