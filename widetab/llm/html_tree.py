"""Main text of web pages: site style tree (operator 9).

Each page is parsed once into blocks (text, path of its elements) and, for
every element on a block's path, its presentation (the sequence of its
children's tags). Pages of one host are merged into a style tree as sums per
(host, path): how pages spread over presentations and over block texts. A leaf
whose texts recur on the host's pages has high text entropy and low importance;
an inner element's importance joins its presentation entropy with its
children's importance. Branches whose every node is under ``least`` are cut
from each page of their host. Elements that mark menus, headers, footers, sidebars, notices,
adverts, forms, comments or code by tag, role or class are cut on every page (but not
one that holds the page itself), and where a page marks its main part, or articles
that hold most of its text, text outside goes.

The tree is summed by partial aggregation, so a hot host is one row per path
and feature after each task, and entropies are sums per (host, path); one task
sees a host's paths, not its pages. Paths end at ``MAX_DEPTH`` blocks (deeper ones
share their ancestor's node), so a page's paths grow with its length only.

Defined results: null html is empty and has an empty text; null urls share one
host; hosts with fewer than ``min_pages`` pages at a path have no verdict
there; copies of a page (equal blocks) on a host count as one page of the tree
and each get their text; an empty table gives an empty table; unclosed, cut or stray tags are closed as
far as HTML's rules say; other input columns do not matter.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.llm.common import small_or_shuffled, write_shared

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                   # A quote opens a value only after "="; any other is a character of a name.
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"([a-zA-Z:_-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
# Fixed lists of HTML's elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template svg iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
# Opening one of these ends an open one of these before it, up to the container.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
NOISE_TAGS = frozenset("nav footer button select dialog menu head object canvas audio video map".split())
MARKED_TAGS = frozenset("aside form".split())
#: A class beside one of these speaks of a layout ("no-sidebar", "share-enabled"), not of the element.
SAYS_OF = frozenset("no not has have with without is hide show page layout body".split())
SAYS_STATE = frozenset("enabled disabled on off open closed visible active hidden".split())
MAX_DEPTH = 32
LONG_STEP = 64
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion banner "
    "nav navbar navigation navi menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing shares related recommended recommendations widget widgets comment comments commentlist reply "
    "replies respond disqus discussion pagination pager skip search searchbox".split())
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo "
                         "promotion banner".split())
HEADER_WORDS = frozenset(["header"])
MAIN_IDS = frozenset("main content article main-content maincontent post entry".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in ATTR.finditer(raw)}


def _class_words(at: dict[str, str]) -> set[str]:
    """Lower-case words of the classes and the id, those of layout classes left out."""
    out: set[str] = set()
    for name in [*at.get("class", "").split(), at.get("id", "")]:
        words = [w.lower() for w in WORDS.findall(name)]
        if words and not (len(words) > 1 and (words[0] in SAYS_OF or words[-1] in SAYS_STATE)):
            out.update(words)
    return out


class _Element:
    """An open element: what holds for all inside it is handed down, so nothing
    is looked up along the stack. ``hard`` is noise by HTML's own meaning; ``soft`` the
    number of the nearest block marked as noise by its class, role or tag;
    ``inline`` says that text here is marked within a sentence."""

    __slots__ = ("tag", "step", "path", "depth", "hard", "marked", "soft", "inline", "place", "begins", "kids")

    def __init__(self, tag: str, raw: str, over: _Element | None):
        self.tag, self.kids, self.step = tag, [], tag
        self.place = self.begins = 2 if tag == "article" else 1 if tag == "main" else 0
        in_main = over is not None and over.place > 0
        self.hard = (over is not None and over.hard) or tag in NOISE_TAGS
        self.marked = tag in MARKED_TAGS or (tag == "header" and not in_main)
        if raw and "=" in raw or "hidden" in raw:
            at = _attributes(raw)
            if tag not in ("html", "body"):
                words = _class_words(at)
                self.marked |= bool(words & NOISE_WORDS) or (bool(words & HEADER_WORDS) and not in_main)
                self.hard |= tag not in BLOCK and bool(words & ADVERT_WORDS)
            role = at.get("role", "").lower()
            self.marked |= role in NOISE_ROLES
            if role in ("article", "main") or at.get("id", "").lower() in MAIN_IDS:
                self.place = self.begins = max(self.place, 2 if role == "article" else 1)
            self.hard |= "hidden" in at or at.get("aria-hidden", "").lower() == "true"
            self.hard |= bool(re.search(r"display\s*:\s*none", at.get("style", ""), re.I))
            name = ".".join(sorted({re.sub(r"\d+", "0", c) for c in at.get("class", "").split()}))
            self.step = f"{tag}.{name}" if name else tag
        if len(self.step) > LONG_STEP:
            self.step = f"{tag}.{hashlib.md5(self.step.encode()).hexdigest()}"
        self.path, self.depth, self.soft, self.inline = "", 0, 0, False
        if over is not None:
            self.path, self.depth, self.soft, self.inline = over.path, over.depth, over.soft, over.inline
            self.place = max(self.place, over.place)
        if tag in BLOCK:
            self.depth += 1
            if self.depth <= MAX_DEPTH:                     # deeper blocks share their ancestor's place in the tree
                self.path = f"{self.path}>{self.step}" if self.path else self.step


def parse(page: str) -> tuple[list[tuple[str, str, int]], list[tuple[str, str]]]:
    """(blocks, elements) of a page without noise. A block is (path, text, place):
    place 2 is inside an article, 1 inside main, 0 elsewhere. An element is (path,
    its children's steps without repeats).

    A mark (class, role, form, aside, header) makes a block noise unless it holds the
    page itself: more than half of its text and every article, main or h1 there is
    (for a form its text is enough). A marked word within a sentence stays, other
    than an advert; a block of marked words only goes. Articles are the page if they hold most of
    its text, else its main part is, else all blocks are left to the tree."""
    blocks: list[tuple[str, str, int, int]] = []
    elements: list[tuple[str, str, int]] = []
    stack: list[_Element] = []
    open_tags: Counter[str] = Counter()
    over_of, tag_of = [0], [""]                             # of each marked block: the one around it, its tag
    begun: list[tuple[str, int]] = []                       # places and h1, with the marked block they are in
    text: list[tuple[str, bool]] = []
    pos, size = 0, len(page)

    def flush() -> None:
        if not text:
            return
        got = " ".join(html_lib.unescape("".join([t for t, _ in text])).split())
        plain = any(not marked and t.strip() for t, marked in text)
        text.clear()
        if got and plain:
            top = stack[-1] if stack else None
            blocks.append((top.path, got, top.place, top.soft) if top else ("", got, 0, 0))

    def add(part: str) -> None:
        if not stack:
            text.append((part, False))
        elif not stack[-1].hard:
            text.append((part, stack[-1].inline))

    def close(k: int) -> None:
        """Pop elements from place k on."""
        while len(stack) > k:
            e = stack.pop()
            open_tags[e.tag] -= 1
            if e.kids and e.tag in BLOCK and not e.hard and e.depth <= MAX_DEPTH:
                elements.append((e.path, " ".join(e.kids), e.soft))

    while pos < size:
        m = TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        if m.start() > pos:
            add(page[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            if open_tags[tag]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                    if tag not in BLOCK and stack[k].tag in BLOCK:
                        break                               # a stray inline end tag ends no block
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, pos)
            if not m[0].endswith("/>"):
                pos = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                add(" ")
            continue
        if tag in BLOCK:
            flush()
            for k in range(len(stack) - 1, -1, -1):         # a block ends an open paragraph
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
            ended, within = ENDS.get(tag, ((), ()))
            if any(open_tags[t] for t in ended):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in ended:
                        close(k)
                    elif stack[k].tag in within:
                        break
        over = stack[-1] if stack else None
        e = _Element(tag, m[3] or "", over)
        if e.marked and not e.hard:
            if tag in BLOCK:
                over_of.append(e.soft)
                tag_of.append(tag)
                e.soft = len(over_of) - 1
            else:
                e.inline = True
        if e.begins or tag == "h1":
            begun.append(("h1" if tag == "h1" and not e.begins else "place", e.soft))
        if tag in BLOCK and e.depth <= MAX_DEPTH:
            up = next((x for x in reversed(stack) if x.tag in BLOCK), None)
            if up is not None and (not up.kids or up.kids[-1] != e.step):
                up.kids.append(e.step)
        if not (m[0].endswith("/>") and tag not in BLOCK):
            stack.append(e)
            open_tags[tag] += 1
    flush()
    close(0)
    # What each marked block holds, from the innermost out.
    held, inside = [0] * len(over_of), [Counter() for _ in over_of]
    for _, got, _, soft in blocks:
        held[soft] += len(got)
    for kind, soft in begun:
        inside[soft][kind] += 1
    for i in range(len(over_of) - 1, 0, -1):
        held[over_of[i]] += held[i]
        inside[over_of[i]].update(inside[i])
    whole = inside[0]
    noise = [False] * len(over_of)
    for i in range(1, len(over_of)):
        kind = "place" if whole["place"] else "h1"
        page_itself = 2 * held[i] > held[0] and (tag_of[i] == "form" or whole[kind] and inside[i][kind] == whole[kind])
        noise[i] = noise[over_of[i]] or not page_itself
    left = [(path, got, place) for path, got, place, soft in blocks if not noise[soft]]
    length = lambda some: sum(len(b[1]) for b in some)
    articles = [b for b in left if b[2] == 2]
    if 2 * length(articles) > length(left):
        left = articles
    elif any(b[2] == 1 for b in left):
        left = [b for b in left if b[2]]
    return left, [(path, kids) for path, kids, soft in elements if not noise[soft]]


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", url or "")
    return m[1].lower() if m else ""


PARSED = ("page_id {kind}, url string, host string, blocks array<struct<path: string, text: string>>, "
          "elements array<struct<path: string, style: string>>")


def parsed_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, host, its blocks and its elements' presentations."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    block = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
    element = pa.list_(pa.struct([("path", pa.string()), ("style", pa.string())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                got = [parse(h) for h in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array([host_of(u) for u in b.column("url").to_pylist()], pa.string()),
                     pa.array([[{"path": p, "text": t} for p, t, _ in x] for x, _ in got], block),
                     pa.array([[{"path": p, "style": s} for p, s in y] for _, y in got], element)],
                    names=["page_id", "url", "host", "blocks", "elements"])
    return src.mapInArrow(run, PARSED.format(kind=src.schema["page_id"].dataType.simpleString()))


def _weighed(parsed: DataFrame) -> DataFrame:
    """``parsed`` with each row's share of a distinct page of its host:
    ``text_share`` among rows of equal blocks, ``style_share`` among those of
    equal blocks and elements. Only hashes of pages with copies are joined."""
    hashed = parsed.withColumns({"bh": F.xxhash64("blocks"), "eh": F.xxhash64("elements")})
    equal = write_shared(hashed.groupBy("host", "bh", "eh").agg(F.count("*").alias("rows")), "html-equal")
    several = equal.groupBy("host", "bh").agg(F.sum("rows").alias("all")).filter("all > 1")
    copies = equal.join(small_or_shuffled(write_shared(several, "html-several"), 120), ["host", "bh"]).select(
        F.col("host").alias("chost"), F.col("bh").alias("cbh"), F.col("eh").alias("ceh"), "all", "rows")
    copies = small_or_shuffled(write_shared(copies, "html-copies"), 120)
    same = (F.col("host") == F.col("chost")) & (F.col("bh") == F.col("cbh")) & (F.col("eh") == F.col("ceh"))
    return hashed.join(copies, same, "left").select(
        "host", "blocks", "elements", (F.lit(1.0) / F.coalesce("all", F.lit(1))).alias("text_share"),
        (F.lit(1.0) / F.coalesce("rows", F.lit(1))).alias("style_share"))


def node_features(parsed: DataFrame) -> DataFrame:
    """Per (host, path): pages m, style entropy (base m), text entropy (mean over its block texts)."""
    page = _weighed(parsed).withColumn("row", F.monotonically_increasing_id())
    # Shares of copies sum to whole pages.
    pages = lambda share: F.round(F.sum(share)).cast("bigint")
    texts = page.select("host", "row", "text_share", F.explode("blocks").alias("b")).select(
        "host", "row", "text_share", F.col("b.path").alias("path"), F.xxhash64("b.text").alias("f"))
    leaf_pages = texts.select("host", "path", "row", "text_share").distinct().groupBy("host", "path").agg(
        pages("text_share").alias("m"))
    n_ln_n = F.col("n") * F.log(F.greatest("n", F.lit(1)).cast("double"))
    # A text on n of the node's m pages has entropy ln n / ln m; texts weigh by n. Both sides are sums per node.
    sums = texts.groupBy("host", "path", "f").agg(pages("text_share").alias("n")).groupBy("host", "path").agg(
        F.sum(n_ln_n).alias("nln"), F.sum("n").alias("n")) \
        .select(F.col("host").alias("shost"), F.col("path").alias("spath"), "nln", "n")
    m = F.col("m").cast("double")
    leaf = leaf_pages.join(sums, (F.col("host") == F.col("shost")) & (F.col("path") == F.col("spath"))).select(
        "host", "path", "m", F.when((F.col("m") > 1) & (F.col("n") > 0), F.least(F.lit(1.0), F.col("nln") / F.log(m) / F.col("n")))
        .otherwise(0.0).alias("text_entropy"))
    # An element's presentations: pages that show each (all of a page's elements at that path together).
    # With m pages, −Σ p ln p is ln m − (Σ n ln n) / m.
    shown = page.select("host", "row", "style_share", F.explode("elements").alias("e")).select(
        "host", "row", "style_share", F.col("e.path").alias("path"), "e.style").groupBy("host", "path", "row").agg(
        F.xxhash64(F.sort_array(F.collect_set("style"))).alias("s"), F.first("style_share").alias("style_share"))
    style = shown.groupBy("host", "path", "s").agg(pages("style_share").alias("n")).groupBy("host", "path").agg(
        F.sum("n").alias("m"), F.sum(n_ln_n).alias("nln")).select(
        "host", "path", "m", F.when(F.col("m") > 1, 1.0 - F.col("nln") / m / F.log(m)).otherwise(1.0).alias("style_entropy"))
    return leaf.select("host", "path", "m", "text_entropy", F.lit(None).cast("double").alias("style_entropy")).unionByName(
        style.select("host", "path", "m", F.lit(None).cast("double").alias("text_entropy"), "style_entropy")) \
        .groupBy("host", "path").agg(F.max("m").alias("m"), F.max("text_entropy").alias("text_entropy"),
                                     F.max("style_entropy").alias("style_entropy"))


def importances(nodes: pd.DataFrame, damp: float = 0.9) -> pd.DataFrame:
    """Composite importance of one host's nodes, from the leaves up: a leaf's is
    1 − text entropy; an inner node's weighs its style entropy with its
    children's mean by damp ** children; own text counts as one child.
    ``highest`` is the largest importance of the node and its descendants."""
    paths = {r.path: r for r in nodes.itertuples()}
    kids: dict[str, dict[str, None]] = {}
    every = set(paths)
    for p in paths:
        while ">" in p:
            up = p.rsplit(">", 1)[0]
            if p in kids.setdefault(up, {}):
                break                                        # and so all above it
            kids[up][p] = None
            every.add(up)
            p = up
    value: dict[str, float] = {}
    highest: dict[str, float] = {}
    for p in sorted(every, key=lambda x: -x.count(">")):
        r = paths.get(p)
        parts = [value[k] for k in kids.get(p, [])]
        if r is not None and not math.isnan(r.text_entropy if r.text_entropy is not None else math.nan):
            parts.append(1.0 - r.text_entropy)
        below = sum(parts) / len(parts) if parts else 1.0
        style = r.style_entropy if r is not None and r.style_entropy is not None and not math.isnan(r.style_entropy) else None
        weight = damp ** max(1, len(parts))
        value[p] = below if style is None or not kids.get(p) else (1 - weight) * style + weight * below
        # A page's own text counts by itself, not only as a part of its element.
        highest[p] = max([value[p], *parts[len(kids.get(p, [])):], *[highest[k] for k in kids.get(p, [])]])
    out = nodes[["host", "path", "m"]].copy()
    out["importance"] = [value[p] for p in out["path"]]
    out["highest"] = [highest[p] for p in out["path"]]
    return out


def low_branches(parsed: DataFrame, least: float = 0.2, min_pages: int = 8) -> DataFrame:
    """(host, low): paths of each host whose importance, and that of all their
    descendants, is under ``least``."""
    def of_host(pdf: pd.DataFrame) -> pd.DataFrame:
        got = importances(pdf)
        low = got[(got["highest"] < least) & (got["m"] >= min_pages)]
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "low": [list(low["path"])]}) if len(low) else \
            pd.DataFrame({"host": pd.Series([], dtype=str), "low": pd.Series([], dtype=object)})
    return node_features(parsed).groupBy("host").applyInPandas(of_host, "host string, low array<string>")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              least: float = 0.2, min_pages: int = 8) -> DataFrame:
    """Per page: page_id, url, text (blocks joined by a blank line), n_chars."""
    parsed = write_shared(parsed_pages(pages, page_id, url, html), "html-pages", "zstd")
    low = write_shared(low_branches(parsed, least, min_pages).withColumnRenamed("host", "lhost"), "html-low")
    # A row is a host's list of paths: its bytes are counted before it is broadcast.
    size = low.agg(F.sum(F.length(F.array_join("low", ",")) + 200)).first()[0] or 0
    joined = parsed.join(F.broadcast(low) if size <= 64 << 20 else low, F.col("host") == F.col("lhost"), "left")
    under = lambda path: F.exists(F.coalesce("low", F.array().cast("array<string>")),
                                  lambda p: (path == p) | path.startswith(F.concat(p, F.lit(">"))))
    kept = F.filter("blocks", lambda b: ~under(b["path"]))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    return joined.select(F.col("page_id").alias(page_id), F.col("url").alias(url), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))
