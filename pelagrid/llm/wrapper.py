"""Main text of web pages by wrapper induction.

All pages of a host are aligned with one page of that host (of its most common shape)
by simple tree matching: the largest order-preserving match of two element trees with equal
tags, found by dynamic programming over the children. The aligned places are the slots
of the host's wrapper. A slot that shows few different texts over the host's different pages is
template, a slot whose text varies is content; that is counted by Spark over all pages of the
host, as one aggregation by slot and text, so a host of any size is split over tasks. Pages of a host
with the same texts in the same order are copies and count once, so copying a page does not turn
its text into template.

The text of a page is what is neither template nor inside an element that names itself as a
menu, header, footer, sidebar, notice, advert, form or comment; where the page marks an
article or main element, it is that element's part. Layout names around an article do not
reach into it, and a name counts only if it is the element's own (not ``no-sidebar`` or
``entry-header``). Scripts and the like end at their literal end tag. Blocks are runs of text between block
elements, in page order.

Defined results: null or empty html gives empty text; pages without a usable url form one host;
a host needs ``LEAST_PAGES`` different aligned pages before a slot can be template; unclosed and crossed tags are
closed as browsers do for the common cases; elements nested deeper than ``DEEPEST`` hang on the element at that
depth. Repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import html
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import matched, written

LEAST_PAGES = 5
RETURNING = 0.8  # a slot is template if its texts beyond the first are at most the rest of its pages
DEEPEST = 150
BROADCAST_CHARS = 16_000_000  # of all hosts' skeletons; beyond, pages and skeletons are shuffled
BROADCAST_SLOTS = 2_000_000  # template slots of all hosts; beyond, blocks and templates are shuffled
CELLS = 4_000_000  # cells of one alignment table; longer child lists are split in two

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is skipped to their literal end tag, whatever it looks like.
RAW = frozenset("script style noscript textarea template title iframe svg select annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msup msub msubsup msqrt mroot mover munder munderover "
    "mstyle mpadded mphantom menclose mtable mtr mtd".split()
)
# A start tag of the key closes an open element of the set.
_P_ENDERS = (
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul"
).split()
CLOSES = {tag: frozenset({"p"}) for tag in _P_ENDERS} | {
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "body": frozenset({"head"}),
}
# What an implied end tag does not reach across.
SCOPES = frozenset("html body table ul ol dl div article section aside nav main header footer form blockquote".split())

JUNK_TAGS = frozenset("head nav footer aside form button dialog menu object audio video canvas option".split()) | RAW
# Names of elements, an addition to the method: whole class or id tokens, or the last part of a hyphenated
# one. SURE names also count as its first part ("cookie-box"), and inside an article.
SURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored sponsors promo cookie cookies consent gdpr "
    "comment comments reply replies disqus respond related recommended recommendations newsletter subscribe "
    "subscription signup login popup modal breadcrumb breadcrumbs social share sharing pagination pager".split()
)
LAYOUT_NAMES = SURE_NAMES | frozenset(
    "banner banners notice notices alert alerts sidebar sidebars side menu menus nav navbar navigation header masthead "
    "footer overlay widget widgets toolbar skip".split()
)
# First parts after which a name is not the element's own ("no-sidebar"), or is a title's ("entry-header").
NEGATIONS = frozenset("no not has have with without hide hidden".split())
CONTENT_PARTS = frozenset("entry post article story content main page single".split())
COMMENT_NAMES = frozenset("comment comments reply replies".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
MAIN_TAGS, MAIN_ROLES = frozenset({"article", "main"}), frozenset({"main", "article"})

# Inside a tag a quote delimits a value only right after an equals sign.
_PIECE = regex.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([A-Za-z][^\s/>]*)((?>=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?|[^>=])*+)(?:>|\Z)",
    regex.S,
)
_ATTRIBUTE = regex.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'][^\s]*)))?")
_RAW_END = {tag: regex.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", regex.I) for tag in RAW}
SURE, LIKELY = 2, 1  # junk by a tag, a role or a sure name; by a layout name, which an article inside ends


def named_junk(names: str) -> int:
    """What the class and id tokens of an element say about it."""
    found = 0
    for token in names.lower().split():
        parts = [x for x in regex.split(r"[-_]+", token) if x]
        if not parts or (len(parts) > 1 and parts[0] in NEGATIONS):
            continue
        if parts[0] in SURE_NAMES or parts[-1] in SURE_NAMES:
            return SURE
        if parts[-1] in LAYOUT_NAMES and not (parts[-1] == "header" and parts[0] in CONTENT_PARTS):
            found = LIKELY
    return found


class Node:
    """An element: tag, children, whether it is junk or main, and its place in page order."""

    __slots__ = ("tag", "children", "junk", "main", "number", "shape")

    def __init__(self, tag: str, junk: int, main: bool, number: int):
        self.tag, self.children, self.junk, self.main = tag, [], junk, main
        self.number, self.shape = number, -1


Block = tuple[Node, int, str]


def parse(page: str) -> tuple[Node, list[Block]]:
    """The element tree and its text blocks (element, run within it, text) in page order."""
    root = Node("#", 0, False, 0)
    stack, nodes = [root], 1
    pieces: list[tuple[Node, str]] = []
    runs: dict[int, int] = {}
    blocks: list[Block] = []

    def flush():
        if pieces:
            own = pieces[0][0]
            text = " ".join("".join(t for _, t in pieces).split())
            if text:
                k = runs.get(own.number, 0)
                runs[own.number] = k + 1
                blocks.append((own, k, text))
            pieces.clear()

    def holder() -> Node:
        """The innermost open element that is not inline."""
        return next(x for x in reversed(stack) if x.tag not in INLINE)

    at = 0
    while (m := _PIECE.search(page, at)) is not None:
        if m.start() > at:
            pieces.append((holder(), html.unescape(page[at : m.start()])))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        elif tag == "br":
            pieces.append((holder(), " "))
        if m[1]:
            if any(x.tag == tag for x in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k].tag in SCOPES:
                break
        above = stack[-1]
        main = above.main or tag in MAIN_TAGS
        sure = tag in JUNK_TAGS or (tag == "header" and not main)
        junk = SURE if sure else above.junk
        if m[3] and junk < SURE and tag not in ("html", "body"):
            found = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(m[3])}
            role = found.get("role", "").lower()
            names = f"{found.get('class', '')} {found.get('id', '')}"
            main = main or role in MAIN_ROLES
            if role in JUNK_ROLES or "hidden" in found:
                junk = SURE
            elif tag in MAIN_TAGS or role in MAIN_ROLES:
                junk = SURE if COMMENT_NAMES & set(regex.split(r"[\s_-]+", names.lower())) else 0
            else:
                junk = max(junk, named_junk(names))
        elif tag in MAIN_TAGS and junk < SURE:
            junk = 0
        node = Node(tag, junk, main, nodes)
        nodes += 1
        above.children.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    if at < len(page) and not page[at:].startswith("<"):
        pieces.append((holder(), html.unescape(page[at:])))
    flush()
    return root, blocks


# Subtrees of equal shape share a number, so each pair of shapes is matched once.
_shapes: dict[tuple, int] = {}
_parts: list[tuple[str, tuple[int, ...]]] = []
_matched: dict[tuple[int, int], int] = {}
_placed: dict[tuple[int, int], dict[int, int]] = {}


def _shape(root: Node) -> None:
    """Number the shapes of a tree, children first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(node.children)
    for node in reversed(order):
        part = (node.tag, tuple(c.shape for c in node.children))
        if part not in _shapes:
            _shapes[part] = len(_parts)
            _parts.append(part)
        node.shape = _shapes[part]


def _forget() -> None:
    """Keep the tables of shapes from growing without end over many pages."""
    if len(_parts) > 200_000 or len(_matched) > 1_000_000 or len(_placed) > 2_000:
        _shapes.clear(), _parts.clear(), _matched.clear(), _placed.clear(), _reference.cache_clear()


def match(a: int, b: int) -> int:
    """Simple tree matching: elements in the largest match of two shapes."""
    if (a, b) not in _matched:
        (tag_a, under_a), (tag_b, under_b) = _parts[a], _parts[b]
        if tag_a != tag_b:
            _matched[a, b] = 0
        else:
            best = _last_row(under_a, under_b)[-1] if under_a and under_b else 0
            _matched[a, b] = 1 + int(best)
    return _matched[a, b]


def _weights(a, b) -> np.ndarray:
    """Match of every shape in ``a`` with every shape in ``b``."""
    kinds_a, rows = np.unique(a, return_inverse=True)
    kinds_b, columns = np.unique(b, return_inverse=True)
    table = np.array([[match(int(x), int(y)) for y in kinds_b] for x in kinds_a], np.int32)
    return table, rows, columns


def _rows(a, b):
    """Rows of the alignment table, one for each prefix of ``a`` (after the empty one)."""
    table, rows, columns = _weights(a, b)
    before = np.zeros(len(b) + 1, np.int32)
    for x in rows:
        now = before.copy()
        np.maximum(before[1:], before[:-1] + table[x][columns], out=now[1:])
        before = np.maximum.accumulate(now)
        yield before


def _last_row(a, b) -> np.ndarray:
    last = np.zeros(len(b) + 1, np.int32)
    for last in _rows(a, b):
        pass
    return last


def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of the children that the best alignment pairs."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > CELLS:
        half = len(a) // 2
        ahead = _last_row(a[:half], b)
        behind = _last_row(a[half:][::-1], b[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        later = _aligned(a[half:], b[cut:])
        return _aligned(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in later]
    table = np.vstack([np.zeros(len(b) + 1, np.int32), *_rows(a, b)])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        here = table[i, j]
        if here == table[i - 1, j]:
            i -= 1
        elif here == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def align(reference: Node, page: Node) -> dict[int, int]:
    """For elements of ``page`` the number of their place in ``reference``."""
    found, todo = {page.number: reference.number}, [(reference, page)]
    while todo:
        r, p = todo.pop()
        pairs = _aligned([c.shape for c in r.children], [c.shape for c in p.children])
        for i, j in pairs:
            x, y = r.children[i], p.children[j]
            found[y.number] = x.number
            todo.append((x, y))
    return found


@lru_cache(maxsize=64)
def _reference(page: str) -> Node:
    root, _ = parse(page)
    _shape(root)
    return root


def blocks_of(page: str | None, reference: str | None) -> list[tuple[str | None, bool, bool, str]]:
    """(slot, junk, main, text) of each block; slot is its place in the reference, if any."""
    if not page:
        return []
    root, blocks = parse(page)
    places: dict[int, int] = {}
    if reference:
        _forget()
        _shape(root)
        # Elements are numbered in page order, so pages of one shape have the same places.
        other = _reference(reference)
        pair = (other.shape, root.shape)
        places = _placed[pair] if pair in _placed else _placed.setdefault(pair, align(other, root))
    return [
        (f"{places[e.number]}:{k}" if e.number in places else None, e.junk > 0, e.main, text)
        for e, k, text in blocks
    ]


def _block_rows(batches):
    for batch in batches:
        made = [
            blocks_of(p, r)
            for p, r in zip(batch.column("html").to_pylist(), batch.column("reference").to_pylist(), strict=True)
        ]
        flat = [b for page in made for b in page]
        fields = [("slot", pa.string()), ("junk", pa.bool_()), ("main", pa.bool_()), ("text", pa.string())]
        entries = pa.StructArray.from_arrays(
            [pa.array([b[k] for b in flat], kind) for k, (_, kind) in enumerate(fields)], [n for n, _ in fields]
        )
        offsets = np.concatenate([[0], np.cumsum([len(page) for page in made])]).astype(np.int32)
        blocks = pa.ListArray.from_arrays(pa.array(offsets), entries)
        columns = [batch.column("page_id"), batch.column("url"), batch.column("host"), blocks]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "blocks"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1), F.lit("")))


def skeleton(page: Column) -> Column:
    """The tags of a page without its words and attributes: all that matching looks at."""
    bare = F.regexp_replace(page, r"(?<=>)[^<]+", "")
    return F.regexp_replace(bare, r"<([A-Za-z][^\s/>]*)\s[^>]*?(/?)>", "<$1$2>")


def references(pages: DataFrame) -> DataFrame:
    """host and the skeleton of one page: of the most common shape, then the least hash.

    The shape is the sequence of tags that begin a page's larger parts, so it costs one
    regular expression and no parsing. Only hashes are grouped; html is not shuffled. Copies count once.
    """
    parts = F.regexp_extract_all(
        F.lower("html"), F.lit(r"<(/?(?:nav|header|main|article|section|aside|footer|form|ul|ol|table|div))\b"), F.lit(1)
    )
    some = pages.where("length(html) > 0")
    counted = (
        some.select("host", F.xxhash64(parts).alias("shape"), F.xxhash64("html").alias("page"))
        .distinct()
        .groupBy("host", "shape")
        .agg(F.count("*").alias("n"), F.min("page").alias("page"))
    )
    chosen = counted.groupBy("host").agg(F.max(F.struct("n", "shape", "page")).alias("best"))
    picked = written(chosen.select("host", F.col("best.page").alias("page")), "picked")
    own = some.select("host", skeleton(F.col("html")).alias("reference"), F.xxhash64("html").alias("page"))
    return matched(own, picked, ["host", "page"]).groupBy("host").agg(F.min("reference").alias("reference"))


def _with_reference(pages: DataFrame) -> DataFrame:
    """Pages with their host's skeleton, broadcast while all of them are small."""
    found = written(references(pages), "references")
    size = found.agg(F.sum(F.length("host") + F.length("reference"))).first()[0] or 0
    return pages.join(F.broadcast(found) if size <= BROADCAST_CHARS else found, "host", "left")


def different_pages(blocks: DataFrame) -> DataFrame:
    """host and entries (slot, text hash) of one row of each different page of a host.

    Only hashes are grouped, and only the pages that have copies are joined back.
    """
    texts = F.transform("blocks", lambda b: b["text"])
    keyed = blocks.select(
        "host",
        "row",
        F.xxhash64(texts).alias("page_a"),
        F.xxhash64(F.lit(7), texts).alias("page_b"),
        F.transform("blocks", lambda b: F.struct(b["slot"].alias("slot"), F.xxhash64(b["text"]).alias("text"))).alias(
            "entries"
        ),
    )
    page = ["host", "page_a", "page_b"]
    copied = written(
        keyed.groupBy(*page).agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1").drop("n"), "copied"
    )
    return matched(keyed, copied, page, "left").where(F.col("first").isNull() | (F.col("row") == F.col("first"))).select("host", "entries")


def template_slots(blocks: DataFrame) -> DataFrame:
    """host and its template slots: those with few different texts over the different pages."""
    texts = (
        different_pages(blocks).select("host", F.explode("entries").alias("e")).where("e.slot is not null")
        .groupBy("host", F.col("e.slot").alias("slot"), F.col("e.text").alias("text"))
        .agg(F.count("*").alias("n"))
    )
    slots = texts.groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.count("*").alias("texts"))
    constant = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") - F.col("texts") + 1 >= RETURNING * F.col("pages"))
    return slots.where(constant).groupBy("host").agg(F.collect_set("slot").alias("template"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    own = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host_of(F.col("url")))
    blocks = written(
        _with_reference(own).select("page_id", "url", "host", "html", "reference").mapInArrow(
            _block_rows,
            "page_id long, url string, host string, "
            "blocks array<struct<slot: string, junk: boolean, main: boolean, text: string>>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "blocks",
    )
    slots = written(template_slots(blocks), "templates")
    few = (slots.agg(F.sum(F.size("template"))).first()[0] or 0) <= BROADCAST_SLOTS
    joined = blocks.join(F.broadcast(slots) if few else slots, "host", "left")
    content = F.filter(
        "blocks",
        lambda b: ~b["junk"] & ~F.coalesce(F.array_contains("template", b["slot"]), F.lit(False)),
    )
    kept = joined.withColumn("content", content)
    kept = kept.withColumn("article", F.filter("content", lambda b: b["main"]))
    chosen = F.when(F.size("article") > 0, F.col("article")).otherwise(F.col("content"))
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n\n")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
