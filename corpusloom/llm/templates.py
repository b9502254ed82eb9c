"""Main text of web pages by deducing the template of pages from one host.

Tags are told apart by their path (tag names with class and id). Over a set of
pages of one host every such token has a vector of occurrences per page; tokens
with equal vectors form an equivalence class. Classes that occur at most once
in a page, in one order on all pages, are the template's fixed frame; classes
that repeat are nested in the frame element that holds all of them. The frame
element that carries the text of the pages is the article; what its slots hold,
without navigation, notices, forms and the like, is the text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# Pages that a template is deduced from; a host with fewer uses what it has.
SET_PAGES = 32
SET_BYTES = 8 << 20
# A host with more than 1/SHARES of all pages is dealt over several tasks, so fewer than SHARES hosts are listed.
SHARES = 1024

# Element roles, by tag, by ARIA role and by words in class and id. Fixed word lists.
RAW_TAGS = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "object")
DROPPED_TAGS = frozenset(("nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "svg", *RAW_TAGS))
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar side menu "
    "nav navbar navigation breadcrumb breadcrumbs notice notices notification cookie cookies consent gdpr alert "
    "comment comments reply replies respond disqus discussion share sharing social related recommended newsletter "
    "subscribe subscription signup login search popup modal overlay footer header masthead topbar toolbar "
    "pagination pager widget widgets skip hidden".split()
)
# Of these, words that sections of an article carry too: inside the article they count with the template's evidence only.
DOUBTFUL_NAMES = frozenset(
    "side menu nav navigation notice notices alert discussion share sharing social related recommended reply replies respond "
    "search popup modal overlay footer header hidden skip promotion banner login signup subscription widget widgets".split()
)
# Pages of a host from which an element that most of them have is the template's.
EVIDENCE_PAGES = 4
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
FRAME_TAGS = frozenset("html body article main section div table tbody tr td center".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW_TAGS) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<svg(?=[\s/>])[^>]*(?:/>|(?<!/)>.*?(?:</svg\s*>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    # Every branch starts with another character and nothing is given back, so a tag is read in one pass.
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:\s++|/|[^\s>=\"'/]++(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"']*))?)*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?")
HEADING = re.compile(r"h[1-6]")
SURE, DOUBTFUL = 1, 2
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Element:
    tag: str
    path: str
    dropped: bool
    parent: Element | None
    # Why the element itself is left out: SURE, DOUBTFUL (by a name that articles use too) or not at all.
    own: int
    begin: int
    end: int = -1
    children: list[Element] = field(default_factory=list)
    # Text pieces and child elements in page order.
    content: list = field(default_factory=list)
    # Characters of text in the element, outside of links and dropped elements.
    mass: int = 0


def attributes(rest: str) -> dict[str, str]:
    if not rest.strip():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}


def role_of(tag: str, attrs: dict[str, str], inside_article: bool) -> int:
    """Whether an element is left out: 0, ``SURE`` or ``DOUBTFUL``. Ids of headings and sections name their subject."""
    if tag in DROPPED_TAGS or tag == "header" and not inside_article:
        return SURE
    if tag in ("html", "body", "article", "main"):
        return 0
    if not attrs:
        return 0
    if attrs.get("role", "").lower() in DROPPED_ROLES or "hidden" in attrs:
        return SURE
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return SURE
    id_words = "" if tag == "section" or HEADING.fullmatch(tag) else attrs.get("id", "")
    names = {n.lower() for n in NAME_PARTS.findall(attrs.get("class", "") + " " + id_words)} & DROPPED_NAMES
    return SURE if names - DOUBTFUL_NAMES else DOUBTFUL if names else 0


def parse(html: str) -> tuple[Element, list[Element]]:
    """The page's element tree and all elements in page order; unclosed and stray tags are taken as browsers do."""
    root = Element("", "", False, None, 0, 0)
    here, order, at = root, [root], 0

    def leave(tags: tuple[str, ...], stops: frozenset[str] | tuple[str, ...] = ()) -> None:
        nonlocal here
        node = here
        while node.parent is not None and node.tag not in tags:
            if node.tag in stops:
                return
            node = node.parent
        if node.parent is not None:
            here = node.parent

    for m in TOKEN.finditer(html):
        if m.start() > at:
            here.content.append(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["close"]:
            leave((tag,))
            continue
        if tag in BLOCK_TAGS:
            leave(("p",), FRAME_TAGS | {"li", "blockquote", "dd"})
        if tag == "li":
            leave(("li",), ("ul", "ol", "menu"))
        elif tag in ("dd", "dt"):
            leave(("dd", "dt"), ("dl",))
        elif tag in ("td", "th"):
            leave(("td", "th"), ("tr", "table"))
        elif tag == "tr":
            leave(("tr",), ("table",))
        attrs = attributes(m["rest"])
        name = tag + "".join(f".{attrs[k]}" for k in ("id", "class") if attrs.get(k))
        inside = "/article" in here.path or "/main" in here.path
        own = role_of(tag, attrs, inside)
        element = Element(tag, f"{here.path}/{name}", here.dropped or own > 0, here, own, m.start())
        here.content.append(element)
        here.children.append(element)
        order.append(element)
        if tag not in VOID_TAGS:
            here = element
    if at < len(html):
        here.content.append(html[at:])
    for element in reversed(order):
        own = sum(len(x) - x.count(" ") for x in element.content if isinstance(x, str)) if element.tag != "a" else 0
        element.mass = 0 if element.dropped else own + sum(c.mass for c in element.children if c.tag != "a")
    return root, order


def frame(pages: list[list[Element]]) -> dict[str, int]:
    """Paths of the template's frame and their order, from the classes of equal occurrence vectors.

    Valid classes occur at most once in a page, on at least half of the pages,
    and their tokens in one order on all of them.
    """
    vectors: dict[str, list[int]] = defaultdict(lambda: [0] * len(pages))
    for n, order in enumerate(pages):
        for path, count in Counter(e.path for e in order).items():
            vectors[path][n] = count
    classes: dict[tuple[int, ...], list[str]] = defaultdict(list)
    for path, vector in vectors.items():
        classes[tuple(vector)].append(path)
    single = {v: set(paths) for v, paths in classes.items() if max(v) == 1 and 2 * sum(v) >= len(pages)}
    out: dict[str, int] = {}
    for vector, paths in sorted(single.items(), key=lambda x: -sum(x[0])):
        sequences = {
            tuple(e.path for e in order if e.path in paths) for order, there in zip(pages, vector, strict=True) if there
        }
        if len(sequences) == 1:
            out.update((path, len(out) + k) for k, path in enumerate(sequences.pop()))
    return out


def article_path(pages: list[list[Element]], paths: dict[str, int]) -> str:
    """The frame element that holds the pages' text.

    From the root down, into the child of the frame that holds most of the
    text, as long as one does and no headline would be lost.
    """
    mass: Counter[str] = Counter()
    tags, dropped, headlines = {"": ""}, set(), set()
    for order in pages:
        for e in order:
            if e.path in paths:
                mass[e.path] += e.mass
                tags[e.path] = e.tag
                if e.dropped:
                    dropped.add(e.path)
            if e.tag == "h1" and not e.dropped:
                headlines.add(e.path)
    nested = defaultdict(list)
    for path in paths:
        if path and path not in dropped:
            nested[path.rpartition("/")[0]].append(path)
    here = ""
    while tags[here] != "article":
        # An element that is named for the article counts for four of any other kind.
        worth = {p: mass[p] * (4 if tags[p] in ("article", "main") else 1) for p in nested[here] if tags[p] in FRAME_TAGS}
        best = max(worth, key=lambda p: (worth[p], -paths[p]), default=None)
        if best is None or 2 * worth[best] < mass[here] or mass[best] == 0:
            break
        if tags[best] not in ("article", "main") and any(h.rpartition("/")[0] == here for h in headlines):
            break
        here = best
    return here


def in_links(element: Element) -> tuple[int, int]:
    """Characters of text in links, and in all, below an element."""
    links, whole, pending = 0, 0, [(element, element.tag == "a")]
    while pending:
        node, linked = pending.pop()
        own = sum(len(x) - x.count(" ") for x in node.content if isinstance(x, str))
        whole += own
        links += own if linked else 0
        pending += [(c, linked or c.tag == "a") for c in node.children]
    return links, whole


def is_template(element: Element, found: Counter[str], pages: int) -> bool:
    """Evidence that a doubtful element is the template's: most pages of the host have it, or it is mostly links."""
    if pages >= EVIDENCE_PAGES and 2 * found[element.path] >= pages:
        return True
    links, whole = in_links(element)
    return 2 * links >= whole


def blocks(element: Element, found: Counter[str], pages: int) -> list[str]:
    """The texts of the element's blocks in page order; ``found``: pages of the set that have each path."""
    out: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    pending: list = [iter(element.content)]
    ends: list[bool] = [True]
    while pending:
        item = next(pending[-1], None)
        if item is None:
            pending.pop()
            if ends.pop():
                end_block()
        elif isinstance(item, str):
            # References are decoded piece by piece: markup ends them.
            parts.append(unescape(item))
        elif item.own == SURE or item.own == DOUBTFUL and is_template(item, found, pages):
            if item.tag in BLOCK_TAGS:
                end_block()
        elif item.tag == "br":
            parts.append(" ")
        else:
            block = item.tag in BLOCK_TAGS
            if block:
                end_block()
            pending.append(iter(item.content))
            ends.append(block)
    return out


def extract(htmls: list[str]) -> list[str]:
    """Main texts of a set of pages from one host."""
    trees = [parse(h) for h in htmls]
    orders = [order for _, order in trees]
    paths = frame(orders) if orders else {}
    article = article_path(orders, paths) if orders else ""
    found = Counter(path for order in orders for path in {e.path for e in order if e.own == DOUBTFUL})
    out = []
    for root, order in trees:
        # A page that lacks the template's article is read on its own.
        own = article
        if not any(e.path == own for e in order):
            own = article_path([order], frame([order]))
        element = next((e for e in order if e.path == own), root)
        out.append("\n\n".join(blocks(element, found, len(orders))))
    return out


def main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    set_pages: int = SET_PAGES,
    set_bytes: int = SET_BYTES,
) -> DataFrame:
    """``id, url, text, n_chars`` of every page, one row per row.

    Pages are sorted by host and read in sets of ``set_pages`` to twice as many
    pages of one host, each of which deduces its template anew; so no host is
    held whole, and one with many pages is dealt over tasks by a hash of the
    page. Null html is empty, an empty page has an empty text, null and
    malformed urls form one host. Null and repeated ids are no matter. Other
    columns are ignored. Html is shuffled once.
    """
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.col(html_column).alias("html"),
        F.coalesce(F.lower(F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
    )
    counts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    total = counts.agg(F.sum("pages")).first()[0] or 0
    # Fewer than SHARES rows by definition, so this side has a bound.
    large = counts.filter(F.col("pages") * SHARES > total).select(
        "host", F.ceil(F.col("pages") * SHARES / F.lit(max(total, 1))).alias("salts")
    )
    place = F.xxhash64("url", "id", F.octet_length("html"))
    dealt = (
        rows.join(F.broadcast(large), "host", "left")
        .withColumn("salt", F.coalesce(F.pmod(place, F.col("salts")), F.lit(0)))
        .drop("salts")
        .withColumn("place", place)
    )
    sorted_rows = dealt.repartition("host", "salt").sortWithinPartitions("host", "salt", "place")
    id_kind, id_type = pages.schema[id_column].dataType.simpleString(), to_arrow_type(pages.schema[id_column].dataType)
    url_kind = pages.schema[url_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets() -> Iterator[list[tuple]]:
            held, size, host = [], 0, None
            for batch in batches:
                for row in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                    if held and row[3] != host:
                        yield held
                        held, size = [], 0
                    elif len(held) >= 2 * set_pages or size >= set_bytes:
                        yield held[:set_pages]
                        held = held[set_pages:]
                        size = sum(len(r[2] or "") for r in held)
                    held.append(row)
                    host = row[3]
                    size += len(row[2] or "")
            if held:
                yield held

        for part in sets():
            texts = extract([r[2] or "" for r in part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], id_type),
                    pa.array([r[1] for r in part], pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["id", "url", "text", "n_chars"],
            )

    out = sorted_rows.select("id", "url", "html", "host").mapInArrow(
        run, f"id {id_kind}, url {url_kind}, text string, n_chars bigint"
    )
    return out.withColumnsRenamed({"id": id_column, "url": url_column})
