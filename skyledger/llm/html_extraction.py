"""Main text of web pages by the consensus of their hosts.

Each page's containers are scored by the text that stands in them outside of links and of what is never
article text. A page votes for the tag-class path of its best container, with numbers in class names made
equal; the votes are counted per host. Then every page is read again with its host's winning paths: the first
with a fair share of the text that any of them holds there counts. A page that has none of them falls back
to its own best container. Sections that stand side by side are taken together by what is around them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

from skyledger.llm.common import carried, in_small_batches, saved
from skyledger.llm.url_filter import url_parts

# A path needs this share of its host's votes, so a host has at most so many winning paths as fit in 1.
LEAST_SHARE = 0.05
# A container gives way to its parent while that adds at most this much text: a headline, a lead;
PARENT_GAIN = 1.3
# and also if it adds more, but with at most this share in links: another section, a list and its paragraphs.
LINKED_SHARE = 0.3
# Of a host's winning paths the first one counts under which a page has this share of the most text under any.
HELD_SHARE = 0.15
SLICE = 256
# Elements deeper than this count as part of the container at this depth.
MAX_DEPTH = 100

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas video audio select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul head".split()
)
# Their text is a block of its container, not a container.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre summary figcaption caption td th".split())
NEVER = frozenset("nav footer aside head dialog menu button".split())
# Rarely article text, but some sites have whole pages in them.
DOUBTFUL = frozenset("form header".split())
ROOTS = frozenset("html body main article".split())
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus"
    " footer masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup promo promoted related"
    " share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget widgets"
    # Readers' words, unless they are what the page is about.
    " discussion feedback responses review reviews".split()
)
COMMENTS = frozenset("comment comments reply replies disqus".split())
# A compound name with one of these says how the element is laid out, not what it holds: with-sidebar, header-fixed.
LAYOUT = frozenset(
    "with without has have no not is hide hidden show open closed enabled disabled fixed sticky left right top bottom layout above below".split()
)
# Left empty if they are never closed; after the others of RAW the rest of the page is no text.
EMPTY_IF_OPEN = RAW - frozenset("script style textarea title".split())
# Without an article, an element with a doubtful name or tag stays if it holds more than this share of the text,
# and so much of it outside of links as an article has; a notice has less.
MOST_TEXT = 0.5
ARTICLE_CHARS = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME = re.compile(r"[^a-z0-9]+")
_HEADER = frozenset(["header"])
_DIGITS = re.compile(r"\d+")


@dataclass
class Element:
    """An open element: its own generalised path, and whether text in it can be article text."""

    tag: str
    path: str
    kept: bool
    parents: tuple[str, ...]
    # Numbers of the elements with doubtful names or tags that it is in, itself included; negative for comments.
    doubts: tuple[int, ...] = ()


@dataclass
class Block:
    """A run of text: the paths of its containers from the outside in, and how much of it is in links."""

    text: str
    containers: tuple[str, ...]
    linked: int = 0
    doubts: tuple[int, ...] = ()
    headline: bool = False


def _named(names: set[str], never: frozenset[str]) -> bool:
    """Whether a name, or a part of one that says what an element holds, is in ``never``."""
    parts = [n.split() for n in (_NAME.sub(" ", name) for name in names)]
    return any(never.intersection(p) and not LAYOUT.intersection(p) for p in parts)


def _step(tag: str, attributes: str, parent: Element | None, number: int) -> Element:
    names: set[str] = set()
    classes: list[str] = []
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        names.update(value.split())
        if m[1].lower() == "class":
            classes = sorted({_DIGITS.sub("#", c) for c in value.split()})
    inside = parent.parents if parent else ()
    in_article = any(_tag(p) in ("article", "main") for p in inside)
    kept = parent.kept if parent else True
    doubts = parent.doubts if parent else ()
    if tag in NEVER:
        kept = False
    elif tag == "article" or tag == "main":
        doubts = (*doubts, -number) if _named(names, COMMENTS) else doubts
    elif tag not in ROOTS and _named(names, COMMENTS):
        doubts = (*doubts, -number)
    elif tag not in ROOTS and (_named(names, NEVER_NAMES) or (not in_article and _named(names, _HEADER))):
        doubts = (*doubts, number)
    elif tag in DOUBTFUL and not (tag == "header" and in_article):
        doubts = (*doubts, number)
    if len(inside) >= MAX_DEPTH:
        return Element(tag, parent.path, kept, inside, doubts)
    path = (parent.path + "/" if parent else "") + ".".join([tag, *classes])
    parents = inside if tag in LEAVES else (*inside, path)
    return Element(tag, path, kept, parents, doubts)


def _tag(path: str) -> str:
    return path.split("/")[-1].split(".")[0]


def _without_doubts(blocks: list[Block]) -> list[Block]:
    """The blocks outside of doubtful elements.

    Where no article or main element has text outside of them, those that hold most of the page's text, and an
    article's worth of it, are not doubtful, unless they are comments.
    """
    sure = [b for b in blocks if not b.doubts]
    if any(_tag(path) in ("article", "main") for b in sure for path in b.containers):
        return sure
    held: dict[int, int] = {}
    unlinked: dict[int, int] = {}
    for block in blocks:
        for doubt in block.doubts:
            held[doubt] = held.get(doubt, 0) + len(block.text)
            unlinked[doubt] = unlinked.get(doubt, 0) + len(block.text) - block.linked
    total = sum(len(b.text) for b in blocks)
    gone = {doubt for doubt, n in held.items() if doubt < 0 or n <= MOST_TEXT * total or unlinked[doubt] < ARTICLE_CHARS}
    kept = [b for b in blocks if gone.isdisjoint(b.doubts)]
    # A page that is doubtful as a whole has a text only if one of its elements could be an article.
    return kept or (blocks if max(unlinked.values(), default=0) >= ARTICLE_CHARS else [])


def parse(source: str) -> list[Block]:
    """The blocks of a page that can be article text, in page order. Broken markup is read as far as it goes."""
    blocks: list[Block] = []
    stack: list[Element] = []
    parts: list[str] = []
    linked = links = opened = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            if stack:
                blocks.append(Block(text, stack[-1].parents, linked, stack[-1].doubts, stack[-1].tag == "h1"))
            else:
                blocks.append(Block(text, (), linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and (not stack or stack[-1].kept):
            parts.append(text)
            linked += len(text) if links else 0

    at = 0
    while True:
        m = _TOKEN.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        closing = bool(m[1] or m[4])
        if not tag:
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in RAW and not closing:
            add(" ")
            if (m[3] or m[6] or "").endswith("/"):
                continue
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.IGNORECASE).search(source, at)
            if end or tag not in EMPTY_IF_OPEN:
                at = end.end() if end else len(source)
            continue
        if tag == "br":
            add(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("article", "body", "html", "table") and tag in LEAVES:
                    break
        else:
            # A new block ends an open paragraph; an item ends the item before it.
            if stack and stack[-1].tag == "p" or stack and tag in LEAVES and stack[-1].tag == tag:
                stack.pop()
            opened += 1
            stack.append(_step(tag, m[3] or m[6] or "", stack[-1] if stack else None, opened))
        links = 0 if tag in ROOTS else links
    flush()
    return _without_doubts(blocks)


def best_container(blocks: list[Block]) -> str | None:
    """The path of the container with most text near it, or of a parent that adds little or more of an article."""
    scores: dict[str, float] = {}
    totals: dict[str, int] = {}
    linked: dict[str, int] = {}
    for block in blocks:
        weight = max(0, len(block.text) - block.linked)
        for k, path in enumerate(reversed(block.containers)):
            scores[path] = scores.get(path, 0) + weight / (1 if k == 0 else 2 if k == 1 else 3 * k)
        # Paths repeat along one chain only where markup is deeper than MAX_DEPTH.
        for path in set(block.containers):
            totals[path] = totals.get(path, 0) + weight
            linked[path] = linked.get(path, 0) + block.linked
    if not scores:
        return None
    best = max(scores, key=lambda p: (scores[p], p))
    parents = next(b.containers for b in blocks if best in b.containers)
    parents = parents[: parents.index(best)]
    for parent in reversed(parents):
        if _tag(parent) == "html":
            break
        added, links = totals[parent] - totals[best], linked[parent] - linked[best]
        gain = (PARENT_GAIN - 1) * totals[best]
        mostly_links = links > LINKED_SHARE * (added + links)
        if _tag(parent) == "body" and added <= gain or mostly_links and max(added, links) > gain:
            break
        if _tag(parent) == "body" and _tag(best) in ("article", "main"):
            # Beside an article only other articles count.
            others = [b for b in blocks if best not in b.containers and any(_tag(p) in ("article", "main") for p in b.containers)]
            if sum(len(b.text) - b.linked for b in others) <= gain:
                break
        best = parent
    # Whatever else an article holds is a part of it.
    above = [p for p in parents if best.startswith(f"{p}/") and _tag(p) in ("article", "main")]
    return above[-1] if above and _tag(best) not in ("article", "main") else best


def choose(blocks: list[Block], winners: list[str]) -> str | None:
    """The first of ``winners`` with a fair share of the text that any of them has on the page, else the page's own best.

    A winner gives way to one around it that is the page's own best container.
    """
    own = best_container(blocks)
    held = {w: sum(len(b.text) for b in blocks if w in b.containers) for w in winners}
    most = max(held.values(), default=0)
    if not most:
        return own
    first = next(w for w in winners if held[w] >= HELD_SHARE * most)
    return own if own in held and first.startswith(f"{own}/") else first


def extract(source: str, winners: list[str]) -> str:
    """The text under the path that :func:`choose` finds for the page."""
    blocks = parse(source)
    path = choose(blocks, winners)
    chosen = [b for b in blocks if path is None or path in b.containers]
    return "\n".join(b.text for b in _headline(blocks, chosen) + chosen)


def _headline(blocks: list[Block], chosen: list[Block]) -> list[Block]:
    """The headline right above a text that has none: between them stand nothing but links."""
    if not chosen or any(b.headline for b in chosen):
        return []
    for block in reversed(blocks[: blocks.index(chosen[0])]):
        if block.headline:
            return [block]
        if 2 * block.linked < len(block.text):
            return []
    return []


def _votes(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                best = [best_container(parse(h)) if h else None for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.string())], ["_host", "path"])

    return in_small_batches(pages.select("_host", "_html")).mapInArrow(run, "_host string, path string").filter("path IS NOT NULL")


def winning_paths(pages: DataFrame) -> DataFrame:
    """_host, _winners: paths with at least a twentieth of the host's votes, most votes first, ties by code point."""
    counted = _votes(pages).groupBy("_host", "path").agg(F.count("*").alias("votes"))
    share = F.col("votes") / F.sum("votes").over(Window.partitionBy("_host"))
    some = counted.withColumn("share", share).filter(F.col("share") >= LEAST_SHARE)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("least"), F.col("path").alias("path"))))
    return some.groupBy("_host").agg(F.transform(ranked, lambda r: r["path"]).alias("_winners"))


def extract_main_text(pages: DataFrame, keep: list[str], url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``keep`` columns of every row, and _text: its main text, blocks joined by a line feed.

    NULL and empty pages have an empty text; so have pages without article text. NULL URLs and those without a
    host are one host, the empty one. Repeated rows vote as often as they come. Other columns are not read. No rows give
    no rows. ``keep`` may have any names; one that is named ``_text`` is replaced.
    """
    host, _ = url_parts(F.col(url_column).cast("string"))
    rows = pages.select(carried(keep, ["_text"]), F.coalesce(host, F.lit("")).alias("_host"), F.col(html_column).cast("string").alias("_html"))
    winners = saved(winning_paths(rows))
    placed = rows.join(winners, "_host", "left").drop("_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                pairs = zip(part.column("_html").to_pylist(), part.column("_winners").to_pylist())
                texts = [extract(h, w or []) if h else "" for h, w in pairs]
                yield pa.RecordBatch.from_arrays([part.column("_keep"), pa.array(texts, pa.string())], ["_keep", "_text"])

    schema = StructType([placed.schema["_keep"]]).add("_text", StringType())
    return in_small_batches(placed).mapInArrow(run, schema).select("_keep.*", "_text")
