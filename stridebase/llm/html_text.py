"""Main text of web pages by the maximum-scoring subsequence of their words and tags.

A page is read once into items in page order: runs of words, which score at least a little, and
tags, which cost. The main text lies in the run of consecutive items with the greatest sum, found by a
linear scan. What a word is worth in a paragraph, a list or a link, and what each tag costs, is learnt
from pages that mark their article themselves (one ``article`` or ``main`` element): the marked region must
beat every other one by a margin that grows with the items in which the two differ, and where it does not,
the weights move just as far as it takes. Tags that the sample does not hold keep the weights they start from.

Elements that are never main text (menus, forms, notices, adverts, comments of readers and so on, told
by their name, role, or the words of their class and id) are one item each, and their text is not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.words import rows_of

SAMPLE = 500  # pages that mark their article, to learn from
LONGEST = 1 << 16  # characters of such a page
EPOCHS = 8
MARGIN = 0.5  # by which the marked region must win, for every item that another region has wrong
LEAST = 0.01  # that a word is worth and a tag costs

# What an element is.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr picture source input area base link meta col embed param track".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
APART = frozenset("nav aside footer form noscript template svg select button dialog menu object audio video canvas datalist".split())
REOPENED = frozenset("nav form header".split())  # an article that begins in one is not part of it
CELLS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",)}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in a class, id or role that tell an element apart, and those that name the main text.
CUES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription paywall sidebar aside complementary menu nav "
    "navbar navigation breadcrumb breadcrumbs footer contentinfo comment comments commentlist disqus respond reply replies "
    "share sharing social related recommended recommendations widget login signup search pagination pager toolbar dialog form".split()
)
PAGE_HEAD = frozenset("header masthead topbar".split())
CONTENT = frozenset("content article main post entry story articlebody maincontent".split())
NOT_HERE = frozenset("has with no without is not hide show".split())

# Where the weights start.
WORDS = {"p": 1.0, "h": 1.0, "li": 0.8, "cell": 0.8, "other": 0.7, "a": 0.1}
TAGS = {"p": -0.3, "h": -0.3, "li": -0.8, "a": -0.8, "cell": -0.8, "block": -0.6, "inline": -0.1, "img": -0.5, "page": -3.0, "apart": -2.0, "article": -30.0}

_TAG_END = re.compile(r"""=[ \t\n\r\f]*+(["'])|>""")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_CUE_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Page:
    """A page's items (feature, number, block or -1 for tags) and blocks of text, and its marked articles."""

    items: list[tuple[str, int, int]] = field(default_factory=list)
    blocks: list[list[str]] = field(default_factory=lambda: [[]])
    marked: list[list[int]] = field(default_factory=list)  # first and last item, the last missing if open

    def text(self, first: int, last: int) -> str:
        """The blocks that the items from ``first`` to ``last`` touch, whole."""
        touched = [b for _, _, b in self.items[first : last + 1] if b >= 0]
        if not touched:
            return ""
        texts = (" ".join("".join(parts).split()) for parts in self.blocks[touched[0] : touched[-1] + 1])
        return "\n\n".join(t for t in texts if t)


def _is_apart(name: str, attributes: str, inside: int) -> bool:
    """Whether an element is never main text; ``inside`` counts the open articles."""
    if name in ("html", "body", "main", "head"):
        return False
    if name in APART or (name == "header" and not inside):
        return True
    if "=" not in attributes:
        return False
    names = []
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        names += [[w.lower() for w in _CUE_WORDS.findall(n)] for n in entities.unescape(a or b or c).split()]
    if any(len(n) == 1 and n[0] in CONTENT or "".join(n) in CONTENT for n in names):
        return False
    cues = CUES if inside or name == "article" else CUES | PAGE_HEAD
    return any(n and n[0] not in NOT_HERE and not cues.isdisjoint(n) for n in names)


def _feature(name: str) -> str:
    if name in ("p", "li", "a", "img"):
        return name
    if name in HEADINGS:
        return "h"
    if name in CELLS:
        return "cell"
    if name in INLINE:
        return "inline"
    if name in ("article", "main"):
        return "article"
    return "page" if name in ("html", "body", "head") else "block"


def _markup(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of a page in order: text, start and end tags. Linear in the length of the page.

    Comments, declarations and the content of raw elements are left out; as browsers do, an unclosed one reaches
    to the end of the page.
    """
    at, size, unclosed = 0, len(html), set()
    while at < size:
        open_ = html.find("<", at)
        if open_ < 0:
            yield "text", "", html[at:]
            return
        after = html[open_ + 1 : open_ + 2]
        closing = after == "/"
        name = _NAME.match(html, open_ + 1 + closing)
        if not name and after not in ("!", "?") and not closing:  # a plain sign
            yield "text", "", html[at : open_ + 1]
            at = open_ + 1
            continue
        if open_ > at:
            yield "text", "", html[at:open_]
        if not name:
            mark = "-->" if html.startswith("<!--", open_) else ">"
            end = html.find(mark, open_ + (2 if mark == "-->" else 1))
            at = size if end < 0 else end + len(mark)
            continue
        end = name.end()
        while True:  # to the end of the tag, over quoted values
            found = _TAG_END.search(html, end)
            if not found:
                return
            if found[0] == ">":
                end = found.end()
                break
            quote = found[1]
            close = -1 if quote in unclosed else html.find(quote, found.end())
            if close < 0:
                unclosed.add(quote)
                end = found.end()
            else:
                end = close + 1
        lower = name[0].lower()
        yield "end" if closing else "start", lower, html[name.end() : end - 1]
        at = end
        if lower in RAW and not closing:
            stop = _RAW_END[lower].search(html, end)
            at = stop.start() if stop else size


def read_page(html: str | None) -> Page:
    page = Page()
    items, blocks = page.items, page.blocks
    inside = links = 0  # open articles, open links
    context = "other"
    # The element that is left out; open ones of its name, lists and articles in it; whether an article ends it.
    apart, depth, nested, articles, reopened = "", 0, 0, 0, False

    for kind, name, rest in _markup(html or ""):
        if apart:
            # Left out up to its end, or to where it must have ended.
            if kind == "text":
                continue
            around = CELLS.get(apart, ())
            if kind == "start":
                begins = reopened and name in ("article", "main")
                cell = apart in CELLS and not nested and (name in CELLS if apart not in ("li", "tr") else name == apart)
                if begins or cell or (apart == "p" and name not in INLINE):
                    apart = ""
                else:
                    depth += name == apart and not rest.endswith("/")
                    nested += name in around
                    articles += name in ("article", "main") and name != apart
                    continue
            else:
                depth -= name == apart
                outer = name in ("body", "html") or (name in ("article", "main") and name != apart and not articles) or (name in around and not nested)
                if depth and not outer:
                    nested -= name in around
                    articles -= name in ("article", "main") and name != apart
                    continue
                ended, apart = apart, ""
                if name == ended:
                    blocks.append([])
                    continue
        if kind == "text":
            text = entities.unescape(rest) if "&" in rest else rest
            words = text.split()
            if words:
                # Scripts without spaces: six signs are a word.
                items.append(("word " + ("a" if links else context), max(len(words), sum(map(len, words)) // 6), len(blocks) - 1))
            if text:
                blocks[-1].append(text)
            continue
        if kind == "start" and name not in VOID and name not in RAW and _is_apart(name, rest, inside):
            items.append(("tag apart", 1, -1))
            blocks.append([])
            apart, depth, nested, articles = name, 1, 0, 0
            reopened = name in REOPENED
            continue
        items.append(("tag " + _feature(name), 1, -1))
        if name == "a":
            links = 1 if kind == "start" else 0
        if name in INLINE:
            if name == "br":
                blocks[-1].append(" ")
            continue
        if name in RAW:
            continue
        blocks.append([])
        links = 0
        feature = _feature(name)
        context = feature if kind == "start" and feature in ("p", "h", "li", "cell") else "other"
        if name in ("article", "main"):
            if kind == "start":
                inside += 1
                page.marked.append([len(items)])
            elif inside:
                inside -= 1
                for mark in reversed(page.marked):
                    if len(mark) == 1:
                        mark.append(len(items) - 2)
                        break
    return page


def best_region(items: list[tuple[str, int, int]], weights: dict[str, float], gold: tuple[int, int] | None = None) -> tuple[int, int]:
    """First and last item of the run with the greatest sum, the first of equals; (0, -1) without words.

    With ``gold``, items outside that region gain ``MARGIN`` and those in it lose it: its strongest rival.
    """
    best, found = 0.0, (0, -1)
    total, start = 0.0, 0
    for i, (feature, number, _) in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        total += weights[feature] * number
        if gold:
            total += -MARGIN if gold[0] <= i <= gold[1] else MARGIN
        if total > best:
            best, found = total, (start, i)
    return found


def first_weights() -> dict[str, float]:
    return {f"word {k}": v for k, v in WORDS.items()} | {f"tag {k}": v for k, v in TAGS.items()}


def _marked_region(page: Page) -> tuple[int, int] | None:
    """From the first to the last words of the one marked article."""
    if len(page.marked) != 1 or len(page.marked[0]) != 2:
        return None
    first, last = page.marked[0]
    words = [i for i in range(first, last + 1) if page.items[i][2] >= 0]
    return (words[0], words[-1]) if words else None


def learn(pages: Iterable[str], epochs: int = EPOCHS) -> dict[str, float]:
    """Weights from pages that mark their article; others are passed over.

    Words stay worth at least ``LEAST`` and tags cost at least that. The result is the mean over all steps;
    what no page holds keeps its proportion to words in paragraphs.
    """
    weights = first_weights()
    labelled = [(page.items, gold) for page in map(read_page, pages) if (gold := _marked_region(page))]
    total, steps = Counter(), 0
    for _ in range(epochs):
        for items, gold in labelled:
            found = best_region(items, weights, gold)
            if found != gold:
                move = Counter()
                for (first, last), sign in ((gold, 1), (found, -1)):
                    for feature, number, _ in items[first : last + 1]:
                        move[feature] += sign * number
                wrong = len(set(range(gold[0], gold[1] + 1)) ^ set(range(found[0], found[1] + 1)))
                behind = MARGIN * wrong - sum(weights[f] * n for f, n in move.items())
                length = sum(n * n for n in move.values())
                step = max(0.0, min(1.0, behind / length)) if length else 0.0
                for f, n in move.items():
                    moved = weights[f] + step * n
                    weights[f] = max(moved, LEAST) if f.startswith("word") else min(moved, -LEAST)
            total.update(weights)
            steps += 1
    if not steps:
        return weights
    first, seen = first_weights(), {f for items, _ in labelled for f, _, _ in items}
    scale = total["word p"] / steps / first["word p"]
    return {f: total[f] / steps if f in seen else first[f] * scale for f in weights}


def fit_weights(pages: DataFrame, sample: int = SAMPLE, id_column: str = "page_id", html_column: str = "html") -> dict[str, float]:
    """Weights learnt from at most ``sample`` pages of at most ``LONGEST`` characters that mark their article,
    chosen by the hash of id and page. Without such pages the weights are those that learning starts from."""
    body = F.col(html_column)
    marks = F.lower(body).contains("<article") | F.lower(body).contains("<main")
    key = F.shiftrightunsigned(F.xxhash64(id_column, html_column), 1)
    marked = pages.where((F.length(body) <= LONGEST) & marks).select(key.alias("key"), body.alias("html"))
    # About one and a half times the sample by their hash, so that what is collected does not grow with the table.
    share = 1.5 * sample / max(marked.count(), 1)
    chosen = marked.where(F.col("key") <= int(share * (1 << 63))) if share < 1 else marked
    return learn(r["html"] for r in sorted(chosen.limit(2 * sample).collect())[:sample])


def main_text(
    pages: DataFrame, weights: dict[str, float], id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars`` (long, code points of the text).

    The text is that of the best region's blocks in page order, joined by an empty line: character references
    decoded, every run of white space one space, blocks trimmed and empty ones left out. Blocks that the
    region touches are taken whole. A page that is NULL, empty or without words outside the elements left out has the text
    ''. Of equal regions the first is taken. A NULL id or url is kept, repeated rows give repeated rows,
    pages of any length are read whole, an empty table gives no rows, and other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, pages.schema[id_column].dataType),
            T.StructField(url_column, pages.schema[url_column].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, bodies in rows_of(batch, 2):
                texts = []
                for body in bodies:
                    page = read_page(body)
                    texts.append(page.text(*best_region(page.items, weights)))
                keys = [batch.column(i).slice(start, len(bodies)) for i in (0, 1)]
                columns = [*keys, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(id_column, url_column, html_column).mapInArrow(extract, schema)
