"""Main text of HTML pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score positive, the more so the surer their
surroundings are main text, and negative inside what is known not to be; tags score
negative, the more so the more often they occur outside of main text. One linear scan finds
the contiguous run of tokens with the greatest sum; blocks inside it that are declared to be
something else (an advert or a form within the article) are left out of the text.

The weights come from labelled pages: those that mark their article themselves (``article``
or ``main`` elements, their roles, ``itemprop="articleBody"``). Counts of words inside and
outside of the marked part, by their enclosing elements, by the words of class, id and role
attributes, and by their share of links, are added to prior counts that stand for common
usage, so that an element no labelled page shows keeps its usual meaning. All labelled pages
count; the number of features is fixed.
"""

from __future__ import annotations

import html as _html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal

# ---------------------------------------------------------------------------
# FIXED VALUES: kinds of HTML elements.
# ---------------------------------------------------------------------------
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes", "svg", "math", "select", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "header", "head"}
GENERIC = {"div", "section", "center", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "main", "article", "details", "summary", "hgroup", "body", "html"}
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "address", "caption", "legend", "hr", "br"}
BLOCK = BOILERPLATE | GENERIC | TEXTUAL
#: Elements that end an open element of a kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Words of class, id and role attributes that name what is no main text.
KEYWORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "menu",
    "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "aside", "rail", "widget", "widgets", "footer", "header", "masthead", "topbar",
    "toolbar", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "respond", "reply", "replies",
    "disqus", "discussion", "form", "search", "pagination", "pager", "copyright", "legal", "skip", "complementary", "contentinfo", "dialog",
}
#: Of these, what an article may well have for its own headline, and what an article that is
#: found inside of them shows to have been left open or to enclose the whole page.
OWN_HEADER = {"header", "k:header"}
LEFT_OPEN = {"nav", "header", "form", "menu", "dialog", "button", "fieldset", "head"}

#: Prior words (inside, outside) of features.
PRIOR = {**{t: (0.5, 50.0) for t in BOILERPLATE}, **{f"k:{k}": (0.5, 50.0) for k in KEYWORDS}, **{t: (5.0, 5.0) for t in GENERIC}, **{t: (10.0, 4.0) for t in TEXTUAL},
         "p": (30.0, 3.0), "li": (4.0, 5.0), "ul": (4.0, 5.0), "ol": (4.0, 5.0), "links:most": (1.0, 30.0), "links:some": (3.0, 5.0), "links:few": (30.0, 5.0)}
#: The greatest weight of a word; how far one feature moves it, down and up; by kind.
MOST = 1.0
LIMITS = {"declared": (-4.0, 1.0), "generic": (-0.75, 0.75), "textual": (-1.0, 1.0), "marked": (-2.0, 1.0)}
#: A tag's cost where it only occurs outside of main text, and prior tags (inside, outside) by
#: the kind of element; inline elements count as textual ones.
TAG_COST = 1.0
PRIOR_TAGS = {"declared": (0.5, 10.0), "generic": (3.0, 2.0), "textual": (20.0, 1.0)}
#: Words of this weight or less are left out of the region's text.
DROPPED = -1.5
#: The least share of words, without declared parts, that a labelled page marks as its article.
MARKED = 0.25
#: Elements nested deeper are read as if they were not nested (browsers have such a bound too).
DEPTH = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'=]|=\s*(?:\"[^\"]{0,65536}\"|'[^']{0,65536}')|[\"'=])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?i)(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORDS = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")
_WIDE = re.compile("[぀-ヿ㐀-鿿가-힯]")


@dataclass
class Block:
    """Text between block-level tags: its pieces, words, words in links, features, whether it
    lies in a part that the page marks as its article, its innermost element, and the tags
    since the block before."""

    pieces: list[str] = field(default_factory=list)
    words: int = 0
    linked: int = 0
    features: frozenset = frozenset()
    marked: bool = False
    nearest: str = "body"
    tags: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _traits(attrs: str) -> tuple[set[str], bool]:
    """Features of an element's attributes, and whether they mark the article."""
    found, marks = set(), False
    for name, *values in _ATTRIBUTE.findall(attrs):
        value = "".join(values)
        name = name.lower()
        if name == "itemprop":
            marks |= value.lower() == "articlebody"
            continue
        if name == "role" and value.lower() in ("main", "article"):
            marks = True
        found |= {f"k:{w}" for w in map(str.lower, _WORDS.findall(value)) if w in KEYWORDS}
    return found, marks


def blocks_of(page: str | None) -> list[Block]:
    """The page's blocks that hold words. Comments, doctypes and what is no text (scripts,
    styles, ...) are skipped; elements left open end as in HTML (a paragraph with the next
    block, a list entry with the next entry) or with the page."""
    page = page or ""
    out, block = [], Block()
    stack: list[tuple[str, frozenset, bool]] = []  # element, features so far, within a marked part
    link, at = False, 0

    def take(text: str) -> None:
        text = _html.unescape(text) if "&" in text else text
        n = len(text.split())
        n += len(_WIDE.findall(text)) // 2 if n else 0
        block.pieces.append(text)
        block.words += n
        block.linked += n if link else 0

    def end() -> None:
        nonlocal block
        if block.words:
            block.nearest, block.features, block.marked = stack[-1] if stack else ("body", frozenset(), False)
            out.append(block)
            block = Block()
        block.pieces.clear()

    def leave(names: set[str], within: tuple[str, ...] = ()) -> None:
        """Close the innermost open element of these names, unless one of ``within`` holds it."""
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                del stack[depth:]
                return
            if stack[depth][0] in within:
                return

    while tag := _TOKEN.search(page, at):
        if tag.start() > at:
            take(page[at:tag.start()])
        at = tag.end()
        if not tag["name"]:
            continue
        name = tag["name"].lower()
        if name in RAW:
            if not tag["close"] and not tag["attrs"].endswith("/"):
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else len(page)
        if name not in BLOCK:
            if name == "a":
                link = not tag["close"]
            block.tags.append(name)
            continue
        end()
        link = False
        block.tags.append(name)
        if name in VOID:
            continue
        if tag["close"]:
            leave({name})
            continue
        if name not in ("html", "body"):
            leave({"p"}, ("table", "td", "th", "button"))
        leave(CLOSES.get(name, set()), ("ul", "ol", "dl", "table"))
        own, marks = _traits(tag["attrs"]) if tag["attrs"] else (set(), False)
        marks |= name in ("article", "main")
        _, above, marked = stack[-1] if stack else ("", frozenset(), False)
        if name in BOILERPLATE:
            own = own | {name}
        if marked:
            own = own - OWN_HEADER
        elif marks:
            above = above - LEFT_OPEN
        if len(stack) < DEPTH:
            stack.append((name, above | own, marked or marks))
    if at < len(page):
        take(page[at:])
    end()
    return out


def features_of(blocks: list[Block]) -> list[frozenset]:
    """All features of each block: declared ones, its innermost element, its share of links.
    A form around nearly all of the page says nothing about its parts."""
    words = sum(b.words for b in blocks)
    around = frozenset({"form"}) if 10 * sum(b.words for b in blocks if "form" in b.features) >= 9 * words else frozenset()
    out = []
    for b in blocks:
        share = b.linked / b.words
        out.append((b.features - around) | {b.nearest, "links:most" if share > 0.5 else "links:some" if share > 0.2 else "links:few"})
    return out


def _declared(feature: str) -> bool:
    return feature in BOILERPLATE or feature.startswith("k:")


def _kind(feature: str) -> str:
    return "declared" if _declared(feature) else "generic" if feature in GENERIC else "textual"


def labelled(blocks: list[Block]) -> bool:
    """Whether the page marks its article: marked parts, others than declared ones (as a
    comment in an ``article`` element of its own), hold a share of MARKED of its words."""
    own = [b for b in blocks if not any(map(_declared, b.features))]
    marked = sum(b.words for b in own if b.marked)
    return marked > 0 and marked >= MARKED * sum(b.words for b in own)


_TAGS = BLOCK | RAW | VOID | {"a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "code", "q", "cite", "abbr", "mark", "label", "time", "font"}


@dataclass
class Model:
    """Weights of features, costs of tags, and the weight of a word about which nothing is known."""

    weights: dict[str, float]
    costs: dict[str, float]
    base: float
    use_marks: bool = True

    @classmethod
    def of(cls, counts: dict[str, tuple[float, float]], use_marks: bool = True) -> "Model":
        """From words (feature) and tags ("t:" + name) inside and outside of marked parts."""
        inside, outside = counts.get("words", (0, 0))
        balance = (inside + 40.0) / (outside + 40.0)
        weights = {}
        for f, (more, less) in PRIOR.items():
            i, o = counts.get(f, (0, 0))
            low, high = LIMITS[_kind(f)]
            weights[f] = min(high, max(low, math.log((i + more) / (o * balance + less))))
        costs = {}
        for t in [*sorted(_TAGS), "other"]:
            (i, o), (more, less) = counts.get(f"t:{t}", (0, 0)), PRIOR_TAGS["generic" if t == "other" else _kind(t)]
            costs[t] = TAG_COST * (o + less) / (i + o + more + less)
        return cls(weights, costs, min(MOST, max(0.25, math.log(balance))), use_marks)

    def word_weights(self, blocks: list[Block]) -> list[float]:
        marks = self.use_marks and labelled(blocks)
        out = []
        for b, features in zip(blocks, features_of(blocks)):
            w = self.base + sum(self.weights.get(f, 0.0) for f in sorted(features) if not _declared(f))
            if marks:
                w += LIMITS["marked"][b.marked]
            against = min((self.weights.get(f, 0.0) for f in features if _declared(f)), default=0.0)
            out.append(min(MOST, w) + min(0.0, against))
        return out

    def text(self, page: str | None) -> str:
        blocks = blocks_of(page)
        weights = self.word_weights(blocks)
        costs = [sum(self.costs.get(t, self.costs["other"]) for t in b.tags) for b in blocks]
        marks = self.use_marks and labelled(blocks)
        # what a marked part holds but is left out of its text does not divide it
        scores = [0.0 if marks and b.marked and w <= DROPPED else b.words * w for b, w in zip(blocks, weights)]
        first, last = best_region(scores, costs)
        kept = (b.text() for b, w in zip(blocks[first:last], weights[first:last]) if w > DROPPED)
        return " ".join(t for t in kept if t)


def best_region(scores: list[float], costs: list[float]) -> tuple[int, int]:
    """The run (first, behind the last) of greatest total above 0: scores minus the costs
    between them. Of equal totals the first to be complete; (0, 0) if there is none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, (score, cost) in enumerate(zip(scores, costs)):
        if total <= cost:
            total, start = 0.0, k
        else:
            total -= cost
        total += score
        if total > best:
            best, region = total, (start, k + 1)
    return region


def _count(batches):
    """mapInArrow: words and tags inside and outside of the marked parts of labelled pages."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for page in batch.column("html").to_pylist():
            blocks = blocks_of(page)
            if not labelled(blocks):
                continue
            before = False
            for b, features in zip(blocks, features_of(blocks)):
                side = 0 if b.marked and not any(map(_declared, features)) else 1
                for f in (*features, "words"):
                    counts.setdefault(f, [0, 0])[side] += b.words
                if before or not b.marked:  # the tags before a marked part neither lie in it nor outside
                    for t in b.tags:
                        counts.setdefault(f"t:{t if t in _TAGS else 'other'}", [0, 0])[0 if b.marked else 1] += 1
                before = b.marked
    names = sorted(counts)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[n][0] for n in names], pa.int64()), pa.array([counts[n][1] for n in names], pa.int64())],
                                     names=["feature", "inside", "outside"])


def learn(pages: DataFrame, html_col: str = "html", use_marks: bool = True) -> Model:
    """The model from all pages that mark their article; without any, from prior counts
    alone. Null and empty pages are no labelled pages. One row per feature (their number is
    fixed) reaches the driver. Without ``use_marks`` a page's own marks are not used when its
    text is extracted, only what was learned from others."""
    counted = pick(pages, html=html_col).mapInArrow(frugal(_count), "feature string, inside long, outside long")
    rows = counted.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return Model.of({r["feature"]: (r["inside"], r["outside"]) for r in rows}, use_marks)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, one row per input row.

    text is the main text of the whole page: blocks in page order, joined by one space, their
    character references decoded and white space turned into one space. Null and empty pages,
    and pages without any words that score above 0, have an empty text. Null ids and urls are
    kept; repeated rows and further columns of any name do no harm; an empty table gives no
    rows.
    """
    source = pick(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches):
        for batch in batches:
            texts = pa.array([model.text(page) for page in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])

    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return source.mapInArrow(frugal(run), f"{kinds}, text string").withColumn("n_chars", F.char_length("text").cast("long"))


__all__ = ["learn", "extract", "Model", "Block", "blocks_of", "best_region"]
