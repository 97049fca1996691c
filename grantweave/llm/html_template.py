"""Main text of web pages by the template of their host.

A page is a sequence of tokens: opened and closed elements, named by the open elements around them with their class
and id, and blocks of text, named by their place and content.

1. *Classes.* Over the distinct pages of a host, tokens with the same occurrence vector (the number of times each page
   has them) form an equivalence class. Vectors are compared by a sum of hashes of page and count, so a class is found by
   aggregations whose partial sums are formed before the shuffle; a host with a third of all pages costs one row per token
   and task.
2. *Order and nesting.* On each page a class repeats one order of its tokens; tokens that are elsewhere on some page leave
   it. A class is valid if all pages begin and end it in the same gap of the same other class. If texts keep it from
   repeating an order, its tags are tried alone.
3. *Slots.* Pages are cut at the tokens of valid classes. A slot is a gap between two neighbours of a class, and what lies
   there beside nested classes. A slot whose text is the same on every page that has text there is part of the template.
4. *Choice.* Text of the template goes, and of several main elements those that only hold such text. Names of a class, id or
   role break ties between slots that vary: those marked as navigation, adverts and so on go, those marked as the article
   stay. On pages without an ``article`` or ``main`` element, a slot outside elements like ``nav`` that has ``MAIN_SHARE`` of
   the varying text of its host is the article, whatever the names say. A main element that holds varying text is kept
   whole, also where other pages repeat a part of it: nothing of an article is dropped. So pages with one ``article``
   element have the text of that element with any template.

A host with one distinct page has no template, and the names alone decide.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm.tables import join_groups, stored

#: a class counts if at least this share of the host's distinct pages has it, and this many pages
MIN_SHARE = 0.5
MIN_PAGES = 2
#: text is part of the template if at least this many pages have it
CONSTANT_PAGES = 3
#: a slot with this share of a host's varying text is the article, whatever it is called
MAIN_SHARE = 2 / 3
#: templates that a task keeps unpacked
CACHED_HOSTS = 256
#: tags, paths and tokens that a task remembers
REMEMBERED = 1 << 14

#: fixed values: elements whose content is never text, and elements that stand beside an article
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "object", "canvas")
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: an open element that a new one of the same kind ends
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
#: whole names of a class, id or role that mark what is not the article
ASIDE_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "related", "replies", "respond", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
    "ad-container", "ad-slot", "comment-list", "comments-area", "cookie-banner", "cookie-consent", "cookie-notice", "disqus_thread",
    "main-navigation", "nav-links", "nav-menu", "post-navigation", "related-articles", "related-posts", "share-buttons",
    "site-footer", "site-header", "site-navigation", "social-links", "social-share", "widget-area",
}
#: parts of a compound name, such as ``sidebar-left``, that mark it, and first parts that say another thing
ASIDE_PARTS = {
    "ad", "ads", "advert", "breadcrumb", "breadcrumbs", "comments", "cookie", "cookies", "menu", "nav", "navigation", "sidebar",
}
NOT_ITSELF = {"has", "is", "no", "with", "without"}
#: the ids of headings and sections are mostly slugs of their titles; of a section, only these count
SECTION_IDS = {
    "comments", "comments-area", "disqus", "disqus_thread", "footer", "header", "masthead", "nav", "navbar", "navigation", "respond", "sidebar",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MAIN_WORDS = {
    "article", "content", "main", "story", "post", "article-body", "article-content", "entry", "entry-content", "hentry", "main-content",
    "page-content", "post-body", "post-content", "story-body",
}

#: the attributes of a tag: a ``>`` in a quoted value does not end it, and a quote that is never closed is an ordinary
#: character
_INSIDE = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*?"""
#: names go on after a hyphen or colon, so ``svg-icon`` is not ``svg``; an element that closes itself has no content
_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<svg(?![\w:-]){_INSIDE}/>"
    rf"|<(?P<raw>{'|'.join(RAW)})(?![\w:-]){_INSIDE}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-z][\w:-]*)(?P<inside>{_INSIDE})>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_attribute = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_words = re.compile(r"[a-z]+")
_parts = re.compile(r"[-_]+")


def _aside_compound(name: str) -> bool:
    parts = _parts.split(name)
    return len(parts) > 1 and parts[0] not in NOT_ITSELF and not ASIDE_PARTS.isdisjoint(parts)


def _hash(name: str) -> int:
    """64 bits as a signed number."""
    found = xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass"))
    return found - (1 << 64) if found >> 63 else found


@lru_cache(REMEMBERED)
def _path(parent: int, label: str) -> int:
    return _hash(f"{parent}/{label}")


@lru_cache(REMEMBERED)
def _tag_token(kind: str, path: int) -> int:
    return _hash(f"{kind} {path}") & ~1


@lru_cache(REMEMBERED)
def _told(name: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """What a tag says: its name in paths, and whether it stands beside the article, is marked so by name, or is the article."""
    marks: set[str] = set()
    names: set[str] = set()
    for key, *values in _attribute.findall(attributes) if attributes else ():
        value = " ".join(values).lower()
        marks.update(_words.findall(value))
        found = set(value.split())
        if key.lower() == "id" and name in HEADINGS:
            continue
        names |= found & SECTION_IDS if key.lower() == "id" and name == "section" else found
    return (
        ".".join([name, *sorted(marks)]),
        name in ASIDE,
        name not in ("html", "body") and (not ASIDE_WORDS.isdisjoint(names) or any(map(_aside_compound, names))),
        name in ("article", "main") or (name in ("div", "section") and not MAIN_WORDS.isdisjoint(names)),
    )


class Element:
    """An open element: what it is called in paths, whether it is the article or stands beside it.

    ``beside`` is whether its own tag says so, ``marked`` whether its own names do. ``aside`` has what holds
    it as well; names on an element that holds the article do not count, see ``clear``. ``tagged`` is ``aside``
    by tags alone. ``path`` is a hash of the path, so that deep nesting costs no more than shallow.
    """

    __slots__ = ("name", "path", "depth", "parent", "beside", "marked", "aside", "tagged", "main")

    def __init__(self, name: str, attributes: str, parent: "Element | None"):
        label, self.beside, self.marked, self.main = _told(name, attributes)
        self.name = name
        self.path = _path(parent.path if parent else 0, label)
        self.depth = parent.depth + 1 if parent else 1
        self.parent = parent
        self.aside = bool(parent and parent.aside) or self.beside or self.marked
        self.tagged = bool(parent and parent.tagged) or self.beside

    def above(self) -> Iterator["Element"]:
        """The elements that hold it, innermost first."""
        held = self.parent
        while held:
            yield held
            held = held.parent


def read(page: str) -> Iterator[tuple[str, Element | None, str]]:
    """Kind (``open``, ``close``, ``break`` or ``text``), the element it is in, and the text."""
    stack: list[Element] = []
    at = 0

    def top() -> Element | None:
        return stack[-1] if stack else None

    for m in _token.finditer(page):
        if m.start() > at:
            yield "text", top(), page[at : m.start()]
        at = m.end()
        name = (m["name"] or "").lower()
        if name in ("br", "hr"):
            yield ("text", top(), " ") if name == "br" else ("break", top(), "")
        if not name or name in VOID or name in INLINE:
            continue
        if m["end"]:
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if where is not None:
                yield "close", stack[where], ""
                del stack[where:]
            else:
                yield "break", top(), ""
        else:
            # A paragraph ends where any block begins, an item where the next of its kind does.
            if stack and (stack[-1].name == "p" or stack[-1].name == name and name in SELF_CLOSING):
                stack.pop()
            stack.append(Element(name, m["inside"], top()))
            yield "open", stack[-1], ""
    if at < len(page):
        yield "text", top(), page[at:]


class Piece(NamedTuple):
    """An opened or closed element, or a block of text in one."""

    kind: str
    element: Element | None
    text: str

    def token(self) -> int:
        """Odd for text, even for tags."""
        path = self.element.path if self.element else 0
        return _hash(f"{path} {self.text}") | 1 if self.kind == "text" else _tag_token(self.kind, path)


def pieces(page: str) -> list[Piece]:
    """The page with the text of each block in one piece: references decoded, white space as one space, never empty."""
    found: list[Piece] = []
    held: list[str] = []
    inside: Element | None = None

    def end() -> None:
        block = " ".join(html.unescape("".join(held)).split())
        if block:
            found.append(Piece("text", inside, block))
        held.clear()

    for kind, element, text in read(page):
        if kind == "text":
            held.append(text)
            inside = element
            continue
        end()
        if kind != "break":
            found.append(Piece(kind, element, ""))
    end()
    return found


def clear(elements: list[Element], article: Element) -> None:
    """Names on what holds the article do not make it stand beside itself; tags do."""
    for e in article.above():
        e.marked = False
    for e in elements:
        e.aside = bool(e.parent and e.parent.aside) or e.beside or e.marked


def order_of(tokens: list[int]) -> list[int] | None:
    """The order that the tokens of one class repeat on a page; None if they do not repeat one."""
    order = list(dict.fromkeys(tokens))
    return order if tokens == order * (len(tokens) // len(order)) else None


def out_of_order(usual: list[int], order: list[int]) -> list[int]:
    """The tokens outside a longest part of ``order`` that is in the usual order too."""
    rank = {t: k for k, t in enumerate(usual)}
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, t in enumerate(order):
        at = bisect_left(tails, rank[t])
        before.append(ends[at - 1] if at else -1)
        tails[at : at + 1] = [rank[t]]
        ends[at : at + 1] = [k]
    kept: set[int] = set()
    k = ends[-1] if ends else -1
    while k >= 0:
        kept.add(order[k])
        k = before[k]
    return [t for t in order if t not in kept]


class Gap(NamedTuple):
    """A gap of a class on a page, and the outermost gap around it."""

    owner: int
    index: int
    outer_owner: int
    outer_index: int

    @property
    def slot(self) -> int:
        return _hash(f"{self.owner}:{self.index}")

    @property
    def top(self) -> int:
        return _hash(f"{self.outer_owner}:{self.outer_index}")


#: outside all classes
OUTSIDE = Gap(0, 0, 0, 0)


def cut(tokens: list[int], orders: dict[int, list[int]]) -> list[tuple[int | None, Gap]]:
    """Of each token, the class it belongs to (None: none) and the gap it lies in. A token out of turn is no template token."""
    place = {t: (c, i) for c, order in orders.items() for i, t in enumerate(order)}
    open_classes: list[list[int]] = []
    level: dict[int, int] = {}
    found: list[tuple[int | None, Gap]] = []

    def leave(depth: int) -> None:
        for c, _ in open_classes[depth:]:
            del level[c]
        del open_classes[depth:]

    def gap() -> Gap:
        if not open_classes:
            return OUTSIDE
        (outer, at), (inner, index) = open_classes[0], open_classes[-1]
        return Gap(inner, index, outer, at)

    here = OUTSIDE
    for token in tokens:
        c, i = place.get(token, (None, 0))
        if c is None or (i > 0 and (c not in level or open_classes[level[c]][1] != i - 1)):
            found.append((None, here))
            continue
        if i == 0:
            leave(level.get(c, len(open_classes)))
            found.append((c, gap()))
            level[c] = len(open_classes)
            open_classes.append([c, 0])
        else:
            leave(level[c] + 1)
            found.append((c, gap()))
            open_classes[-1][1] = i
        if i == len(orders[c]) - 1:
            leave(level[c])
        here = gap()
    return found


class Template:
    """The valid classes of a host with their order, and its slots: whether their text varies, and the one with most of it."""

    def __init__(self, classes: list[dict], slots: list[dict]):
        self.orders = {c["owner"]: c["order"] for c in classes}
        self.constant = {s["slot"] for s in slots if not s["varies"]}
        weights: Counter = Counter()
        for s in slots:
            if s["varies"]:
                weights[s["top"]] += s["chars"]
        top, weight = max(weights.items(), key=lambda w: (w[1], w[0]), default=(0, 0))
        self.main = top if top and weight >= MAIN_SHARE * sum(weights.values()) and weight > 0 else None


def roots_of(elements: list[Element]) -> set[Element]:
    """The main elements that do not hold each other: the best kind first, of one kind the outermost."""
    mains = [e for e in elements if e.main and not e.aside]
    roots: set[Element] = set()
    over: set[Element] = set()
    for e in sorted(mains, key=lambda e: (_rank(e), e.depth)):
        if e in over or not roots.isdisjoint(e.above()):
            continue
        roots.add(e)
        over.update(e.above())
    return roots


def main_text(page: str, template: Template | None) -> str:
    """The article's blocks, one per line; without a template by the names of the page alone."""
    found = pieces(page)
    elements = [p.element for p in found if p.kind == "open"]
    for e in elements:
        if e.name == "main" and e.aside and any(x.marked for x in e.above()):
            clear(elements, e)
    text = _chosen(found, elements, template)
    if not text:
        # Nothing is left: an article inside an element with such a name is the article after all.
        for e in elements:
            if e.name == "article" and e.aside and not e.marked and any(x.marked for x in e.above()):
                clear(elements, e)
        text = _chosen(found, elements, template)
    return text


def _chosen(found: list[Piece], elements: list[Element], template: Template | None) -> str:
    roots = roots_of(elements)
    if template is None or (len(roots) == 1 and all(_rank(e) < 2 for e in roots)):
        # An article element that is the only one is kept whole with any template.
        return _blocks(found, elements, roots)
    places = cut([p.token() for p in found], template.orders)
    fixed = {k for k, (c, gap) in enumerate(places) if found[k].kind == "text" and (c is not None or gap.slot in template.constant)}
    texts = [k for k, p in enumerate(found) if p.kind == "text"]
    if fixed.issuperset(texts):
        return _blocks(found, elements, roots)
    varying = _roots_with([found[k].element for k in texts if k not in fixed], roots)
    if any(_rank(e) < 2 for e in roots):
        return _blocks(found, elements, varying or roots)
    chief = {found[k].element for k in texts if k not in fixed and places[k][1].top == template.main} - {None}
    chief = {e for e in chief if not e.tagged}
    if any(e.aside for e in chief):
        for e in chief:
            for x in (e, *e.above()):
                x.marked = False
        for e in elements:
            e.aside = bool(e.parent and e.parent.aside) or e.beside or e.marked
    if chief and not _roots_with(list(chief), varying):
        varying = set()
    return _blocks(found, elements, varying, frozenset() if varying else fixed) or _blocks(found, elements, roots)


def _roots_with(inside: list[Element | None], roots: set[Element]) -> set[Element]:
    """Those roots that hold one of these elements and do not set it aside."""
    held: set[Element] = set()
    seen: set[Element] = set()
    for e in inside:
        if e is None or e.aside:
            continue
        for x in (e, *e.above()):
            if x in seen:
                break
            seen.add(x)
            if x in roots:
                held.add(x)
    return held


def _blocks(found: list[Piece], elements: list[Element], roots: set[Element], fixed: set[int] = frozenset()) -> str:
    """The text in ``roots``, or of the whole page if there are none, but not what stands beside it nor what is ``fixed``."""
    kept: set[Element | None] = set() if roots else {None}
    for e in elements:
        if not e.aside and (not roots or e in roots or e.parent in kept):
            kept.add(e)
    return "\n".join(p.text for k, p in enumerate(found) if p.kind == "text" and p.element in kept and k not in fixed)


def _rank(element: Element) -> int:
    return 0 if element.name == "article" else 1 if element.name == "main" else 2


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


def tokenized(pages: DataFrame) -> DataFrame:
    """Of each page its host, a digest, its tokens and, per token, characters of text: 0 for tags, negative in ``nav`` and such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, chars, digests = [], [], []
            for page in batch.column(1).to_pylist():
                found = pieces(page or "")
                tokens.append([p.token() for p in found])
                chars.append([-len(p.text) if p.element and p.element.tagged else len(p.text) for p in found])
                digests.append(_hash(" ".join(map(str, tokens[-1]))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(digests, pa.int64()), pa.array(tokens, pa.list_(pa.int64())),
                    pa.array(chars, pa.list_(pa.int64())),
                ],
                ["host", "page", "digest", "tokens", "chars"],
            )

    return pages.select("host", "html", F.monotonically_increasing_id()).mapInArrow(
        run, "host string, page long, digest long, tokens array<long>, chars array<long>"
    )


def equivalence_classes(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """Of each host: ``members``, the tokens of its frequent classes with the class they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([list(c) for c in counts], pa.list_(pa.int64())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                ],
                ["host", "page", "token", "times"],
            )

    counted = pages.select("host", "page", "tokens").mapInArrow(run, "host string, page long, token array<long>, times array<long>")
    vectors = (
        counted.select("host", "page", F.inline(F.arrays_zip("token", "times")))
        .groupBy("host", "token")
        .agg(F.sum(F.xxhash64("page", "times").cast("decimal(38,0)")).alias("vector"), F.count(F.lit(1)).alias("support"))
    )
    least = F.when(F.col("token").bitwiseAND(F.lit(1)) == 1, CONSTANT_PAGES).otherwise(MIN_PAGES)
    frequent = (F.col("support") >= least) & (F.col("support") >= MIN_SHARE * F.col("_n"))
    return (
        join_groups(vectors, sizes, ["host"], "_n")
        .filter(frequent)
        .groupBy("host")
        .agg(F.collect_list(F.struct("token", F.xxhash64("vector").alias("owner"))).alias("members"))
    )


def ordered_classes(pages: DataFrame, members: DataFrame) -> DataFrame:
    """Of each host: ``classes``, each with the order of its tokens that most pages have, less tokens that are elsewhere on some page.

    A class that does not repeat one order on some page is tried again without its texts, else it is no class.
    """

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, tokens, found in zip(*(c.to_pylist() for c in batch.columns)):
                owner = {m["token"]: m["owner"] for m in found}
                runs: dict[int, list[int]] = {}
                for token in tokens:
                    if token in owner:
                        runs.setdefault(owner[token], []).append(token)
                for c, run in runs.items():
                    tags = [t for t in run if not t & 1]
                    rows.append((host, c, order_of(run), order_of(tags) if tags else None))
            yield _batch(rows, host=pa.string(), owner=pa.int64(), whole=pa.list_(pa.int64()), tags=pa.list_(pa.int64()))

    found = join_groups(pages, members, ["host"], "_n").select("host", "tokens", "members").mapInArrow(
        orders, "host string, owner long, whole array<long>, tags array<long>"
    )
    # Equal orders are counted before those of a host meet, so a large host sends one row per order and task.
    counted = stored(found.groupBy("host", "owner", "whole", "tags").agg(F.count(F.lit(1)).alias("pages")), "orders")
    usual = counted.groupBy("host", "owner").agg(
        *(F.max_by(c, F.struct("pages", c)).alias(c) for c in ("whole", "tags")),
        *(F.bool_and(F.col(c).isNotNull()).alias(f"{c}_repeats") for c in ("whole", "tags")),
    )
    by_whole = F.when(F.col("whole_repeats"), F.col("whole"))
    chosen = usual.select(
        "host", "owner", F.coalesce(by_whole, F.when(F.col("tags_repeats"), F.col("tags"))).alias("order"), F.col("whole_repeats").alias("with_text")
    ).filter("order is not null")

    @F.pandas_udf("array<long>")
    def moved(usual_order: pd.Series, order: pd.Series) -> pd.Series:
        return pd.Series([out_of_order(list(a), list(b)) for a, b in zip(usual_order, order)])

    leaving = (
        counted.join(chosen, ["host", "owner"])
        .withColumn("here", F.when(F.col("with_text"), F.col("whole")).otherwise(F.col("tags")))
        .filter(F.col("here") != F.col("order"))
        .select("host", "owner", F.explode(moved("order", "here")).alias("token"))
        .groupBy("host", "owner")
        .agg(F.collect_set("token").alias("moved"))
    )
    kept = chosen.join(leaving, ["host", "owner"], "left").select(
        "host", "owner", F.array_except("order", F.coalesce("moved", F.array().cast("array<long>"))).alias("order")
    )
    return kept.filter("size(order) > 0").groupBy("host").agg(F.collect_list(F.struct("owner", "order")).alias("classes"))


def nested_classes(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """Of each host: ``classes``, those that begin in the same gap of the same class on all pages and end there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, tokens, found in zip(*(c.to_pylist() for c in batch.columns)):
                orders = {f["owner"]: f["order"] for f in found}
                owner = {t: c for c, order in orders.items() for t in order}
                parents: dict[int, set[int | None]] = {}
                for token, (c, gap) in zip(tokens, cut(tokens, orders)):
                    if token not in owner:
                        continue
                    if c is None:
                        # Another class of the page lies across this one.
                        parents.setdefault(owner[token], set()).add(None)
                    elif gap.owner != c:
                        parents.setdefault(c, set()).add(gap.slot)
                rows += [(host, c, next(iter(p)) if len(p) == 1 else None) for c, p in parents.items()]
            yield _batch(rows, host=pa.string(), owner=pa.int64(), parent=pa.int64())

    placed = join_groups(pages, classes, ["host"], "_n").select("host", "tokens", "classes").mapInArrow(
        run, "host string, owner long, parent long"
    )
    nested = placed.groupBy("host", "owner").agg(
        (F.bool_and(F.col("parent").isNotNull()) & (F.min("parent") == F.max("parent"))).alias("nested")
    )
    return (
        classes.select("host", F.inline("classes"))
        .join(nested.filter("nested"), ["host", "owner"])
        .groupBy("host")
        .agg(F.collect_list(F.struct("owner", "order")).alias("classes"))
    )


def slot_figures(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """Of each host: ``slots``, each with its outermost slot, whether its text varies over the pages, and its characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, tokens, chars, found in zip(*(c.to_pylist() for c in batch.columns)):
                held: dict[Gap, list[int]] = {}
                weight: Counter = Counter()
                for token, size, (c, gap) in zip(tokens, chars, cut(tokens, {f["owner"]: f["order"] for f in found})):
                    if size and c is None:
                        held.setdefault(gap, []).append(token)
                        weight[gap] += max(size, 0)
                rows += [(host, g.slot, g.top, _hash(" ".join(map(str, t))), weight[g]) for g, t in held.items()]
            yield _batch(rows, host=pa.string(), slot=pa.int64(), top=pa.int64(), text=pa.int64(), chars=pa.int64())

    cuts = join_groups(pages, classes, ["host"], "_n").select("host", "tokens", "chars", "classes").mapInArrow(
        run, "host string, slot long, top long, text long, chars long"
    )
    varies = (F.min("text") != F.max("text")) | (F.count(F.lit(1)) < CONSTANT_PAGES)
    figures = cuts.groupBy("host", "slot").agg(F.max("top").alias("top"), varies.alias("varies"), F.sum("chars").alias("chars"))
    return figures.groupBy("host").agg(F.collect_list(F.struct("slot", "top", "varies", "chars")).alias("slots"))


def templates(pages: DataFrame) -> DataFrame:
    """Of each ``host``: ``_rows`` pages, ``_n`` distinct ones, its valid ``classes`` and its ``slots``, both null without a template."""
    tokens = stored(tokenized(pages), "page_tokens")
    sizes = stored(
        tokens.groupBy("host").agg(F.count(F.lit(1)).alias("_rows"), F.countDistinct("digest").alias("_n")), "hosts"
    )
    shared = stored(sizes.filter(F.col("_n") >= MIN_PAGES).select("host", "_n"), "shared_hosts")
    # Pages that are fetched twice count once.
    firsts = tokens.groupBy("host", "digest").agg(F.min("page").alias("page"))
    distinct = stored(tokens.join(firsts.select("page"), "page", "left_semi"), "distinct_pages")
    members = stored(equivalence_classes(distinct, shared).join(shared, "host"), "classes")
    ordered = stored(ordered_classes(distinct, members).join(shared, "host"), "ordered_classes")
    nested = stored(nested_classes(distinct, ordered).join(shared, "host"), "nested_classes")
    found = nested.join(slot_figures(distinct, nested), "host").select("host", "classes", "slots")
    return stored(sizes.join(found, "host", "left").select("host", "_rows", "_n", "classes", "slots"), "templates")


def extracted(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """The page id, url, ``text`` and ``n_chars`` of every row.

    Text is the article: its blocks in page order, one per line, character references decoded, white space as
    one space. Null html counts as empty and has empty text; rows without a url are one host. Repeated rows
    are read each for itself and count once for the template; an empty table gives no rows, and other columns are not read.
    Very long pages are read whole, in time linear in their length.
    """
    host = F.coalesce(
        F.lower(F.regexp_extract(F.col(f"`{url_column}`").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")
    )
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").cast("string").alias("html"), host.alias("host")
    )
    joined = join_groups(rows, templates(rows), ["host"], "_rows").select("id", "url", "html", "host", "classes", "slots")
    schema = T.StructType(
        [
            T.StructField(id_column, pages.schema[id_column].dataType),
            T.StructField(url_column, pages.schema[url_column].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template | None] = {}
        for batch in batches:
            texts = []
            for k, (page, name) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if name not in known:
                    if len(known) >= CACHED_HOSTS:
                        known.clear()
                    classes, slots = batch.column(4)[k].as_py(), batch.column(5)[k].as_py()
                    known[name] = Template(classes, slots) if classes and slots else None
                texts.append(main_text(page or "", known[name]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                schema.names,
            )

    return joined.mapInArrow(run, schema)
