"""Main text of web pages, by template deduction over equivalence classes.

A page is a sequence of tokens: opening and closing tags (with class, id and role) and runs of text, each
told apart by the names of the elements around it. Within a host, tokens with one occurrence vector - as
many times on each page - form an equivalence class. A vector is kept as sums of hashes of (page, count), so
classes come from one aggregate by (host, token), combined in each task first. Only tokens on nearly all of
a host's pages are gathered by host, which are no more than a page has. Pages with equal content count once,
so copies do not make a template.

A class has several tokens, and they follow in one order: that of their mean places. A second pass tests it.
On each page the longest stretch of a class's tokens in that order is in order; the class of the tokens that
are once on every page is the spine, and its tokens in order part the page into slots. The tokens of other
classes repeat in their order, cycle after cycle, and nest in the spine: in one slot, or as often in the
same slots. A token is template if this holds, in one way, on nearly all pages.

What the template leaves, the slots, is data. A run of text belongs to the template only where it stands in
order and in its slot. The main text is the data inside the article: the ``article`` or ``main`` elements, or
else the deepest template element that holds most of the data. Inside it, elements that say what they are
(menus, asides, forms, adverts, comments, ...) and text that belongs to the template go. An article that has
no data at all is the same on all pages of its host; its text stays.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..session import checked_broadcast
from .common import spread, stored, text_slices

LEAST_PAGES = 5
SUPPORT = 0.95
CLASS_SIZE = 3
MOST_OF_TEXT = 0.6
#: Hosts whose templates are broadcast; those of more are joined.
BROADCAST_HOSTS = 5_000

#: What may stand in a tag: a tag that is not closed before the next one begins is text.
_INNER = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|iframe|svg)\b" + _INNER + r">.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[a-zA-Z]" + _INNER + r">|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that are never part of an article, and words in class, id and role that say so.
OUTSIDE = frozenset("head title nav footer aside form script style noscript template iframe svg select button textarea menu dialog object audio video canvas".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar nav navbar navigation menu menus "
    "breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe subscription popup modal "
    "overlay widget widgets pagination pager login signup search toolbar complementary contentinfo skip".split()
)
#: Elements that say nothing of what they hold.
FRAMES = frozenset("body center div section td".split())
WHOLE = frozenset("html body main article".split())


@dataclass(slots=True)
class Tag:
    """What a tag says by itself."""

    name: str
    closes: bool
    key: str = ""
    empty: bool = False  # holds nothing
    inline: bool = False
    outside: bool = False  # by its name
    says: bool = False  # by a word in class, id or role
    article: bool = False


@dataclass(slots=True)
class Element:
    tag: Tag
    parent: Element | None
    at: int  # elements are numbered in page order
    path: int
    token: int
    outside: bool
    says: bool
    block: int  # depth of the nearest element around it, or itself, that is not inline
    depth: int
    in_article: bool
    chars: int = 0
    end: int = 0  # the number after those of the elements inside


@dataclass
class Page:
    """Tokens with their hashes; of each run of text the element that holds it and whether a block ends before it."""

    tokens: list[int] = field(default_factory=list)
    runs: list[tuple[int, str, Element, bool]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) >> 1


@lru_cache(50_000)
def _named(path: int, mark: str, key: str) -> int:
    return _hash(f"{path:x}{mark}{key}")


def _tag(token: str) -> Tag | None:
    found = _NAME.match(token)
    if not found:
        return None
    name = found.group(1).lower()
    if token[1] == "/":
        return Tag(name, True)
    marks = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(token)}
    says = name not in WHOLE and _outside_words(marks)
    if name == "article":
        says = any(w in ("comment", "comments", "reply") for k in ("class", "id", "role") for w in marks.get(k, "").split())
    article = name in ("article", "main") or marks.get("role") == "main" or "articlebody" in marks.get("itemprop", "")
    empty = name in VOID or token.endswith("/>") and name not in ("p", "div", "li")
    return Tag(name, False, ".".join([name, *(f"{k}={v}" for k, v in sorted(marks.items()))]), empty, name in INLINE, name in OUTSIDE, says, article)


#: Tags repeat within a host; longer ones are read anew.
_short_tag = lru_cache(50_000)(_tag)
SHORT = 300
#: Elements that the next of their kind closes.
ENDED = frozenset("p li td th tr dt dd option".split())


def parse(text: str | None) -> Page:
    """The page's tokens, in time that grows with the page. Tags that do not match are repaired: a closing tag closes what is open inside it."""
    page = Page()
    root = Element(Tag("", False), None, 0, 0, 0, False, False, 0, 0, False)
    page.elements.append(root)
    stack, broken = [root], True
    open_at: dict[str, list[int]] = {}  # depths of the open elements of each name

    def close(depth: int) -> None:
        for e in reversed(stack[depth:]):
            open_at[e.tag.name].pop()
        del stack[depth:]

    for m in _TOKEN.finditer(text or ""):
        token = m.group()
        if token[0] != "<" or token == "<":
            if not token.isspace():
                clean = entities.unescape(token)
                top = stack[-1]
                page.runs.append((len(page.tokens), clean, top, broken))
                page.tokens.append(_hash(f"{top.path:x}=" + " ".join(clean.split())))
                broken = clean[-1:].isspace()
            else:
                broken = True
            continue
        tag = None if m.group(1) else _short_tag(token) if len(token) < SHORT else _tag(token)
        if tag is None:
            continue  # a comment, declaration, script or style
        if tag.closes:
            depths = open_at.get(tag.name)
            if depths:
                at = depths[-1]
                page.tokens.append(_named(stack[at].path, "/", stack[at].tag.key))
                broken |= any(not e.tag.inline for e in stack[at:])
                close(at)
            continue
        broken |= not tag.inline
        if tag.empty:
            page.tokens.append(_named(stack[-1].path, "<", tag.key))
            continue
        if tag.name in ENDED and (block := stack[-1].block) and stack[block].tag.name == tag.name:
            close(block)
        top = stack[-1]
        depth = len(stack)
        path = _named(top.path, ">", tag.name)
        outside = tag.outside or tag.name == "header" and not top.in_article
        own = Element(tag, top, len(page.elements), path, _named(path, "<", tag.key), outside, tag.says, top.block if tag.inline else depth, depth, top.in_article or tag.article)
        page.tokens.append(own.token)
        page.elements.append(own)
        open_at.setdefault(tag.name, []).append(depth)
        stack.append(own)
    _settle(page)
    return page


def _outside_words(marks: dict[str, str]) -> bool:
    """Whether a whole word of class, id or role says that the element is outside; ``ad-box`` and ``cookie-notice`` are words too."""
    for k in ("class", "id", "role"):
        for word in marks.get(k, "").split():
            parts = _PART.findall(word)
            if parts and (word in OUTSIDE_WORDS or "".join(parts) in OUTSIDE_WORDS or all(p in OUTSIDE_WORDS for p in parts)):
                return True
    return False


def _settle(page: Page) -> None:
    """What is outside: elements by name or word and all in them. A word does not count where a main element, or the page's only articles, lie inside."""
    elements = page.elements
    hidden, saying, named = [False], [-1], [False]  # of what is around an element: outside, the nearest that says so, an article that does
    free, held = False, []
    for e in elements[1:]:
        up = e.parent
        hidden.append(hidden[up.at] or up.outside)
        saying.append(up.at if up.says else saying[up.at])
        named.append(named[up.at] or up.says and up.tag.name == "article")
        if e.tag.article and not e.outside and not e.says and not hidden[e.at]:
            free |= saying[e.at] < 0
            held.append(e)
    for e in held:
        around = saying[e.at]
        if around >= 0 and (e.tag.name != "article" or not free) and not named[e.at]:
            while around >= 0 and elements[around].says:
                elements[around].says = False
                around = saying[around]
    for e in elements:
        e.outside |= e.says or e.parent is not None and e.parent.outside
        e.end = e.at + 1
    for e in reversed(elements[1:]):
        e.parent.end = max(e.parent.end, e.end)


def _container(page: Page, places: dict[int, tuple[int, int, int]], template: set[int]) -> list[Element]:
    """The articles, or else the deepest element of the template, or one that only frames others, with most of the text that is not template."""
    shown = [(at, len(clean), e) for at, clean, e, _ in page.runs if not e.outside]
    slots = [r for r in shown if r[0] not in template] or shown
    for some in (shown, slots):
        for e in page.elements:
            e.chars = 0
        for _, n, e in some:
            e.chars += n
        for e in reversed(page.elements[1:]):
            e.parent.chars += e.chars
        articles = [e for e in page.elements if e.tag.article and not e.outside and e.chars]
        if some is shown and articles:
            return [e for e in articles if e.tag.name == "article"] or articles
    root = best = page.elements[0]
    for e in page.elements[1:]:  # opened in page order, so deeper ones come later
        known = not places or e.token in places or e.tag.name in FRAMES
        if known and not e.outside and not e.tag.inline and e.tag.name != "p" and e.chars >= MOST_OF_TEXT * root.chars and e.at < best.end:
            best = e
    return [best]


def _inside(page: Page, holders: list[Element]) -> list[bool]:
    """For each element whether it is in one of the holders or is one."""
    inside = [False] * len(page.elements)
    for e in holders:
        inside[e.at] = True
    for e in page.elements[1:]:
        inside[e.at] |= inside[e.parent.at]
    return inside


def _in_order(keys: list[int]) -> list[int]:
    """Indices of a longest strictly rising part."""
    if all(x < y for x, y in zip(keys, keys[1:])):
        return list(range(len(keys)))
    ends, last, back = [], [], []
    for n, k in enumerate(keys):
        at = bisect_left(ends, k)
        back.append(last[at - 1] if at else -1)
        ends[at : at + 1], last[at : at + 1] = [k], [n]
    out, n = [], last[-1]
    while n >= 0:
        out.append(n)
        n = back[n]
    return out[::-1]


def aligned(tokens: list[int], places: dict[int, tuple[int, int, int]]) -> dict[int, tuple[list[int], list[int], bool]]:
    """Of each token in ``places`` (token to class, rank and nest; class 0 is the spine) on a page: where it is in order, in which slots, and whether it is so everywhere."""
    classes: dict[int, list[tuple[int, int, int]]] = {}
    times: Counter = Counter()
    for at, t in enumerate(tokens):
        if (place := places.get(t)) is not None:
            turn = times[t] << 32 if place[0] else 0
            times[t] += 1
            classes.setdefault(place[0], []).append((at, t, turn + place[1]))
    spine = [classes[0][n] for n in _in_order([k for *_, k in classes[0]])] if 0 in classes else []
    edges, out = [at for at, *_ in spine], {}
    for of, own in classes.items():
        for at, t, _ in spine if not of else [own[n] for n in _in_order([k for *_, k in own])]:
            found = out.setdefault(t, ([], []))
            found[0].append(at)
            before = bisect_left(edges, at)
            found[1].append(0 if not of else 1 + (spine[before - 1][2] + 1 if before else 0))
    return {t: (ats, slots, len(ats) == times[t]) for t, (ats, slots) in out.items()}


def _nest(slots: list[int]) -> int:
    """The slot of a token, or one number for the slots of its occurrences."""
    return slots[0] if min(slots) == max(slots) else _hash(",".join(map(str, slots))) | 1 << 62


def template_places(tokens: list[int], places: dict[int, tuple[int, int, int]]) -> set[int]:
    """Positions on a page where template tokens stand in order and in their slots."""
    out: set[int] = set()
    for t, (ats, slots, _) in aligned(tokens, places).items():
        nest = places[t][2]
        out.update(ats if _nest(slots) == nest else [at for at, slot in zip(ats, slots) if slot == nest])
    return out


def main_text(text: str | None, places: dict[int, tuple[int, int, int]] | None = None) -> str:
    """Blocks of the article joined by one space; the empty text if there is none."""
    page, places = parse(text), places or {}
    template = template_places(page.tokens, places) if places else set()
    held = _inside(page, _container(page, places, template))
    inside = [r for r in page.runs if not r[2].outside and held[r[2].at]]
    if all(r[0] in template for r in inside):
        template = set()
    out, gap = [], False
    for at, clean, _, broken in inside:
        gap |= broken
        if at in template:
            gap = True
            continue
        out.append(" " + clean if gap else clean)
        gap = False
    return " ".join("".join(out).split())


class Places:
    """Templates of hosts as ``aligned`` wants them; a few are kept."""

    def __init__(self):
        self.kept: dict[str, dict] = {}

    def of(self, host: str, rows: pa.Scalar) -> dict[int, tuple[int, int, int]]:
        if not rows.is_valid:
            return {}
        if host not in self.kept:
            if len(self.kept) >= 200:
                self.kept.clear()
            four = rows.values.to_numpy(zero_copy_only=False).reshape(-1, 4).tolist()
            self.kept[host] = {t: (of, rank, nest) for t, of, rank, nest in four}
        return self.kept[host]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of enough tokens of a host, as rows of four: token, class, rank, and a nest not known yet."""
    for part in batches:
        flat = []
        for rows in part.column("tokens").to_pylist():
            classes: dict[tuple, list[tuple[int, int]]] = {}
            for r in rows:
                classes.setdefault((r["pages"], r["a"], r["b"]), []).append((r["at"], r["token"]))
            spine = next(k for k, own in classes.items() if (0, -1) in own)
            out, n = [], 0
            for k, own in sorted(classes.items()):
                if len(own) >= CLASS_SIZE:
                    n += k != spine
                    for rank, (_, t) in enumerate(sorted(x for x in own if x[1] != -1)):
                        out += [t, 0 if k == spine else n, rank, 0]
            flat.append(out)
        yield pa.RecordBatch.from_arrays([part.column("host"), part.column("of"), pa.array(flat, pa.list_(pa.int64()))], ["host", "of", "template"])


def supported(found: DataFrame) -> DataFrame:
    """``(host, of, tokens)`` of the rows of ``found`` on nearly all of their host's ``of`` pages; others are left out before anything is gathered."""
    hosts = checked_broadcast(found.where("token = -1").select("host", F.col("pages").alias("of")))
    near = found.join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("of"))
    return near.groupBy("host", "of").agg(F.collect_list(F.struct("token", "pages", "a", "b", "at")).alias("tokens"))


def templates(pages: DataFrame) -> DataFrame:
    """``(host, template array<long>)``: token, class, rank and nest of the template tokens of each host that has any; ``pages`` has ``host, html`` and a number of the ``row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = {}
        for part in text_slices(batches, "html"):
            for host, text in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                tokens = parse(text).tokens
                counts, first = Counter(tokens), {}
                for at, token in enumerate(tokens):
                    first.setdefault(token, at)
                counts[-1] = 1  # the page itself
                page = xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"))
                for token, n in counts.items():
                    h = (page ^ n * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
                    own = sums.setdefault((host, token), [0, 0, 0, 0])
                    own[0] += 1
                    own[1] += h >> 40
                    own[2] += h >> 16 & 0xFFFFFF
                    own[3] += first.get(token, 0)
            if len(sums) > 300_000:
                yield told(sums, ["host", "token"], ["pages", "a", "b", "at"])
                sums = {}
        if sums:
            yield told(sums, ["host", "token"], ["pages", "a", "b", "at"])

    def told(sums: dict, keys: list[str], names: list[str]) -> pa.RecordBatch:
        values = np.array(list(sums.values()), np.int64)
        columns = [pa.array([k[0] for k in sums], pa.string()), *(pa.array([k[n] for k in sums], pa.int64()) for n in range(1, len(keys)))]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(values[:, n]) for n in range(len(names)))], [*keys, *names])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = {}
        known, keys = Places(), ["host", "of", "token", "class", "rank", "nest"]
        for part in text_slices(batches, "html"):
            for host, of, text, rows in zip(part.column("host").to_pylist(), part.column("of").to_pylist(), part.column("html").to_pylist(), part.column("template")):
                places = known.of(host, rows)
                for token, (_, slots, whole) in aligned(parse(text).tokens, places).items():
                    if whole:
                        sums.setdefault((host, of, token, *places[token][:2], _nest(slots)), [0])[0] += 1
            if len(sums) > 300_000:
                yield told(sums, keys, ["pages"])
                sums = {}
        if sums:
            yield told(sums, keys, ["pages"])

    named = pages.select("host", "html", "row", F.xxhash64("html").alias("copy"))
    copies = named.groupBy("host", "copy").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").select("host", "copy", "first")
    distinct = named.join(checked_broadcast(copies), ["host", "copy"], "left").where("first is null or row = first").select("host", "html")
    found = distinct.mapInArrow(run, "host string, token long, pages long, a long, b long, at long")
    found = stored(found.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("pages", "a", "b", "at"))).where(F.col("pages") >= LEAST_PAGES), "tokens")
    classes = checked_broadcast(supported(found).mapInArrow(_candidates, "host string, of long, template array<long>").where(F.size("template") > 0), BROADCAST_HOSTS)
    keys = "host string, of long, token long, class long, rank long, nest long"
    tested = distinct.join(classes, "host").select("host", "of", "html", "template").mapInArrow(test, f"{keys}, pages long")
    tested = tested.groupBy("host", "of", "token", "class", "rank", "nest").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= SUPPORT * F.col("of"))
    size = F.count("*").over(Window.partitionBy("host", "class")) + F.when(F.col("class") == 0, 1).otherwise(0)  # the page itself is in the spine
    kept = tested.withColumn("size", size).where(F.col("size") >= CLASS_SIZE)
    return kept.groupBy("host").agg(F.flatten(F.collect_list(F.array("token", "class", "rank", "nest"))).alias("template"))


def host_of(url: str):
    """Host of a URL in small letters, without port and user; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` for every row; a null or empty page has the empty text.

    Pages without a URL are one host. Repeated rows are extracted each for itself. A host with fewer than
    ``LEAST_PAGES`` different pages has no template; its pages are read by their elements alone.
    """
    pages = spread(df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.monotonically_increasing_id().alias("row"))).withColumn("host", host_of("url"))
    found = checked_broadcast(templates(pages.select("host", "html", "row")), BROADCAST_HOSTS)
    joined = pages.join(found, "host", "left").select("id", "url", "host", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Places()
        for part in text_slices(batches, "html"):
            columns = (part.column("host").to_pylist(), part.column("html").to_pylist(), part.column("template"))
            texts = [main_text(text, known.of(host, rows)) for host, text, rows in zip(*columns)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema["id"].dataType.simpleString()
    done = joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
