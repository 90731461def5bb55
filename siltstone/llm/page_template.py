"""Main text of pages by deducing the template that pages of a host share.

A page is a sequence of tokens: tags and the texts between them, each in the role that its place in the
element tree gives it.  Roles that occur equally often on each page of a host have
one occurrence vector and form an equivalence class; a vector is known by sums
of hashes of (page, count), which add up over pages and hosts however they are dealt out.
Classes that stand on most pages are the template's parts, once they are

* ordered: their roles follow each other in one order, and roles that do not are dropped;
* nested: each repetition lies within one gap of a wider class, always the same.

What lies between two tokens of the nested classes is a slot.  A host's slots are
told apart by all its pages: how much text they hold, how much of it in links, and
in which element.  The slot of most text outside menus, adverts, forms and the like
is the main one; the element around it that stands once on each page holds the article,
and all its slots make up the text.  A block that nearly all pages repeat as part of the
template is none of a page's own, unless most of the article is such: then all pages carry one article.

Hosts of fewer than ``LEAST_PAGES`` pages have too few for vectors to tell roles apart, and
share one template.  Where no template has an article's element on a page (or there are too
few pages in all), the page's article or main element is taken, or else what is not in menus and the like
and not mostly links.

A host's template is at most twice as long as its pages are on average, as each role is on half
of them.  Pages are never gathered: all steps read them where they lie, and what
is counted is summed before it is shuffled.  A page is parsed whole, however long.  Null html is
the empty page, with no text.  Null URLs are of one host.  Pages that repeat count each,
and are given the same text each.  No pages give no rows.  Other columns are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, maybe_broadcast

#: A host has a template of its own from so many pages.
LEAST_PAGES = 20
#: Roles of a template are on this share of the pages; blocks on this share of them are no page's own.
COMMON, REPEATED = 0.5, 0.9
#: Classes may be out of order, or not nested, on this share of pages.
SLACK = 0.05
#: Slots of a larger share of text in links are menus.
LINKED = 0.5
#: Templates of all hosts are broadcast up to so many bytes.
BROADCAST_BYTES = 64 << 20
#: Elements are followed to this depth; what is deeper counts as of it.
DEPTH = 256

# HTML elements by how they are laid out, and what boilerplate is called.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table caption colgroup thead tbody tfoot tr td th figure figcaption center details summary hgroup address hr".split())
CLOSED_BY = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "option": frozenset(("option",)),
    "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
}
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "object", "canvas", "xmp", "noframes")
BOILERPLATE = frozenset("head nav footer aside form button select option dialog menu input fieldset audio video".split())
PAGE_LEVEL = frozenset(("header", "masthead", "title"))  # an article's own header belongs to it
MARKED = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertisements advertising sponsor sponsored promo promoted promotion banner sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs "
    "footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended recommendations "
    "comment comments commentlist reply replies respond discussion disqus widget widgets toolbar pagination pager copyright skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

TAG = re.compile(
    "(<!--.*?(?:-->|\\Z)|" + "|".join(f"<{n}\\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</{n}\\s*>|\\Z)" for n in RAW)
    + "|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-z][^>]*>|<[!?/][^>]*>|<[a-z!?/][^>]*\\Z)",
    re.I | re.S,
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Element:
    name: str
    close: str
    path: int
    role: int
    boilerplate: bool
    article: bool
    chain: tuple[Element, ...]  # those it lies in that can hold an article, itself included


def described(tag: str, name: str, inside: bool) -> tuple[str, bool]:
    """An element's name in roles, and whether it or what it is called is boilerplate."""
    if name in ("html", "body"):
        return name, False
    if name in INLINE and name != "span" or " " not in tag and "\n" not in tag:
        return name, name in BOILERPLATE or name in PAGE_LEVEL and not inside
    found, hidden = [], False
    for key, value in ATTRIBUTE.findall(tag[len(name) + 1 :]):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            found.append(("." if key == "class" else "#") + DIGITS.sub("0", " ".join(sorted(value.split()))))
        hidden |= key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "") or key == "role" and value in ROLES
    parts = set(PARTS.split(" ".join(found)))
    marked = bool(parts & MARKED) or not inside and bool(parts & PAGE_LEVEL)
    return name + "".join(sorted(found)), hidden or marked and name not in ("article", "main") or "comment" in parts or name in BOILERPLATE or name in PAGE_LEVEL and not inside


def role_of(token: str, path: int) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "replace"), seed=path)


@lru_cache(100_000)
def tag_role(token: str, path: int) -> int:
    return role_of(token, path)


#: Events of a page: (role, break, None) for tags, where break is "" inline, " " within a block, "\n" between
#: blocks; (None, text, element, in a link) for text.
Event = tuple


def events(page: str) -> list[Event]:
    """A page's tags and texts with the elements they stand in."""
    root = Element("", "", 0, 0, False, False, ())
    stack, links, out, role = [root], 0, [], tag_role

    def close(k: int) -> None:
        while len(stack) > k:
            out.append((role(stack[-1].close, stack[-2].path), "\n", None))
            stack.pop()

    for k, piece in enumerate(TAG.split(page)):
        if not k % 2:
            if piece and not piece.isspace():
                out.append((None, piece, stack[-1], links > 0))
            elif piece:
                out.append((0, " ", None))
            continue
        named = NAME.match(piece)
        if named is None:
            continue  # comments and declarations
        name, top = named[1].lower(), stack[-1]
        if piece[1] == "/":
            if name in INLINE:
                links = max(0, links - (name == "a"))
                out.append((role(f"</{name}>", top.path), "", None))
            else:
                at = next((j for j in range(len(stack) - 1, 0, -1) if stack[j].name == name), 0)
                if at:
                    close(at)
                    links = 0
            continue
        if name in RAW:
            out.append((role(f"<{name}>", top.path), "\n" if name not in ("textarea", "svg", "canvas", "object") else "", None))
            continue
        if name in INLINE or name in VOID:
            links += name == "a"
            out.append((role(f"<{name}>", top.path), "" if name in INLINE else " " if name == "br" else "\n", None))
            continue
        if top.name == "p":
            close(len(stack) - 1)
        ends = CLOSED_BY.get(name)
        if ends:
            at = next((j for j in range(len(stack) - 1, 0, -1) if stack[j].name in ends or stack[j].name in ("ul", "ol", "dl", "table", "select")), 0)
            if at and stack[at].name in ends:
                close(at)
        top = stack[-1]
        label, marked = described(piece, name, top.article)
        own = role(f"<{label}>", top.path)
        out.append((own, "\n", None))
        if len(stack) < DEPTH:
            made = Element(name, f"</{label}>", own, own, top.boilerplate or marked, top.article or name in ("article", "main"), top.chain)
            if name not in PARAGRAPHS:
                made.chain = (*top.chain, made)
            stack.append(made)
    return out  # elements that the page leaves open have no end in it


def occurrences(page: str) -> dict[int, tuple[int, int, int]]:
    """Each role's count, first place, and whether it is a tag."""
    found: dict[int, list[int]] = {}
    for place, event in enumerate(events(page)):
        if event[0] is not None:
            role, tag = event[0], 1
            if not role:
                continue  # white space alone
        else:
            role, tag = role_of(event[1].strip(), event[2].path), 0
        known = found.get(role)
        if known is None:
            found[role] = [1, place, tag]
        else:
            known[0] += 1
    return found


# --- pages by the host whose template they share


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(F.coalesce(url.cast("string"), F.lit(""))), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def keyed(pages: DataFrame, least: int) -> DataFrame:
    """(key, page_id, url, html): ``key`` is the host, or empty for all hosts of few pages."""
    lean = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    large = cut(lean.groupBy("host").count().where(F.col("count") >= least).select(F.col("host").alias("key")), "large-hosts")
    return lean.join(maybe_broadcast(large), F.col("host") == F.col("key"), "left").select(F.coalesce("key", F.lit("")).alias("key"), "page_id", "url", "html")


def summed(keys: list[str], columns: list[np.ndarray], kept: int) -> tuple[list[str], list[np.ndarray]]:
    """Rows of equal key and first ``kept`` columns, with the other columns added up."""
    names = {k: n for n, k in enumerate(dict.fromkeys(keys))}
    groups = [np.array([names[k] for k in keys], np.int64), *columns[:kept]]
    order = np.lexsort(groups[::-1])
    if not len(order):
        return [], columns
    groups = [g[order] for g in groups]
    new = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([g[1:] != g[:-1] for g in groups])]))
    back = list(names)
    return [back[k] for k in groups[0][new]], [*(g[new] for g in groups[1:]), *(np.add.reduceat(c[order], new) for c in columns[kept:])]


def role_counts(pages: DataFrame) -> DataFrame:
    """(key, role, tag, pages, total, a, b, place).

    ``a`` and ``b`` are sums of 31 bits each for a page and its count: equal vectors have equal ones.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                keys, parts = [], []
                for key, page_id, page in zip(*(part.column(c).to_pylist() for c in ("key", "page_id", "html")), strict=True):
                    found = occurrences(page)
                    n = len(found)
                    count, place, tag = np.array(list(found.values()), np.int64).reshape(-1, 3).T
                    seed = np.uint64(xxhash.xxh64_intdigest(page.encode("utf-8", "replace"), seed=(page_id or 0) & (1 << 63) - 1))
                    h = (count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ seed
                    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53), (32, 1)):
                        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
                    a, b = ((h >> np.uint64(s) & np.uint64(0x7FFFFFFF)).astype(np.int64) for s in (0, 32))
                    keys += [key] * n
                    parts.append([np.fromiter(found, np.uint64, n).view(np.int64), tag, np.ones(n, np.int64), count, a, b, place])
                keys, columns = summed(keys, [np.concatenate(c) for c in zip(*parts, strict=True)], 2)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *map(pa.array, columns)], names)

    names = ["key", "role", "tag", "pages", "total", "a", "b", "place"]
    rows = pages.select("key", "page_id", "html").mapInArrow(counted, "key string, " + ", ".join(f"{c} long" for c in names[1:]))
    return rows.groupBy("key", "role", "tag").agg(*(F.sum(c).alias(c) for c in names[3:]))


def classes(pages: DataFrame, least: int) -> DataFrame:
    """(key, n, classes): equivalence classes of roles on most pages, widest first, in JSON, cut."""
    n = cut(pages.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least), "page-counts")
    common = role_counts(pages).join(maybe_broadcast(n), "key").where(F.col("pages") >= F.col("n") * COMMON)
    found = common.groupBy("key", "n", "pages", "total", "a", "b").agg(F.sort_array(F.collect_list(F.struct("place", "role"))).alias("r"), F.max("tag").alias("tag"))
    found = found.where((F.size("r") > 1) & (F.col("tag") > 0))
    listed = F.sort_array(F.collect_list(F.struct((-F.col("pages")).alias("p"), F.col("total").alias("t"), F.col("r.role").alias("r"))))
    return cut(found.groupBy("key", "n").agg(F.to_json(listed).alias("classes")), "classes")


# --- the template at work


@dataclass
class Template:
    """A host's classes: what is widest has the smallest number."""

    pages: int = 0
    sizes: list[int] = field(default_factory=list)
    roles: dict[int, tuple[int, int]] = field(default_factory=dict)
    on_pages: list[int] = field(default_factory=list)
    totals: list[int] = field(default_factory=list)
    slots: set[tuple[int, int]] = field(default_factory=set)
    container: int = 0

    @classmethod
    def read(cls, pages: int | None, found: str | None, dropped: str | None = None, measured: str | None = None) -> Template:
        made = cls(pages or 0)
        gone = set(json.loads(dropped or "[]"))
        kept = [(-c["p"], c["t"], [r for r in c["r"] if r not in gone]) for c in json.loads(found or "[]")]
        rows = json.loads(measured or "[]")
        nests, slots = [r for r in rows if r["what"] == 0], [r for r in rows if r["what"] == 1]
        bad = made.unnested(nests)
        kept = [(p, t, [] if k in bad else r) for k, (p, t, r) in enumerate(kept)]
        for k, (p, t, roles) in enumerate(kept):
            made.sizes.append(len(roles))
            made.on_pages.append(p)
            made.totals.append(t)
            if len(roles) > 1:
                made.roles.update({r % (1 << 64): (k, at) for at, r in enumerate(roles)})
        around = {r["a"]: (r["b"], r["c"]) for r in sorted(nests, key=lambda r: r["n"])}
        for r in slots:
            while r["a"] in bad:  # wider ones have smaller numbers
                r["a"], r["b"] = around[r["a"]]
        made.choose(slots)
        return made

    @staticmethod
    def unnested(rows: list[dict]) -> set[int]:
        """Classes whose repetitions are cut by wider ones, or lie now in one gap and now in another."""
        begun, ended, most = Counter(), Counter(), Counter()
        for r in rows:
            begun[r["a"]] += r["n"]
            ended[r["a"]] += r["m"]
            most[r["a"]] = max(most[r["a"]], r["n"])
        return {k for k, n in begun.items() if min(ended[k], most[k]) < n * (1 - SLACK)}

    def choose(self, rows: list[dict]) -> None:
        """The article's element and slots, from what slots hold on all pages."""
        plain = [r for r in rows if not r["d"]]
        held = Counter()
        for r in plain:
            held[r["a"], r["b"], r["c"]] += r["n"] - r["m"]
        inside = [(n, *k) for k, n in held.items() if k[2] and n > 0]
        if not inside:
            return
        self.container = max(inside)[3] % (1 << 64)
        words, linked = Counter(), Counter()
        for r in plain:
            if r["c"] % (1 << 64) == self.container:
                words[r["a"], r["b"]] += r["n"]
                linked[r["a"], r["b"]] += r["m"]
        self.slots = {s for s, n in words.items() if linked[s] <= LINKED * n}

    def once(self, role: int) -> bool:
        """Whether a role stands once on each page that it is on."""
        at = self.roles.get(role)
        return at is not None and self.totals[at[0]] == self.on_pages[at[0]]

    def tokens(self, page: str) -> Iterator[tuple[Event, tuple[int, int] | None]]:
        """A page's events, each with its place in the template if it has one."""
        if not self.roles:
            return ((event, None) for event in events(page))
        get = self.roles.get
        return ((event, get(event[0] if event[0] is not None else role_of(event[1].strip(), event[2].path))) for event in events(page))


class Slots:
    """Follows the nested classes through a page: which repetitions are open, and in which gap one is."""

    def __init__(self, template: Template):
        self.template, self.open = template, []
        self.begun: Counter = Counter()
        self.ended: Counter = Counter()

    def take(self, kind: int, at: int) -> None:
        while self.open and self.open[-1][0] > kind:
            self.open.pop()  # cut by a wider class
        if at == 0:
            if self.open and self.open[-1][0] == kind:
                self.open.pop()
            place = (kind, *self.here())
            self.begun[place] += 1
            self.open.append([kind, 0, place])
        elif self.open and self.open[-1][0] == kind and self.open[-1][1] == at - 1:
            self.open[-1][1] = at
            if at == self.template.sizes[kind] - 1:
                self.ended[self.open.pop()[2]] += 1

    def here(self) -> tuple[int, int]:
        return (self.open[-1][0], self.open[-1][1]) if self.open else (-1, -1)


def out_of_order(template: Template, page: str) -> Counter:
    """Roles whose occurrences do not follow the order of their class on a page."""
    seen: dict[int, list[tuple[int, int]]] = {}
    turn: Counter = Counter()
    for _, place in template.tokens(page):
        if place is not None:
            kind, at = place
            seen.setdefault(kind, []).append((turn[place] * template.sizes[kind] + at, at))
            turn[place] += 1
    found: Counter = Counter()
    for kind, marks in seen.items():
        keys = [k for k, _ in marks]
        if all(x < y for x, y in zip(keys, keys[1:], strict=False)):
            continue
        # All but a longest rising sequence are out of order.
        ends, at, back = [], [], []
        for k, key in enumerate(keys):
            j = bisect_left(ends, key)
            ends[j:j + 1], at[j:j + 1] = [key], [k]
            back.append(at[j - 1] if j else -1)
        rising, k = set(), at[-1]
        while k >= 0:
            rising.add(k)
            k = back[k]
        found.update({(kind, a) for k, (_, a) in enumerate(marks) if k not in rising})
    return found


def container_of(template: Template, element: Element) -> int:
    """The element that may hold the article: the outermost article or main, else the innermost that stands once on each page."""
    chain = element.chain
    named = next((e for e in chain if e.name == "article"), None) or next((e for e in chain if e.name == "main"), None)
    if named is not None and named.role in template.roles:
        return named.path
    return next((e.path for e in reversed(chain) if e.name not in ("html", "body") and template.once(e.role)), next((e.path for e in chain if e.name == "body"), 0))


def measures(template: Template, page: str) -> Counter:
    """What a page adds to the template's measures: (what, a, b, c, d, value)."""
    held: dict[tuple, list[int]] = {}
    slots, chain, container = Slots(template), None, 0
    for event, place in template.tokens(page):
        if event[0] is None:
            element = event[2]
            if element.chain is not chain:  # one object for all that an element holds
                chain, container = element.chain, container_of(template, element)
            n, sums = len(event[1]), held.setdefault((*slots.here(), container, element.boilerplate), [0, 0])
            sums[0] += n
            if event[3]:
                sums[1] += n
        if place is not None:
            slots.take(*place)
    found: Counter = Counter()
    for (kind, at, inside, boilerplate), (n, m) in held.items():
        found[(1, kind, at, inside, int(boilerplate)), "n"] += n
        found[(1, kind, at, inside, int(boilerplate)), "m"] += m
    for (kind, *parent), n in slots.begun.items():
        found[(0, kind, *parent, 0), "n"] += n
        found[(0, kind, *parent, 0), "m"] += slots.ended[(kind, *parent)]
    return found


def main_text(template: Template, page: str) -> str:
    """The article's blocks, of the slots that the template says hold it."""
    blocks: list[tuple[str, bool]] = []
    spare: list[tuple[str, int, int, bool]] = []  # of pages without the article's element
    slots, buffer, own, other, linked = Slots(template), [], False, [], [0, 0, False]
    fixed = {k for k, n in enumerate(template.on_pages) if n >= REPEATED * template.pages and template.pages}

    def flush() -> None:
        nonlocal own, linked
        text = " ".join("".join(buffer).split())
        if text:
            blocks.append((text, own))
        text = " ".join("".join(other).split())
        if text:
            spare.append((text, *linked))
        buffer.clear()
        other.clear()
        own, linked = False, [0, 0, False]

    seen, whole, common, chain, inside = False, 0, 0, None, False
    for event, place in template.tokens(page):
        if event[0] is not None:
            if event[1] == "\n":
                flush()
            elif event[1]:
                buffer.append(event[1])
                other.append(event[1])
        elif not event[2].boilerplate:
            text = entities.unescape(event[1]) if "&" in event[1] else event[1]
            if event[2].chain is not chain:
                chain = event[2].chain
                inside = bool(template.container) and any(e.path == template.container for e in chain)
            seen |= inside
            if inside and slots.here() in template.slots:
                repeated = place is not None and place[0] in fixed
                buffer.append(text)
                own |= not repeated
                whole, common = whole + len(text), common + len(text) * repeated
            other.append(text)
            linked[0] += len(text)
            linked[1] += len(text) * event[3]
            linked[2] |= event[2].article
        if place is not None:
            slots.take(*place)
    flush()
    if seen:
        # An article that is mostly the template is one that all pages carry.
        kept = [t for t, o in blocks if o or 2 * common > whole]
    else:
        marked = any(a for *_, a in spare)
        kept = [t for t, n, m, a in spare if (a if marked else m <= LINKED * n)]
    return "\n".join(kept)


# --- Spark jobs over all pages


def with_templates(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``pages`` with their host's template beside; of many hosts, pages are shuffled to it."""
    size = templates.agg(F.coalesce(F.sum(sum(F.coalesce(F.length(c), F.lit(0)) for c in templates.columns if c not in ("n",))), F.lit(0))).first()[0]
    return pages.join(F.broadcast(templates) if size <= BROADCAST_BYTES else templates, "key", "left")


def per_template(pages: DataFrame, names: list[str], schema: str, made: Callable[[list[tuple[str, Template, dict]]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``made`` over batches of (key, template, page); templates are read once each in a task's batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, Template] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, rows = batch.slice(low, 256), []
                keys = part.column("key").to_pylist()
                pages = part.select([c for c in ("page_id", "url", "html")]).to_pylist()
                for k, key in enumerate(keys):
                    if key not in read:
                        if len(read) > 200:
                            read.clear()
                        read[key] = Template.read(*(part.column(c)[k].as_py() for c in names))
                    rows.append((key, read[key], pages[k]))
                yield from made(rows)

    return pages.mapInArrow(run, schema)


def unordered(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``templates`` with ``dropped``: roles out of their class's order on more than a few pages, in JSON, cut."""

    def made(rows):
        keys, roles, n = [], [], []
        for key, template, page in rows:
            if template.roles:
                back = {v: k for k, v in template.roles.items()}
                for place in out_of_order(template, page["html"]):
                    keys.append(key)
                    roles.append(back[place])
                    n.append(1)
        keys, (roles, n) = summed(keys, [np.array(roles, np.uint64).view(np.int64), np.array(n, np.int64)], 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(roles), pa.array(n)], ["key", "role", "bad"])

    rows = per_template(with_templates(pages, templates), ["n", "classes"], "key string, role long, bad long", made)
    bad = rows.groupBy("key", "role").agg(F.sum("bad").alias("bad")).join(maybe_broadcast(templates.select("key", "n")), "key").where(F.col("bad") > F.col("n") * SLACK)
    listed = cut(bad.groupBy("key").agg(F.to_json(F.sort_array(F.collect_list("role"))).alias("dropped")), "unordered")
    return cut(templates.join(maybe_broadcast(listed), "key", "left"), "ordered")


def measured(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``templates`` with ``measured``: how classes nest and what slots hold, over all pages, in JSON, cut."""
    names = ["what", "a", "b", "c", "d"]

    def made(rows):
        total: dict[tuple, list[int]] = {}
        for key, template, page in rows:
            for (where, what), n in measures(template, page["html"]).items():
                total.setdefault((key, *where), [0, 0])["nm".index(what)] += n
        keys = [k for k, *_ in total]
        columns = [np.array([w[j] % (1 << 64) for _, *w in total], np.uint64).view(np.int64) for j in range(5)]
        columns += [np.array([v[j] for v in total.values()], np.int64) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *map(pa.array, columns)], ["key", *names, "n", "m"])

    rows = per_template(with_templates(pages, templates), ["n", "classes", "dropped"], "key string, " + ", ".join(f"{c} long" for c in [*names, "n", "m"]), made)
    counted = rows.groupBy("key", *names).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    listed = counted.groupBy("key").agg(F.to_json(F.collect_list(F.struct(*names, "n", "m"))).alias("measured"))
    return cut(templates.join(cut(listed, "measured"), "key", "left"), "templates")


def deduced(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """(key, n, classes, dropped, measured): the template of each host of keyed ``pages``."""
    return measured(pages, unordered(pages, classes(pages, least)))


def extract(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page."""

    def made(rows):
        texts = [main_text(template, page["html"]) for _, template, page in rows]
        columns = [pa.array([p["page_id"] for *_, p in rows], pa.int64()), pa.array([p["url"] for *_, p in rows], pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    held = keyed(pages, least)
    return per_template(with_templates(held, deduced(held, least)), ["n", "classes", "dropped", "measured"], "page_id long, url string, text string, n_chars long", made)
