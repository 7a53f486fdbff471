"""Main-text extraction by equivalence-class template deduction (after EXALG, Arasu and Garcia-Molina, 2003).

Tokens are a page's elements, inline ones included, told apart by their path of tags and first
classes, and its text blocks, told apart by the structural element that holds them. A token's
occurrence vector has one entry per page of its host. Spark does not gather the vectors: it adds up
a hash of each (page, count), so that tokens of equal vectors have equal sums and no host's pages meet
in one task. Tokens of one host with equal vectors form an equivalence class. A class is valid if it
is frequent (``LEAST_PAGES``), large (``LEAST_SIZE``) and nests: each token's parent is in this class or
in a valid class on at least as many pages. Valid classes nest into the host's template, which decides:

* constant text: a block of a valid class that stands on ``CONSTANT`` of its element's pages belongs to
  the template and not to a slot, wherever it is, also inside the article (unless it is most of it:
  then the host repeats articles);
* the article slot: from the root down, the element that still holds ``MAJOR`` of the text that varies.
  Elements that the markup calls article or main are taken at a lesser share;
* wrappers: elements that look like furniture by tag or class but hold the core of most of their pages.

What fills a slot is furniture or article by its tags and class words, as no statistics tell a varying
advert from a varying paragraph; class names count only if all their words are about furniture
(``with-sidebar`` and ``related-work`` are not). A page without a slot of its host's template is
treated as a template of its own, without constant text.

Defined cases: null or empty html gives an empty text; pages without a host in the url share one
template per "no host"; repeated rows count and are extracted each; unclosed tags end with their
parent, and an unfinished tag or script at the end is dropped; a page whose whole article is constant
keeps it; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.shared import bounded, cut, sliced

#: A class must occur on this many pages of a host, and on this share of them (which bounds a host's classes).
LEAST_PAGES = 3
SUPPORT = 0.02
#: Least size of a class; an element counts two (its tags), a text block two and its words.
LEAST_SIZE = 3
#: Share of its element's pages on which a block of the template stands.
CONSTANT = 0.8
#: Share of the varying text that the article slot holds; share of the best one that further marked elements hold.
MAJOR = 0.6
FURTHER = 0.25
#: Templates are broadcast up to this many bytes, beyond that joined by host.
BROADCAST_BYTES = 16 << 20
#: Pages of one host that share a join key.
SALT_PAGES = 50_000

# HTML's element names by role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
STRUCTURE = frozenset("html body div section article main nav header footer aside form table".split())
FURNITURE = frozenset("nav footer aside form button select option menu dialog object canvas head video audio map".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tooltip".split())
RAW = "script|style|textarea|template|noscript|svg|iframe|title"
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words of a class or id that mean furniture, and words that may stand beside them.
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr login menu menus modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promos promotion recommended "
    "recommendations related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "teaser teasers toolbar widget widgets".split()
)
BESIDE = frozenset(
    "area articles badge bar body bottom box button buttons card cards col column container content count feed form global group header heading icon icons inline inner item "
    "items label left link links list listing main message middle module next outer page panel post posts prev primary region right row secondary section site slot "
    "small static sticky stories story text thread title to top unit user wrap wrapper".split()
)

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"[0-9]+")

NONE, OUT, CORE, HEADER = 0, 1, 2, 3


@lru_cache(maxsize=20_000)
def cue(tag: str, attributes: str) -> tuple[int, bool, str]:
    """What tag and attributes say of an element (NONE, OUT, CORE, HEADER), whether it is structural, and its first class."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
    classes = found.get("class", "").split()
    first = _DIGITS.sub("#", classes[0]) if classes else ""
    if tag in ("html", "body"):
        return NONE, True, ""
    structural = tag in STRUCTURE or bool(found)
    role = found.get("role", "").lower()
    if tag in FURNITURE or role in FURNITURE_ROLES:
        return OUT, structural, first
    if tag == "main" or role == "main":
        return CORE, structural, first
    header = tag == "header"
    for name in (*classes, found.get("id", "")):
        words = {w.lower() for w in _WORD.findall(name)}
        if words & MARKS and words <= MARKS | BESIDE:
            return OUT, structural, first
        header = header or ("header" in words and words <= BESIDE)
    if tag == "article" or role == "article" or found.get("itemprop") == "articleBody":
        return CORE, structural, first
    return HEADER if header else NONE, structural, first


@dataclass
class Page:
    """A parsed page: parallel lists of its elements, parents before children, and its text runs (element, block, text, in a link)."""

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    token: list[int] = field(default_factory=lambda: [0])
    cue: list[int] = field(default_factory=lambda: [NONE])
    home: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, int, str, bool]] = field(default_factory=list)


@lru_cache(maxsize=100_000)
def _element_token(parent: int, tag: str, first: str) -> int:
    return xxhash.xxh64_intdigest(f"{parent} {tag} {first}") >> 1


def parse(html: str | None) -> Page:
    page = Page()
    stack = [0]
    block = links = 0
    head = False

    def close(tags: set[str] | frozenset[str]) -> None:
        """Ends the nearest of these elements if only inline ones are open inside it."""
        k = len(stack) - 1
        while k > 0 and page.tag[stack[k]] in INLINE:
            k -= 1
        if k > 0 and page.tag[stack[k]] in tags:
            del stack[k:]

    for m in _TOKEN.finditer(html or ""):
        tag = m.group(3)
        if tag is None:
            piece = m.group(0)
            if (piece[0] != "<" or piece == "<") and not head:
                page.runs.append((stack[-1], block, entities.unescape(piece) if "&" in piece else piece, links > 0))
            continue
        if not m.group(0).endswith(">"):
            break  # an unfinished tag at the end
        tag = tag.lower()
        inline = tag in INLINE
        if m.group(2):
            if tag == "head":
                head = False
            for k in range(len(stack) - 1, 0, -1):
                name = page.tag[stack[k]]
                if name == tag:
                    del stack[k:]
                    break
                if inline and name not in INLINE:
                    break
            if not inline:
                block += 1
            links = sum(page.tag[k] == "a" for k in stack[-8:]) if tag == "a" or not inline else links
            continue
        if tag in VOID:
            if tag == "br":
                page.runs.append((stack[-1], block, " ", False))
            elif tag == "hr":
                block += 1
            continue
        if tag == "head":
            head = True
            continue
        if tag == "body":
            head = False
        if not inline:
            block += 1
            close({"p"})
            if tag in CLOSES:
                for _ in CLOSES[tag]:
                    close(CLOSES[tag])
            links = 0
        kind, structural, first = cue(tag, m.group(4))
        up, at = stack[-1], len(page.tag)
        page.tag.append(tag)
        page.parent.append(up)
        page.token.append(_element_token(page.token[up], tag, first))
        page.cue.append(kind)
        page.home.append(at if structural else page.home[up])
        stack.append(at)
        if tag == "a":
            links = 1
    return page


@dataclass
class Template:
    """Element tokens of the article slots and of wrappers, and the tokens of constant blocks."""

    slots: frozenset[int] = frozenset()
    wrappers: frozenset[int] = frozenset()
    constant: frozenset[int] = frozenset()


class View:
    """A page seen with a template's wrappers: what is furniture, and the blocks outside it."""

    def __init__(self, page: Page, wrappers: frozenset[int] = frozenset()) -> None:
        self.page = page
        n = len(page.tag)
        all_chars, cores, paragraphs = [0] * n, [0] * n, [0] * n
        for at, _, text, link in page.runs:
            if not link:
                all_chars[at] += len(text.strip())
        for k in range(n - 1, 0, -1):
            up = page.parent[k]
            cores[k] += page.cue[k] == CORE or page.tag[k] == "h1"
            paragraphs[k] += page.tag[k] == "p"
            all_chars[up] += all_chars[k]
            cores[up] += cores[k]
            paragraphs[up] += paragraphs[k]
        self.out, self.wraps = [False] * n, [False] * n
        core = [False] * n
        for k in range(1, n):
            up, kind = page.parent[k], page.cue[k]
            if kind in (OUT, HEADER):
                whole = 0 < cores[0] == cores[k] and all_chars[k] >= 0.5 * all_chars[0]
                self.wraps[k] = whole or (page.tag[k] == "form" and paragraphs[k] > 0 and all_chars[k] >= 0.95 * all_chars[0])
            kept = self.wraps[k] or page.token[k] in wrappers
            self.out[k] = self.out[up] or (kind == OUT and not kept) or (kind == HEADER and not core[up] and not kept)
            core[k] = core[up] or (kind == CORE and not self.out[k])
        #: Blocks: element of the first run, text, characters outside links.
        self.blocks: list[tuple[int, str, int]] = []
        at, parts, plain, first = -1, [], 0, 0

        def flush() -> None:
            text = " ".join("".join(parts).split())
            if text:
                self.blocks.append((first, text, min(plain, len(text))))

        for node, block, text, link in page.runs:
            if self.out[node]:
                continue
            if block != at:
                flush()
                at, parts, plain, first = block, [], 0, node
            elif not parts or not "".join(parts).strip():
                first = node
            parts.append(text)
            plain += 0 if link else len(text.strip())
        flush()
        self.chars = [0] * n
        for node, _, size in self.blocks:
            self.chars[node] += size
        for k in range(n - 1, 0, -1):
            self.chars[page.parent[k]] += self.chars[k]

    def block_token(self, block: tuple[int, str, int]) -> int:
        page = self.page
        return xxhash.xxh64_intdigest(f"{page.token[page.home[block[0]]]}\n{block[1]}") >> 1

    def menu(self, node: int) -> bool:
        """An element of links: three or more with four fifths of its text."""
        page, chars, linked, links = self.page, 0, 0, 0
        for at, _, text, link in page.runs:
            if at >= node:
                k = at
                while k > node:
                    k = page.parent[k]
                if k == node:
                    chars += len(text.strip())
                    linked += len(text.strip()) * link
                    links += link
        return links >= 3 and linked >= 0.8 * chars


def pick(parents: dict[int, int], chars: dict[int, float], totals: dict[int, float], core: set[int], usable: set[int], main: set[int]) -> list[int]:
    """The article's elements among those of a template, from the root down.

    ``chars`` is the text that varies in an element, ``totals`` that of the pages where it occurs.
    """
    below: dict[int, list[int]] = {}
    for token, up in parents.items():
        below.setdefault(up, []).append(token)
    out: list[int] = []

    def share(token: int) -> float:
        return chars[token] / max(1.0, totals[token])

    marked = {t for t in core if t in usable and chars[t] > 0}
    if marked:
        best = max(share(t) for t in marked)
        strong = {t for t in marked if share(t) >= FURTHER * best}
        inner = set()  # inside <main>, the article if it is the major part
        for t in strong & main:
            parts = [u for u in strong - main if _within(u, t, parents)]
            if parts and sum(chars[u] for u in parts if not any(_within(u, v, parents) for v in parts if v != u)) >= MAJOR * chars[t]:
                inner.add(t)
        strong -= inner
        return sorted(t for t in strong if not any(_within(t, u, parents) for u in strong if u != t))
    todo = [t for t in below.get(0, [])]
    while todo:
        token = todo.pop()
        if share(token) < MAJOR:
            continue
        deeper = [t for t in below.get(token, []) if share(t) >= MAJOR]
        todo += deeper
        if not deeper and token in usable:
            out.append(token)
    return sorted(out)


def _within(token: int, above: int, parents: dict[int, int]) -> bool:
    token = parents.get(token, 0)
    while token:
        if token == above:
            return True
        token = parents.get(token, 0)
    return False


def own_template(view: View) -> frozenset[int]:
    """The slots of a page that stands alone."""
    page, chars, parents = view.page, {}, {}
    for k in range(1, len(page.tag)):
        if not view.out[k] and page.tag[k] not in ("html", "body"):
            chars[page.token[k]] = chars.get(page.token[k], 0) + view.chars[k]
        parents[page.token[k]] = page.token[page.parent[k]]
    core = {page.token[k] for k in range(1, len(page.tag)) if page.cue[k] == CORE and not view.out[k]}
    main = {page.token[k] for k in range(1, len(page.tag)) if page.tag[k] == "main"}
    if not core:
        return frozenset()
    total = max(1, view.chars[0])
    return frozenset(pick(parents, {t: chars.get(t, 0) for t in parents}, dict.fromkeys(parents, total), core, set(chars), main))


def page_text(html: str | None, template: Template = Template()) -> str:
    """The text of one page under its host's template."""
    page = parse(html)
    view = View(page, template.wrappers)
    for slots, constant in ((template.slots, template.constant), (own_template(view), template.constant), (own_template(view), frozenset())):
        inside = [False] * len(page.tag)
        for k in range(1, len(page.tag)):
            inside[k] = inside[page.parent[k]] or (page.token[k] in slots and not view.out[k])
        if slots and any(inside):
            chosen = [b for b in view.blocks if inside[b[0]] or _heading(page, b[0])]
        elif slots is template.slots:
            continue
        else:  # no article: the body without lists of links
            menus: dict[int, bool] = {}
            chosen = [b for b in view.blocks if not _in_menu(view, b, menus)]
        chosen = [b for b in chosen if not constant or view.block_token(b) not in constant]
        if chosen:
            return "\n".join(b[1] for b in chosen)
    return ""


def _heading(page: Page, node: int) -> bool:
    while node:
        if page.tag[node] == "h1":
            return True
        node = page.parent[node]
    return False


def _in_menu(view: View, block: tuple[int, str, int], menus: dict[int, bool]) -> bool:
    if 5 * block[2] > len(block[1]):
        return False
    node = block[0]
    while node and view.page.tag[node] not in ("body", "html"):
        if node not in menus:
            menus[node] = view.menu(node)
        if menus[node]:
            return True
        node = view.page.parent[node]
    return False


_TOKENS = "host string, token long, kind int, parent long, core long, main long, out long, wraps long, pages long, chars long, total long, words long, v1 long, v2 long"
#: Kinds of tokens; html and body hold all of a page and are no slot.
PAGE, ELEMENT, ROOT, BLOCK = 0, 1, 2, 3


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def page_tokens(html: str | None) -> list[tuple[int, int, int, int, int, int, int, int, int, int, int]]:
    """(token, kind, parent, count, core, main, out, wraps, chars, total, words) of one page."""
    page = parse(html)
    view = View(page)
    total = view.chars[0]
    rows: dict[int, list[int]] = {0: [PAGE, 0, 1, 0, 0, 0, 0, total, total, 0]}
    for k in range(1, len(page.tag)):
        row = rows.get(page.token[k])
        if row is None:
            kind = ROOT if page.tag[k] in ("html", "body") else ELEMENT
            row = rows[page.token[k]] = [kind, page.token[page.parent[k]], 0, 0, page.tag[k] == "main", 0, 0, 0, total, 0]
        row[2] += 1
        row[3] |= page.cue[k] == CORE
        row[5] |= view.out[k]
        row[6] |= view.wraps[k]
        row[7] += view.chars[k]
    for b in view.blocks:
        row = rows.setdefault(view.block_token(b), [BLOCK, page.token[page.home[b[0]]], 0, 0, 0, 0, 0, 0, total, b[1].count(" ") + 1])
        row[2] += 1
        row[7] += b[2]
    return [(token, *map(int, row)) for token, row in rows.items()]


def tokens(pages: DataFrame) -> DataFrame:
    """Each host's tokens with support, text held, and the sums (v1, v2) that stand for their occurrence vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 3, 8 << 20):
            sums: dict[tuple[str, int], list[int]] = {}
            for host, page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                for token, kind, parent, count, core, main, out, wraps, chars, total, words in page_tokens(html):
                    row = sums.setdefault((host, token), [kind, parent, 0, 0, 0, 0, 0, 0, 0, words, 0, 0])
                    h = xxhash.xxh64_intdigest(f"{page_id} {url} {count}")
                    for k, x in enumerate((core, main, out, wraps, 1, chars, total)):
                        row[2 + k] += x
                    row[10] += h >> 32
                    row[11] += h & 0xFFFFFFFF
            names = [c.split()[0] for c in _TOKENS.split(", ")]
            rows = [(*key, *row) for key, row in sums.items()]
            kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 11]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)

    counted = bounded(pages).select(host_of().alias("host"), "page_id", "url", "html").mapInArrow(run, _TOKENS)
    sums = [F.sum(c).alias(c) for c in ("core", "main", "out", "wraps", "pages", "chars", "total", "v1", "v2")]
    return counted.groupBy("host", "token", "kind").agg(F.max("parent").alias("parent"), F.max("words").alias("words"), *sums)


def deduce(rows: pd.DataFrame) -> Template:
    """A host's template from its tokens; ``n_pages`` and ``all_chars`` (of all its pages) are on each row."""
    n = int(rows["n_pages"].iloc[0])
    rows = rows.sort_values(["pages", "token"], ascending=[False, True])
    size = rows["words"].where(rows["kind"] == BLOCK, 0) + 2
    rows = rows.assign(size=size, both=rows["v1"].astype(str) + " " + rows["v2"].astype(str))
    large = rows.groupby("both")["size"].sum()
    rows = rows[rows["both"].map(large) >= LEAST_SIZE]
    # nesting: parents stand on as many pages as their children or more, so they come first
    elements = rows[rows["kind"].isin([ELEMENT, ROOT])]
    parents: dict[int, int] = {}
    todo = list(zip(elements["token"], elements["parent"]))
    while todo:
        left = []
        for token, up in todo:
            if up == 0 or up in parents:
                parents[token] = up
            else:
                left.append((token, up))
        if len(left) == len(todo):
            break
        todo = left
    elements = elements[elements["token"].isin(parents)]
    support = dict(zip(elements["token"], elements["pages"]))
    blocks = rows[(rows["kind"] == BLOCK) & (rows["parent"].isin(parents) | (rows["parent"] == 0))]
    blocks = blocks[blocks["pages"] >= CONSTANT * blocks["parent"].map(lambda t: support.get(t, n))]
    chars = dict(zip(elements["token"], elements["chars"].astype(float)))
    totals = dict(zip(elements["token"], elements["total"].astype(float)))
    fixed = dict.fromkeys(chars, 0.0)
    for up, c in zip(blocks["parent"], blocks["chars"]):
        while up:
            fixed[up] += c
            up = parents[up]
    everywhere = float(blocks["chars"].sum())
    varying = {t: chars[t] - fixed[t] for t in chars}
    total = {t: totals[t] - everywhere * support[t] / n for t in chars}
    marked = set(elements["token"][(2 * elements["core"] >= elements["pages"]) & (2 * elements["out"] < elements["pages"])])
    usable = set(elements["token"][(elements["kind"] == ELEMENT) & (2 * elements["out"] < elements["pages"])])
    main = set(elements["token"][elements["main"] > 0])
    slots = pick(parents, varying, total, marked, usable, main)
    # articles that repeat over a host are no template: constant text that is most of its slot stays
    kept = {s for s in slots if fixed[s] > 0.5 * chars[s]}
    constant = [t for t, up in zip(blocks["token"], blocks["parent"]) if up not in kept and not any(_within(up, s, parents) for s in kept)]
    wrappers = elements["token"][2 * elements["wraps"] >= elements["pages"]]
    return Template(frozenset(slots), frozenset(wrappers.tolist()), frozenset(constant))


def templates(pages: DataFrame) -> DataFrame:
    """host, n_pages, slots, wrappers, constant (tokens) of each host that has a template.

    A host's tokens that reach the support are at most its tokens per page divided by SUPPORT,
    whatever its number of pages.
    """
    found = cut(tokens(pages).where((F.col("kind") == PAGE) | (F.col("pages") >= LEAST_PAGES)), "tokens")
    sizes = found.where(F.col("kind") == PAGE).select("host", F.col("pages").alias("n_pages"))
    usable = found.where(F.col("kind") != PAGE).join(sizes, "host").where(F.col("pages") >= SUPPORT * F.col("n_pages"))

    def of_host(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        t = deduce(rows)
        return pd.DataFrame({"host": [key[0]], "n_pages": [int(rows["n_pages"].iloc[0])], "slots": [sorted(t.slots)], "wrappers": [sorted(t.wrappers)], "constant": [sorted(t.constant)]})

    return usable.groupBy("host").applyInPandas(of_host, "host string, n_pages long, slots array<long>, wrappers array<long>, constant array<long>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text of every page."""
    found = cut(templates(pages), "templates")
    keyed = pages.select(host_of().alias("host"), "page_id", "url", "html")
    parts = ("slots", "wrappers", "constant")
    row_bytes = F.length("host") + 100 + sum((8 * F.size(c) for c in parts), F.lit(0))
    if (found.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(found), "host", "left")
    else:  # hosts with many pages are dealt over several keys
        spread = F.ceil(F.col("n_pages") / SALT_PAGES).cast("int")
        most = max(1, found.agg(F.max(spread)).first()[0])
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))) if most > 1 else found.withColumn("salt", F.lit(0))
        joined = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(most)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Template] = {}
        for batch in sliced(batches, 3):
            texts = []
            for host, html, *sets in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5, 6))):
                if host not in held:
                    if len(held) > 10_000:
                        held.clear()
                    held[host] = Template(*(frozenset(s or ()) for s in sets))
                texts.append(page_text(html, held[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(texts, pa.string())], names=["page_id", "url", "host", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return bounded(joined).select("page_id", "url", "host", "html", *parts).mapInArrow(run, f"page_id {kind}, url string, host string, text string")
