"""HTML extraction by tag-path ratios.

A page becomes a sequence of text blocks, each with its path of tags from the root; elements that hold others count with
their classes. Text length outside links and punctuation are summed per path and divided by the path's blocks. Both ratios
are fused, smoothed along the page, fused with the smoothed ones, and paths that reach a quarter of the page's typical ratio
mark the content. From them follows the container: the smallest element that most of their text is in and outside of which no path of the
same tags has a like ratio, sought from the root down and not below an article element (or main) once that is reached.

Names are a prior of ratios and decide nothing by themselves: paths in an article element count five times; a class or id that
says what isn't part of an article divides the ratio of the paths under it, by twelve if its words say nothing else (``comments``,
``related-posts``), by two if they do (``related-work``). A named element goes if no path in it passes. So a section of full
paragraphs stays whatever it is called, unless it is called nothing but comments, and a list of links goes that is named so.

Inside an article element all else stays, short blocks and those of links too. Any other container may hold more than the
article: there, parts in which no path passes go, and so do lists of links before the first and, in the body, after the last
passing block. Elements that can't be part of an article (menus, footers, sidebars, controls, what is hidden, forms that don't
frame the page) have no text here.

Paths are numbers and every step is linear in the page, however deep its elements nest.

Defined cases: null and empty html give an empty text; a page without any block too; markup that never ends is read to
the end of the page; equal ratios all pass or all fail; rows that repeat and null ids each have a result; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import slices, small_batches

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>)""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.S)
_MARKS = re.compile(r"[.,;:!?。，；：！？…]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text, to their end tag.
OPAQUE = frozenset("script style noscript template iframe object svg math canvas audio video textarea title".split())
#: Elements that stand in a line; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
#: Elements that never are part of an article.
ASIDE = frozenset("nav footer aside button select option menu dialog datalist head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split())
#: Words that speak against an element that has them in a class or id: any element, and those that hold others.
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion".split())
ASIDE_WORDS = frozenset(
    "banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices outbrain pager pagination popup recommended related replies reply respond share sharing sidebar signup skip social subscribe taboola toolbar warning widget widgets".split()
)
#: Words that say nothing of their own beside these: such a name is all about what isn't part of an article.
PLAIN_WORDS = frozenset(
    "and area articles aside bar block body bottom box btn button buttons column container content entry footer form global group header holder icons id inline inner item items js left link links list main media more net outer page panel post posts primary right row secondary section service site slot story stories thread title to top unit us view wrap wrapper".split()
)
#: Words that speak against an element only outside the container: an article has a header too.
OUTSIDE_WORDS = frozenset("header head top".split())
#: Beside these a word tells what stands next to the element, not what it is ("with-sidebar").
BESIDE = frozenset("with has no without".split())
#: What a path's ratio is multiplied by in an article element, and under names that say nothing or something beside such words.
ARTICLE, AGAINST, PARTLY = 5.0, 1 / 12, 1 / 2
#: The share of the typical ratio from which a path passes; the share of text up to which passing text outside an element doesn't
#: keep the container from being that element; the share of the typical ratio from which it does so where its tags are those of most
#: content; and the share of running text from which an element is no aside, whatever it is called.
PASS, LITTLE, WEAK, FRAME = 0.25, 0.5, 0.5, 0.9
#: An open element ends before another of its kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = frozenset("ul ol dl table body html article main section div".split())
CLOSE_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that hold running text: their classes don't count, and no smaller container is sought in them.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary address".split())
FLOW = TEXTS | frozenset("tr tbody thead ul ol dl table figure details hr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _said(words: list[str], tag: str) -> float:
    """What a class or id of these words multiplies the ratio by of the paths in an element of this tag."""
    aside = ADVERT_WORDS if tag in TEXTS - {"li"} else ADVERT_WORDS | ASIDE_WORDS
    if aside.isdisjoint(words):
        return 1.0
    return AGAINST if all(w in aside or w in PLAIN_WORDS or w.isdigit() for w in words) else PARTLY


class _Element:
    __slots__ = ("tag", "path", "kind", "parent", "number", "block", "out", "head", "form", "article", "link", "against", "prior")

    def __init__(self, tag: str, attrs: str, parent: "_Element | None", number: int, paths: dict):
        self.tag, self.parent, self.number = tag, parent, number
        self.block = parent.block if parent and tag in INLINE else self
        self.out = bool(parent and parent.out) or tag in ASIDE
        self.head = bool(parent and parent.head)
        self.form = (parent.form if parent else None) or (self if tag == "form" else None)
        above = parent.article if parent else None
        self.article = above or (self if tag in ("article", "main") else None)
        self.link = tag == "a" or bool(parent and parent.link)
        self.against = 1.0
        mark = ""
        if tag == "header" and not above:
            self.head = True
        if "=" in attrs or "hidden" in attrs:
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
            named = f"{values.get('class', '')} {values.get('id', '')}"
            frame = tag in ("html", "body", "main") or tag == "article" and not above
            if named.strip() and not frame and tag not in INLINE:
                names = [re.findall(r"[a-z]+|\d+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", n).lower()) for n in named.split()]
                if not any(not BESIDE.isdisjoint(n) for n in names):
                    self.against = min((_said(n, tag) for n in names), default=1.0)
                    if not above and tag not in TEXTS and any(not OUTSIDE_WORDS.isdisjoint(n) for n in names):
                        self.head = True
            style = values.get("style", "").replace(" ", "").lower()
            if values.get("role", "").lower() in ASIDE_ROLES or "display:none" in style or values.get("aria-hidden", "").lower() == "true" or re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub(" ", attrs)):
                self.out = True
            if values.get("role", "").lower() == "main" and not self.article:
                self.article = self
            if tag not in TEXTS:
                mark = values.get("class", "").strip().lower()
        self.prior = (parent.prior if parent else 1.0) * (ARTICLE if self.article is self else 1.0)
        step = (parent.path if parent else -1, tag, mark, self.against)
        self.path = paths.setdefault(step, len(paths))
        step = (parent.kind if parent else -1, tag)
        self.kind = paths.setdefault(step, len(paths))


class Block:
    __slots__ = ("text", "element", "linked", "score")

    def __init__(self, text: str, element: _Element, linked: int):
        self.text, self.element, self.linked, self.score = text, element, linked, 0.0


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, each with the innermost block element around it."""
    paths: dict[tuple, int] = {}
    root = _Element("#", "", None, 0, paths)
    stack, out, held = [root], [], []
    holder, made, open_tags = [root], [1], {}

    def flush() -> None:
        if held:
            text = " ".join("".join(t for t, _ in held).split())
            if text:
                out.append(Block(text, holder[0], sum(len(t) for t, linked in held if linked)))
            held.clear()

    def say(raw: str) -> None:
        if raw:
            if not held:
                holder[0] = stack[-1].block
            held.append((html.unescape(raw) if "&" in raw else raw, stack[-1].link))

    def close_to(depth: int) -> None:
        if any(e.tag not in INLINE for e in stack[depth:]):
            flush()
        for e in stack[depth:]:
            open_tags[e.tag] -= 1
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            say("<")
            at = lt + 1
            continue
        at = m.end()
        if not m.lastindex or not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1) if open_tags.get(tag) else ():
                if stack[depth].tag == tag:
                    close_to(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag in OPAQUE:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in CLOSE_P and open_tags.get("p"):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        if tag in ENDS:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ENDS[tag]:
                    close_to(depth)
                    if tag != "tr" or not any(e.tag in ENDS[tag] for e in stack[-2:]):
                        break
                elif stack[depth].tag in FENCES:
                    break
        if tag not in INLINE:
            flush()
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(_Element(tag, m[3], stack[-1], made[0], paths))
            made[0] += 1
            open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return out


def ratios(blocks: list[Block], prior: dict[int, float], width: int = 2) -> list[float]:
    """The ratio of each block's path: text and punctuation per block of the path, smoothed along the page and fused with
    itself unsmoothed, so that a path owes its ratio to its own blocks as much as to those around them, times its prior."""
    chars: dict[int, float] = {}
    marks: dict[int, int] = {}
    count: dict[int, int] = {}
    for b in blocks:
        path = b.element.path
        chars[path] = chars.get(path, 0) + max(0, len(b.text) - b.linked)
        marks[path] = marks.get(path, 0) + len(_MARKS.findall(b.text))
        count[path] = count.get(path, 0) + 1
    fused = {p: (chars[p] / count[p]) * (0.5 + marks[p] / count[p]) ** 0.5 for p in count}
    line = [fused[b.element.path] for b in blocks]
    weights = [0.5 ** abs(k) for k in range(-width, width + 1)]
    smooth = dict.fromkeys(count, 0.0)
    for i, b in enumerate(blocks):
        near = [(line[i + k], weights[k + width]) for k in range(-width, width + 1) if 0 <= i + k < len(blocks)]
        smooth[b.element.path] += sum(v * w for v, w in near) / sum(w for _, w in near)
    final = {p: (fused[p] * smooth[p] / count[p]) ** 0.5 * prior.get(p, 1.0) for p in count}
    return [final[b.element.path] for b in blocks]


def _elements(blocks: list[Block]) -> list[_Element]:
    """The elements around the blocks, parents before children."""
    seen: dict[int, _Element] = {}
    for b in blocks:
        e = b.element
        while e and e.number not in seen:
            seen[e.number] = e
            e = e.parent
    return [seen[k] for k in sorted(seen)]


def _sums(elements: list[_Element], own: dict[int, float]) -> dict[int, float]:
    """Of each element the sum over itself and all below."""
    out = {e.number: own.get(e.number, 0) for e in elements}
    for e in reversed(elements):
        if e.parent:
            out[e.parent.number] += out[e.number]
    return out


def _lengths(blocks: list[Block]) -> dict[int, float]:
    out: dict[int, float] = {}
    for b in blocks:
        out[b.element.number] = out.get(b.element.number, 0) + len(b.text)
    return out


def _below(elements: list[_Element], marked: set[int]) -> set[int]:
    """The elements that are marked or stand in a marked one."""
    out: set[int] = set()
    for e in elements:
        if e.number in marked or e.parent and e.parent.number in out:
            out.add(e.number)
    return out


def _priors(elements: list[_Element], named: set[int]) -> dict[int, float]:
    """What the ratio of each path is multiplied by: an article's share, and the smallest that the named elements around it say."""
    said: dict[int, float] = {}
    out: dict[int, float] = {}
    for e in elements:
        own = e.against if e.number in named else 1.0
        said[e.number] = min(own, said[e.parent.number] if e.parent else 1.0)
        out[e.path] = min(out.get(e.path, ARTICLE), e.prior * said[e.number])
    return out


def _without_forms(blocks: list[Block]) -> list[Block]:
    """Forms go, but for one that frames the page: most of the page's text is in it, and most of that in running text."""
    total = sum(len(b.text) for b in blocks)
    inside: dict[int, int] = {}
    running: dict[int, int] = {}
    for b in blocks:
        if b.element.form:
            n = b.element.form.number
            inside[n] = inside.get(n, 0) + len(b.text)
            running[n] = running.get(n, 0) + (len(b.text) if b.element.tag in TEXTS else 0)
    frames = {n for n in inside if 2 * inside[n] > total and 2 * running[n] > inside[n]}
    return [b for b in blocks if not b.element.form or b.element.form.number in frames and b.element.tag not in ("form", "label", "fieldset", "legend")]


def _container(elements: list[_Element], blocks: list[Block], passing: list[bool], typical: float) -> _Element:
    """The smallest element that holds the content, by the paths that pass."""
    own: dict[int, float] = {}
    kinds: dict[int, float] = {}
    for b, ok in zip(blocks, passing, strict=True):
        if ok and not b.element.head:
            own[b.element.number] = own.get(b.element.number, 0) + len(b.text)
            kinds[b.element.kind] = kinds.get(b.element.kind, 0) + len(b.text)
    weight = _sums(elements, own)
    top = elements[0]
    total = weight[top.number]
    main = max(kinds, key=lambda n: (kinds[n], -n), default=-1)
    direct = {e.number: 0.0 for e in elements}  # the largest ratio among blocks of the tags of most content
    for b, ok in zip(blocks, passing, strict=True):
        if ok and b.element.kind == main:
            direct[b.element.number] = max(direct[b.element.number], b.score)
    best = dict(direct)
    children: dict[int, list[_Element]] = {}
    for e in reversed(elements):
        if e.parent:
            best[e.parent.number] = max(best[e.parent.number], best[e.number])
            children.setdefault(e.parent.number, []).append(e)
    while top.article is not top and (some := [e for e in children.get(top.number, ()) if weight[e.number]]):
        inner = max(some, key=lambda e: (weight[e.number], -e.number))
        strongest = max([direct[top.number], *(best[e.number] for e in some if e is not inner)])
        if inner.tag in FLOW or inner.tag in INLINE or total - weight[inner.number] > LITTLE * total or strongest >= WEAK * typical:
            break
        top = inner
    return top


def main_text(page: str | None) -> str:
    """The text of the article of a page, its blocks joined by new lines."""
    blocks = _without_forms([b for b in blocks_of(page or "") if not b.element.out])
    if not blocks:
        return ""
    elements = _elements(blocks)
    # an element that nearly all running text is in is no aside, whatever it is called
    running = _sums(elements, _lengths([b for b in blocks if b.element.tag in TEXTS]))
    named = [e for e in elements if e.against < 1 and running[e.number] <= FRAME * running[elements[0].number]]
    prior = _priors(elements, {e.number for e in named})
    for b, v in zip(blocks, ratios(blocks, prior), strict=True):
        b.score = v
    # what is typical is what names say nothing against, as far as there is any
    plain = [b for b in blocks if prior[b.element.path] >= 1] or blocks
    typical = sum(b.score * len(b.text) for b in plain) / sum(len(b.text) for b in plain)
    passing = [b.score >= PASS * typical and 2 * b.linked <= len(b.text) for b in blocks]
    passed = {b.element.path for b, ok in zip(blocks, passing, strict=True) if ok}
    top = _container(elements, blocks, passing, typical)

    inside = _below(elements, {top.number})
    content = _sums(elements, _lengths([b for b in blocks if b.element.number in inside and b.element.path in passed]))
    aside = _below(elements, {e.number for e in named if e is not top and e.number in inside and not content[e.number]})
    kept = [b for b in blocks if b.element.number in inside and b.element.number not in aside]
    if top is not top.article:
        kept = _of_container(kept, elements, top, content, passed)
    return "\n".join(b.text for b in kept)


def _of_container(blocks: list[Block], elements: list[_Element], top: _Element, content: dict[int, float], passed: set[int]) -> list[Block]:
    """The blocks of a container that may hold more than the article."""
    body = top.tag in ("#", "html", "body")
    child: dict[int, _Element] = {}  # the child of ``top`` that an element stands in
    for e in elements:
        if e.parent is top:
            child[e.number] = e
        elif e.parent and e.parent.number in child:
            child[e.number] = child[e.parent.number]
    places = [i for i, b in enumerate(blocks) if b.element.path in passed and not (body and b.element.head)]
    first, last = (places[0], places[-1]) if places else (len(blocks), -1)
    while first and blocks[first - 1].element.tag in HEADINGS:
        first -= 1
    out = []
    for i, b in enumerate(blocks):
        if body and b.element.head:
            continue
        part = child.get(b.element.number, top)
        links = 2 * b.linked > len(b.text)
        if b.element.path in passed or b.element.tag in HEADINGS and first <= i:
            out.append(b)
        elif links and (i < first or body and i > last):
            continue
        elif part is top or part.tag in FLOW or content[part.number]:
            out.append(b)
    return out


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every row with text and n_chars (code points)."""
    small_batches(pages.sparkSession)
    source = pages.select(*keep, F.col(html_col).alias("text"))
    schema = source.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out = [main_text(x) for x in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=schema.names)

    return source.mapInArrow(rows, schema)


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
