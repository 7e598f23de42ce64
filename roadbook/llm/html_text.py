"""Operator 10: main text of web pages by consensus paths of each host.

Each page's containers are scored by the text of their blocks, less links and
more where the markup says article or main. The page's best containers vote, by
share of the page's score, for their path: tags with classes, numbers taken out.
The best one is first widened to the boxes around it that add text but no lists
of links, and its own parts do not vote.
Spark counts the votes of each host, and every page is extracted again from the
containers on its host's winning path; a page that has none there uses its own
best container. Within a container menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are left out. A form, or a
box with a listed word in its names, stays where it holds the page's main text:
see ``_resolve``. Beside a word that says what something is about (``share-price``,
``related-work``) a listed word marks nothing, and among other words it never drops
a heading, a paragraph or words in a line. Where the article stands directly in the
body, loose text and boxes without a name around it go with it.

Defined results: null and empty html give the empty text; a page without a
usable url has no host and votes for itself alone; unfinished markup at the end
is dropped, unclosed elements end with the page; repeated rows are rows of their
own; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship, type_of

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TOKENS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
# Elements that hold blocks; the others of BLOCKS are blocks whose end tag may be missing.
CONTAINERS = frozenset("""article aside blockquote body center details dialog div dl fieldset figure footer form header
html main menu nav ol search section table td ul""".split())
SKIPPED = frozenset("""aside button canvas datalist dialog footer form header input menu nav noscript
object optgroup option search select svg template audio video""".split())
SKIPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words of a class or id that mark what is not the article.
SKIPPED_WORDS = frozenset("""ad ads adsense advert advertisement advertisements adverts alert banner breadcrumb
breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr header masthead menu menus modal nav
navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup promo promoted
promotion recommended recommendations related reply replies respond share sharing sidebar sidebars signup skip social
sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets""".split())
_ONLY_LAYOUT = frozenset("has no with without open closed".split())
# Words that say where or how a box stands, not what it holds: beside one of them a listed word still marks a box.
_PLACES = frozenset("""above after area areas before below block blocks body bottom box boxes btn btns button buttons card cards center
col column columns container content desktop entries fixed float floating footer form global grid group head holder icon icons inline inner
item items js label large layer left link links list lists location main mobile module modules outer page panel post posts primary right
row section secondary site slot small sticky stories strip style text title top unit view wrap wrapper zone""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a heading's own class may say of it.
_OF_HEADINGS = frozenset("header masthead banner".split())
# Words that mark readers' text, in any name.
_READERS = frozenset("comment comments disqus replies reply respond".split())
MAIN = frozenset("article main".split())
# Elements that end at their next sibling, with the elements within which that is looked for.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table", "tr"), "th": ("table", "tr"), "tr": ("table",)}
# How sure it is that an element is left out: a form or a listed word among others, names of listed words, the rest.
NOT, DOUBTED, NAMED, SURE = range(4)
WHOLE = frozenset("html body main article".split())
_SEMANTIC = {"article": 3.0, "main": 2.0, "body": 0.7, "html": 0.1}
# A block counts half as much for each container further out, as far as that is seen.
FAINTEST = 2.0**-20
# A page's vote goes to containers with at least this share of its best score, in thousandths.
LEAST_SHARE = 250
# A host with more than this part of all pages gets its path without a shuffle; there are fewer such hosts.
LARGE_HOSTS = 1_000


class Container:
    """An open element that holds blocks, or one whose content is left out."""

    __slots__ = ("tag", "step", "parent", "skipped", "mark", "size", "score", "weight", "heading", "_path")

    def __init__(self, tag: str, step: str, parent: Container | None, mark: int, weight: float):
        self.tag, self.step, self.parent, self.mark, self.weight = tag, step, parent, mark, weight
        self.skipped = mark == SURE or parent is not None and parent.skipped  # for sure; others are resolved later
        self.size, self.score = 0, 0.0
        self.heading = False
        self._path: str | None = None

    def path(self) -> str:
        """Built once for the box around, which siblings share."""
        if self.parent is None or not self.tag:
            return ""
        up = self.parent
        if up._path is None:
            steps, box = [], up
            while box is not None and box.tag and box._path is None:
                steps.append(box.step)
                box = box.parent
            before = box._path if box is not None and box._path is not None else ""
            up._path = before + "".join(f">{step}" for step in reversed(steps))
        return f"{up._path}>{self.step}"


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text else {}


def _boilerplate(tag: str, attributes: dict[str, str]) -> int:
    mark = DOUBTED if tag == "form" else SURE if tag in SKIPPED else NOT
    if mark == SURE or not attributes:
        return mark
    role = attributes.get("role", "").lower()
    if "hidden" in attributes or role in SKIPPED_ROLES and (tag, role) != ("form", "form"):
        return SURE if tag not in ("html", "body") else NOT
    if tag in ("html", "body", "main"):
        return NOT
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return SURE
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    for name in names.split():
        words = set(_TOKENS.split(_CAMEL.sub("-", name).lower())) - {""}
        listed = words & SKIPPED_WORDS
        if tag in _HEADINGS:
            listed -= _OF_HEADINGS
        if listed and _ONLY_LAYOUT.isdisjoint(words):
            others = {w for w in words - SKIPPED_WORDS if not w.isdigit()}
            if not others or not _READERS.isdisjoint(words):
                mark = max(mark, NAMED)
            elif others <= _PLACES:  # another word says what the box is about: a price, a recipe, related work
                mark = max(mark, DOUBTED)
    return mark


def _step(tag: str, attributes: dict[str, str]) -> str:
    """The element's part of a path: its tag and classes, numbers taken out."""
    classes = sorted({_DIGITS.sub("", c) for c in attributes.get("class", "").split()} - {""})
    name = _DIGITS.sub("", attributes.get("id", "")) if not classes else ""
    return tag + "".join("." + c for c in classes) + ("#" + name if name else "")


def blocks(html: str, made: list[Container]) -> Iterator[tuple[Container, str, int, bool]]:
    """The page's blocks in order: their container, text, characters in links, and whether a heading.

    Blocks of boxes that are left out for sure are missing. ``made`` gets the containers as they open.
    """
    top = here = owner = Container("", "", None, NOT, 0.1)
    made.append(top)
    depth: list[tuple[str, Container]] = []  # open containers and skipped elements
    opened: dict[str, int] = {}  # how many of each are open
    text: list[str] = []
    linked, link, heading = 0, False, False
    at, end = 0, len(html)

    def close(first: int) -> Container:
        """Close what was opened since; the box that is open then."""
        for name, _ in depth[first:]:
            opened[name] -= 1
        del depth[first:]
        return depth[-1][1] if depth else top

    def open_(name: str, box: Container) -> Container:
        made.append(box)
        depth.append((name, box))
        opened[name] = opened.get(name, 0) + 1
        return box

    def flush() -> tuple[Container, str, int, bool] | None:
        joined = " ".join("".join(text).split()) if text else ""
        text.clear()
        return (owner, joined, linked, heading) if joined else None

    while at < end:
        start = html.find("<", at)
        if start < 0:
            start = end
        if start > at and not here.skipped:
            part = html[at:start]
            text.append(unescape(part) if "&" in part else part)
            owner = here
            if link:
                linked += start - at
        if start == end:
            break
        found = _TOKEN.match(html, start)
        if not found:
            after = html[start + 1: start + 3]
            if not re.match(r"/?[a-zA-Z]", after):
                if not here.skipped:
                    text.append("<")
                at = start + 1
                continue
            found = _LOOSE.match(html, start)
            if not found:
                break  # a tag that the page's end cuts off
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(found[1])
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":  # a place to jump to is no link
            link = not closing and "href" in _attributes(found[3])
            continue
        if tag in RAW and not closing:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            if not stop:
                break
            after = html.find(">", stop.end())
            at = after + 1 if after >= 0 else end
            continue
        if tag in BLOCKS:
            if done := flush():
                yield done
            linked, heading = 0, not closing and tag in ("h1", "h2")
            link = link and not closing  # a link that was left open ends with its block
            while depth and depth[-1][0] == "p":  # a skipped paragraph ends with the next block
                here = close(len(depth) - 1)
        if tag in _ENDS and not closing and any(opened.get(t) for t in _ENDS[tag]):
            ends, scope, first = _ENDS[tag], _SCOPE[tag], len(depth)
            for i in range(len(depth) - 1, -1, -1):
                if depth[i][0] in scope and depth[i][0] != tag:
                    break
                if depth[i][0] in ends:
                    first = i
            here = close(first)
        if closing:
            if opened.get(tag):
                first = len(depth) - 1
                while depth[first][0] != tag:
                    first -= 1
                here = close(first)
            continue
        if tag in VOID:
            continue
        attributes = _attributes(found[3])
        mark = NOT if here.skipped else _boilerplate(tag, attributes)
        if tag in CONTAINERS:
            weight = _SEMANTIC.get(tag, 1.0)
            if attributes.get("role", "") == "main" or attributes.get("itemprop", "") == "articleBody":
                weight = 3.0
            here = open_(tag, Container(tag, _step(tag, attributes), here, mark, weight))
        elif mark not in (NOT, DOUBTED):
            here = open_(tag, Container(tag, tag, here, SURE, 0.0))  # left out of the block around it
    if done := flush():
        yield done


def _resolve(found: list[tuple[Container, str, int, bool]], made: list[Container]) -> None:
    """Which of the marked boxes are left out.

    A box of a marked kind stays if it is or holds an article or main and the text outside marked boxes has
    none; a doubted one also if it holds half of the page's text. If nothing would be left, the doubted boxes
    stay, or else the named ones.
    """
    if not any(box.mark in (DOUBTED, NAMED) for box in made):
        return
    for box, text, *_ in found:
        box.size += len(text)
    free, inside, within = 0, {}, {}
    for box in made:  # parents come before what they hold
        up = box.parent
        inside[box] = box.mark != NOT or up is not None and inside[up]
        within[box] = box.tag in MAIN or up is not None and within[up]
        if within[box] and not inside[box]:
            free += box.size
    for box in reversed(made):
        if box.parent is not None:
            box.parent.size += box.size
    total = made[0].size
    mains = [box for box in made if box.tag in MAIN and box.size and not box.skipped]
    asked = set()
    for box in mains:
        sole = box.tag == "main" or len(mains) == 1
        up = box
        while up is not None and (up, sole, box.tag) not in asked:  # nested ones ask the boxes around them once
            asked.add((up, sole, box.tag))
            if up.mark in (DOUBTED, NAMED) and (sole or 2 * up.size >= total) and (
                    box.tag == "main" or free == 0 or up.mark == DOUBTED and 4 * free < total):
                up.mark = NOT
            up = up.parent
    for box in made:
        if box.mark == DOUBTED and 2 * box.size >= total and 4 * free < total:
            box.mark = NOT
    for kind in (None, DOUBTED, NAMED):
        for box in made:
            if box.mark == kind:
                box.mark = NOT
            box.skipped = box.mark != NOT or box.parent is not None and box.parent.skipped
        if any(not box.skipped for box, *_ in found):
            return


def scored(html: str) -> tuple[list[tuple[Container, str, int]], dict[int, Container]]:
    """The page's blocks, and its containers with their scores."""
    page, containers, made = [], {}, []
    found = list(blocks(html, made))
    _resolve(found, made)
    for box, text, linked, heading in found:
        if box.skipped:
            continue
        page.append((box, text, linked))
        worth = max(0.0, len(text) - 1.5 * linked)
        share = 1.0
        while box is not None and box.tag and share > FAINTEST:
            containers[id(box)] = box
            box.score += worth * share * box.weight
            box.heading |= heading
            share /= 2
            box = box.parent
    return page, containers


def _widened(best: Container, page: list[tuple[Container, str, int]]) -> Container:
    """The outermost box around ``best`` below the body whose other text is no list of links and no more than what it has.

    An article or main is whole by itself.
    """
    around, box = [best], best
    while box.tag not in WHOLE and box.parent is not None and box.parent.tag not in ("", "html", "body"):
        box = box.parent
        around.append(box)
    if len(around) == 1:
        return best
    level: dict[Container, int | None] = {box: i for i, box in enumerate(around)}
    texts, links = [0] * len(around), [0] * len(around)
    for box, text, linked in page:
        seen = []
        while box is not None and box not in level:
            seen.append(box)
            box = box.parent
        at = level[box] if box is not None else None
        level.update(dict.fromkeys(seen, at))
        if at is not None:
            texts[at] += len(text)
            links[at] += linked
    own, chosen = texts[0], best
    for box, text, linked in zip(around[1:], texts[1:], links[1:]):
        if 2 * linked > text or text > own:
            break
        if text:
            own, chosen = own + text, box
    return chosen


def _on_page(box: Container) -> bool:
    return box.tag in ("", "html", "body")


def _beside(chosen: list[Container], page: list[tuple[Container, str, int]]) -> list[Container]:
    """What goes with boxes that stand directly in the body: text around them, and boxes without a name or of theirs.

    Lists of links do not, nor anything beside an article or main.
    """
    if not chosen or any(c.tag in WHOLE or c.parent is None or not _on_page(c.parent) for c in chosen):
        return []
    steps = {c.step for c in chosen}
    outer: dict[Container, Container] = {}
    texts: dict[Container, list[int]] = {}
    for box, text, linked in page:
        seen, at = [], box
        while at not in outer and not _on_page(at) and not _on_page(at.parent):
            seen.append(at)
            at = at.parent
        at = outer.get(at, at)
        outer.update(dict.fromkeys([*seen, at], at))
        size = texts.setdefault(at, [0, 0])
        size[0] += len(text)
        size[1] += linked
    return [box for box, (text, linked) in texts.items() if 2 * linked <= text and box not in chosen
            and (_on_page(box) or box.step in steps or box.tag not in MAIN and box.step == box.tag)]


def votes(html: str) -> list[tuple[str, int]]:
    """The paths of the page's best containers with their shares in thousandths."""
    page, containers = scored(html)
    top = max(containers.values(), key=lambda c: c.score, default=None)
    shares: dict[str, int] = {}
    if top is not None and top.score > 0:
        best, whole = top.score, _widened(top, page)
        parts, box = {whole}, top
        while box is not whole:
            parts.add(box)
            box = box.parent
        if whole is not top:  # whatever is in the widened box
            others: set[Container] = set()
            for c in containers.values():
                seen, box = [], c
                while box is not None and box not in parts and box not in others:
                    seen.append(box)
                    box = box.parent
                (parts if box in parts else others).update(seen)
            shares[whole.path()] = 1000
        for c in containers.values():
            share = int(1000 * c.score / best)
            if share >= LEAST_SHARE and (whole is top or c not in parts):
                path = c.path()
                shares[path] = max(share, shares.get(path, 0))
    return list(shares.items())


def extract(html: str, path: str | None) -> str:
    """The text of the page's containers on ``path``, or else of its own best one."""
    page, containers = scored(html)
    chosen = [c for c in containers.values()
              if path and c.score > 0 and path.endswith(f">{c.step}") and c.path() == path]
    if not chosen:
        best = max(containers.values(), key=lambda c: c.score, default=None)
        chosen = [best] if best is not None else []
    if len(chosen) == 1:
        # the heading may stand beside the box that holds the paragraphs
        box = chosen[0]
        while not box.heading and box.tag not in WHOLE and box.parent is not None and box.parent.tag not in ("", "html", "body"):
            box = box.parent
            if box.heading:
                chosen = [box]
        chosen = [_widened(chosen[0], page)]
    loose = _beside(chosen, page)
    inside = {id(c): True for c in chosen} | {id(c): True for c in loose}

    around = {id(c) for c in loose if _on_page(c)}  # their own text, not all that they hold

    def is_inside(box: Container | None) -> bool:
        if id(box) in around:
            return True
        seen = []
        while box is not None and (id(box) not in inside or id(box) in around):
            seen.append(id(box))
            box = box.parent
        found = box is not None and inside[id(box)]
        inside.update(dict.fromkeys(seen, found))
        return found

    if not containers:
        return "\n".join(text for _, text, _ in page)
    return "\n".join(text for box, text, _ in page if is_inside(box))


def host(url) -> F.Column:
    """The url's host in small letters, null where there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def winning_paths(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``host, path``: the path with the most votes of each host's pages; one row a host."""
    ship(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, path, share) for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    if html for path, share in votes(html)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["host", "path", "share"])

    cast = pages.where("host is not null").select("host", html_col).mapInArrow(work, "host string, path string, share long")
    counted = cast.groupBy("host", "path").agg(F.sum("share").alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    return counted.withColumn("place", F.row_number().over(order)).where("place = 1").select("host", "path")


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, path, text``: the page's main text and its host's winning path."""
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                      host(F.col(url_col)).alias("host"))
    scratch = Scratch(df.sparkSession, "html")
    paths = scratch.keep(winning_paths(pages)).withColumnRenamed("host", "voter")

    # hosts with much of the pages, fewer than LARGE_HOSTS by their shares, meet their pages where those are read;
    # the pages of the others are dealt by host
    sizes = scratch.keep(pages.where("host is not null").groupBy(F.col("host").alias("large")).count())
    least = (sizes.agg(F.sum("count")).first()[0] or 0) / LARGE_HOSTS
    large = sizes.where(F.col("count") > least).select("large")
    of_large = large.join(paths, F.col("large") == F.col("voter"), "left").select("large", "path")
    here = pages.join(F.broadcast(of_large), F.col("host") == F.col("large"), "left").where("large is not null or host is null")
    there = (pages.where("host is not null").join(F.broadcast(large), F.col("host") == F.col("large"), "left_anti")
             .join(paths, F.col("host") == F.col("voter"), "left"))
    columns = ["id", "url", "path", "html"]
    joined = here.select(*columns).union(there.select(*columns))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html, path) if html else "" for path, html in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string())],
                                             names=["id", "url", "path", "text"])

    schema = f"id {type_of(df, id_col)}, url {type_of(df, url_col)}, path string, text string"
    return joined.mapInArrow(work, schema).withColumnsRenamed({"id": id_col, "url": url_col})
