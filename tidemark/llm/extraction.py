"""Main text of web pages by minimum-cut labelling.

A page is read once into blocks, the stretches of text between block-level tags.
A linear classifier over a block's words, links and enclosing elements gives the
cost of either label. These costs are the capacities to the two terminals of a
flow network; blocks that follow each other, and blocks next to each other in one
container, are joined by edges that are the stronger the closer they lie in the
element tree. The minimum cut, found by maximum flow, separates content from
boilerplate: a short paragraph follows its neighbours, an advert in between does not.

Nothing moves between pages; a task holds one batch of pages, and a page of any
length is taken whole. Reading is linear in the page; blocks whose cost outweighs all
their edges are settled before the flow, so the network holds undecided blocks only.

Defined cases: a null or empty page, and one without content, gives an empty
text. Unclosed elements, comments, quotes and pages cut short are read as browsers do.
Repeated rows and null ids are pages of their own; other columns may have any name.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_CHARS = 8_000_000


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# fixed values: element names of HTML
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title iframe noembed noframes xmp")
UNSEEN = _names("head script style template textarea title iframe noembed noframes xmp svg math canvas "
                "audio video object select datalist")  # fmt: skip
BLOCKS = _names(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav "
    "noscript ol option p plaintext pre search section summary table tbody td tfoot th thead tr ul"
)
CLOSES_P = BLOCKS - _names("button body caption html legend noscript option tbody td tfoot th thead tr")
#: An open element that such a start tag ends, and what it does not reach over.
ENDS = {
    "li": (_names("li"), _names("ul ol menu dir")),
    "dt": (_names("dt dd"), _names("dl")),
    "dd": (_names("dt dd"), _names("dl")),
    "option": (_names("option"), _names("select datalist")),
    "td": (_names("td th"), _names("tr table")),
    "th": (_names("td th"), _names("tr table")),
    "tr": (_names("tr td th"), _names("tbody thead tfoot table")),
    "tbody": (_names("tbody thead tfoot tr td th"), _names("table")),
    "tfoot": (_names("tbody thead tfoot tr td th"), _names("table")),
}
SCOPES = _names("table td th caption button html template")
LEAVES = _names("p li dt dd td th h1 h2 h3 h4 h5 h6 pre blockquote figcaption caption summary")

COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
OTHER = re.compile(r"<[!?/][^>]*+(?:>|\Z)")
TAG = re.compile(
    r"<(/?)([A-Za-z][^\s/>]*+)"
    r"((?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?|[^>=]++)*+)(>|\Z)"
)
ATTRIBUTE = re.compile(r"([^\s=/\"']++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier, in bits of evidence for content (less than 0: against).

    Region weights count once for each enclosing element, and nothing inside a
    boilerplate region makes up for it.
    """

    regions: dict[str, float] = field(
        default_factory=lambda: {
            "nav": -9, "footer": -9, "aside": -9, "form": -9, "dialog": -9, "menu": -9, "button": -9,
            "noscript": -9, "header": -9, "search": -9, "fieldset": -6, "article": 3, "main": 3,
        }
    )
    roles: dict[str, str] = field(
        default_factory=lambda: {
            "navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside",
            "search": "form", "form": "form", "dialog": "dialog", "alertdialog": "dialog", "alert": "dialog",
            "menu": "nav", "menubar": "nav", "toolbar": "nav", "main": "main", "article": "article",
        }
    )
    #: Words in class and id that mark boilerplate.
    marked: frozenset[str] = _names(
        "ad ads adbox adsense advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo "
        "promos promoted promotion promotions banner banners cookie cookies consent gdpr notice notices alert alerts "
        "popup popups modal overlay lightbox nav navbar navi navigation menu menus submenu sidebar sidebars aside "
        "rail footer masthead topbar breadcrumb breadcrumbs crumbs pagination pager paging comment comments disqus "
        "reply replies respond responses discussion share sharing social socials follow related recommended "
        "recommendations outbrain taboola newsletter subscribe subscription signup login signin register search "
        "searchbox widget widgets toolbar copyright legal skip"
    )
    #: Words that take the mark off a word after them, as in "no-sidebar".
    without: frozenset[str] = _names("no has with without hide show")
    #: Words in class and id that mark content, once.
    content: frozenset[str] = _names("article content entry post story main prose")
    #: Beginnings of longer words that mark boilerplate, and words that only look like it.
    stems: tuple[str, ...] = (
        "comment", "sidebar", "cookie", "footer", "advert", "sponsor", "newsletter", "breadcrumb", "pagination",
        "navigation", "navbar", "menu",
    )
    innocent: frozenset[str] = _names("commentary commentator")
    mark: float = -9
    region: float = 1.5
    header_inside: float = 0
    hidden: float = -9
    beside: float = -3
    base: float = -0.8
    word: float = 0.12
    most_words: float = 2.4
    sentence: float = 0.6
    leaf: float = 0.6
    heading: float = 0.8
    link: float = -4
    copyright: float = -4
    next: float = 2.4
    sibling: float = 1.2


class Element:
    """An open element: its place in the tree and what it tells about text inside."""

    __slots__ = ("name", "up", "depth", "score", "inside", "counted", "unseen", "p_open", "form")

    def __init__(self, name: str, up: Element | None, costs: Costs, attributes: str):
        self.name, self.up = name, up
        if up is None:
            self.depth = self.score = 0
            self.inside = self.counted = self.unseen = self.p_open = False
            self.form = None
            return
        self.depth, self.inside, self.counted = up.depth + 1, up.inside, up.counted
        self.unseen = up.unseen or name in UNSEEN
        self.p_open = name == "p" or (up.p_open and name not in SCOPES)
        self.form = self if name == "form" and up.form is None else up.form
        self.score = up.score + self._own(costs, attributes)

    def _own(self, costs: Costs, attributes: str) -> float:
        """What this element adds; a form's share is judged when the page has been read."""
        kind, own, marks = self.name, 0.0, []
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "role":
                kind = costs.roles.get(value.strip().lower(), kind)
            elif key in ("class", "id"):
                marks += value.split()
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                own += costs.hidden
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                own += costs.hidden
        weight = costs.regions.get(kind, 0)
        if kind == "form" and self.form is self:
            weight = 0
        if kind == "header" and self.inside:
            weight = costs.header_inside
        for mark in marks if self.name not in ("html", "body", "main") else ():
            words = [x.lower() for x in PART.findall(mark)]
            marked = [
                w
                for i, w in enumerate(words)
                if (w in costs.marked or (w.startswith(costs.stems) and w not in costs.innocent))
                and not (i and words[i - 1] in costs.without)
            ]
            if "header" in words and not self.inside and not costs.content & set(words):
                marked.append("header")
            if marked:
                own += costs.mark
            elif weight == 0 and costs.content & set(words):
                weight = costs.region
        if weight > 0:
            # counts once, and not in boilerplate
            clear = self.up.score >= 0 and own >= 0
            self.inside = self.inside or (clear and kind in ("article", "main"))
            weight = weight if clear and not self.counted else 0
            self.counted = self.counted or clear
        return own + weight


@dataclass
class Block:
    text: str
    holder: Element
    links: int  # code points inside links


def read_blocks(page: str, costs: Costs) -> list[Block]:
    """Blocks of ``page`` in order."""
    root = Element("", None, costs, "")
    here, opened, blocks = root, {}, []
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                holder = here
                while holder.up is not None and holder.name not in BLOCKS:
                    holder = holder.up
                blocks.append(Block(text, holder, len(" ".join("".join(linked).split()))))
            parts, linked = [], []

    def close(element: Element) -> None:
        nonlocal here
        while here is not element:
            opened[here.name] -= 1
            here = here.up
        opened[here.name] -= 1
        here = here.up

    def nearest(names: frozenset[str], barrier: frozenset[str]) -> Element | None:
        found, e = None, here
        if any(opened.get(n) for n in names):
            while e.up is not None and e.name not in barrier:
                found = e if e.name in names else found
                e = e.up
        return found

    at, end = 0, len(page)
    while at < end:
        stop = page.find("<", at)
        stop = end if stop < 0 else stop
        if stop > at:
            if not here.unseen:
                piece = references.unescape(page[at:stop])
                parts.append(piece)
                if opened.get("a"):
                    linked.append(piece)
            at = stop
            continue
        if page.startswith("<!--", at):
            at = COMMENT.match(page, at).end()
            continue
        m = TAG.match(page, at)
        if not m:
            other = OTHER.match(page, at)
            if other:
                at = other.end()
            else:  # a bare sign
                if not here.unseen:
                    parts.append("<")
                at += 1
            continue
        at = m.end()
        if not m[4]:
            break  # cut short inside a tag
        name = m[2].lower()
        if m[1]:
            if name in BLOCKS:
                flush()
            elif name == "br":
                parts.append(" ")
            if opened.get(name) and name not in VOID:
                e = here
                while e.name != name:
                    e = e.up
                if name in BLOCKS or not _crosses(here, e):
                    close(e)
            continue
        if name in VOID:
            if name == "br":
                parts.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in BLOCKS:
            flush()
            if opened.get("head") and name != "noscript":  # its end may be left out
                e = here
                while e.name != "head":
                    e = e.up
                close(e)
            if name in CLOSES_P and here.p_open:
                e = here
                while e.name != "p":
                    e = e.up
                close(e)
            if name in ENDS:
                e = nearest(*ENDS[name])
                if e is not None:
                    close(e)
        elif name == "a" and opened.get("a"):
            e = here
            while e.name not in ("a", "") and e.name not in BLOCKS:
                e = e.up
            if e.name == "a":
                close(e)
        if m[3].endswith("/") and name in ("svg", "path", "use"):
            continue
        here = Element(name, here, costs, m[3])
        opened[name] = opened.get(name, 0) + 1
        if name in RAW:
            ending = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = ending.start() if ending else end
    flush()
    return blocks


def _crosses(here: Element, wanted: Element) -> bool:
    """Whether the end of an inline element would close a block opened inside it."""
    while here is not wanted:
        if here.name in BLOCKS:
            return True
        here = here.up
    return False


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


def _container(holder: Element) -> Element:
    while holder.name in LEAVES and holder.up is not None:
        holder = holder.up
    return holder


def costs_of(blocks: list[Block], costs: Costs) -> list[float]:
    """Evidence for content of each block."""
    chars, inside, in_form = 0, 0, {}
    for b in blocks:
        n = len(b.text)
        chars += n
        inside += n if b.holder.inside and b.holder.score >= 0 else 0
        if b.holder.form is not None:
            in_form[id(b.holder.form)] = in_form.get(id(b.holder.form), 0) + n
    out = []
    for b in blocks:
        name, words = b.holder.name, b.text.count(" ") + 1
        score = costs.base + b.holder.score + min(costs.most_words, costs.word * words)
        if b.text[-1] in ".!?…:;。！？\"”»" and words > 2:
            score += costs.sentence
        if name in LEAVES:
            score += costs.heading if name in ("h1", "h2", "h3", "h4", "h5", "h6") else costs.leaf
        score += costs.link * min(1.0, b.links / len(b.text))
        if b.text[0] == "©" or b.text[:3].lower() == "(c)":
            score += costs.copyright
        # a form around half of the page is only a wrapper
        if b.holder.form is not None and 2 * in_form[id(b.holder.form)] < chars:
            score += costs.regions.get("form", 0)
        if inside and not b.holder.inside:
            score += costs.beside
        out.append(score)
    return out


def edges_of(blocks: list[Block], costs: Costs) -> list[tuple[int, int, float]]:
    """Smoothness between blocks that follow each other, in the page or in a container."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            near = _distance(blocks[i - 1].holder, b.holder)
            out.append((i - 1, i, costs.next / (1 + near)))
        key = id(_container(b.holder))
        if key in last and last[key] < i - 1:
            out.append((last[key], i, costs.sibling))
        last[key] = i
    return out


UNIT = 1000


def minimum_cut(evidence: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least total cost.

    A block against its evidence costs that much, an edge between unlike labels its
    weight. Costs are counted in thousandths; of equal cuts the one with
    the fewest content blocks is taken.
    """
    own = [round(x * UNIT) for x in evidence]
    links: list[dict[int, int]] = [{} for _ in own]
    for a, b, weight in edges:
        w = round(weight * UNIT)
        if a != b and w > 0:
            links[a][b] = links[a].get(b, 0) + w
            links[b][a] = links[b].get(a, 0) + w
    settled = _settle(own, links)
    rest = [i for i, label in enumerate(settled) if label is None]
    for i, label in zip(rest, _flow([own[i] for i in rest], _among(rest, links)), strict=True):
        settled[i] = label
    return settled


def _settle(own: list[int], links: list[dict[int, int]]) -> list[bool | None]:
    """Labels of blocks whose evidence outweighs all their edges; ``own`` of their
    neighbours takes these edges in."""
    label: list[bool | None] = [None] * len(own)
    free = [sum(x.values()) for x in links]
    todo = list(range(len(own)))
    while todo:
        i = todo.pop()
        if label[i] is not None or (abs(own[i]) <= free[i] if own[i] > 0 else -own[i] < free[i]):
            continue
        label[i] = own[i] > 0
        for j, w in links[i].items():
            if label[j] is None:
                own[j] += w if label[i] else -w
                free[j] -= w
                todo.append(j)
    return label


def _among(rest: list[int], links: list[dict[int, int]]) -> list[tuple[int, int, int]]:
    place = {i: k for k, i in enumerate(rest)}
    return [(place[i], place[j], w) for i in rest for j, w in links[i].items() if i < j and j in place]


def _flow(own: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Maximum flow by blocking flows; True where the source still reaches."""
    n = len(own)
    source, sink = n, n + 1
    heads: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: int, back: int) -> None:
        at[a].append(len(heads))
        heads.append(b)
        room.append(there)
        at[b].append(len(heads))
        heads.append(a)
        room.append(back)

    for i, x in enumerate(own):
        if x > 0:
            arc(source, i, x, 0)
        elif x < 0:
            arc(i, sink, -x, 0)
    for a, b, w in edges:
        arc(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for v in queue:
            for e in at[v]:
                if room[e] and level[heads[e]] < 0:
                    level[heads[e]] = level[v] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                least = min(room[e] for e in path)
                back = 0
                for k, e in enumerate(path):
                    room[e] -= least
                    room[e ^ 1] += least
                    if not room[e] and not back:
                        back = k + 1
                v = heads[path[back - 1] ^ 1]
                del path[back - 1 :]
                continue
            while turn[v] < len(at[v]):
                e = at[v][turn[v]]
                if room[e] and level[heads[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(at[v]):
                path.append(at[v][turn[v]])
                v = heads[path[-1]]
            elif path:
                v = heads[path.pop() ^ 1]
                turn[v] += 1
            else:
                break


def main_text(page: str | None, costs: Costs | None = None) -> str:
    """Content blocks of one page, an empty line between them."""
    if not page:
        return ""
    costs = costs or Costs()
    blocks = read_blocks(page, costs)
    labels = minimum_cut(costs_of(blocks, costs), edges_of(blocks, costs))
    return "\n\n".join([b.text for b, content in zip(blocks, labels, strict=True) if content])


ADDED = ("text", "n_chars")


def extract(pages: DataFrame, costs: Costs | None = None, html: str = "html") -> DataFrame:
    """``pages`` without the markup, with ``text`` and ``n_chars`` in its place.

    Own columns of these names are replaced.
    """
    weights = costs or Costs()
    names = [c for c in pages.columns if c not in (*ADDED, html)]
    inner = {c: f"own{i}" for i, c in enumerate(names)}
    plain = pages.select(
        *[F.col(f"`{c}`").alias(v) for c, v in inner.items()], F.col(f"`{html}`").alias("page")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, texts = 0, 0, []
            for i, page in enumerate(batch.column("page")):
                value = page.as_py()
                texts.append(main_text(value, weights))
                size += len(value or "")
                if size >= BATCH_CHARS or i + 1 == batch.num_rows:
                    own = batch.slice(start, len(texts))
                    columns = [own.column(c) for c in inner.values()]
                    new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, *new], [*inner.values(), *ADDED])
                    start, size, texts = i + 1, 0, []

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name != "page"]
    found = plain.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
    return found.select(*[F.col(v).alias(c) for c, v in inner.items()], *ADDED)
