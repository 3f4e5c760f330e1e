"""Main text of web pages by wrapper induction.

Pages of a host are made by one program, so their DOM trees are alike. Each page is reduced to a tree of its
block elements, in which like siblings in a row are one node. The most frequent tree of a host is
its reference; all others are aligned to it by simple tree matching. Each node of the reference is a slot with its
amounts of text and link text over all pages of the host; a slot whose blocks all stand on half of the pages is
constant, and template. The varying slots with the article are the wrapper, by which each page is read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.llm.common import column, materialize

#: Fixed values of HTML: elements without an end, with raw text, and those that flow within a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript iframe object svg textarea select title head canvas audio video annotation annotation-xml".split())
#: Without an end tag, the first of those go to the end of the page, and all others are empty; the second hold no elements of their kind.
TO_END, OPEN = set("script style".split()), set("head title".split())
MATH = set(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd "
    "mtext mtr munder munderover semantics".split()
)
#: Elements that make a block; all others, unknown ones too, flow within one.
BLOCK = set(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav noframes ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = MATH | set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: A start tag of the first kind ends an open element of the second.
ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table body article section div nav main".split())

#: Names of elements, and words in class, id and role, of what surrounds an article or stands for it.
AROUND_TAGS = set("nav footer aside form button dialog menu".split())
AROUND = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination popup promo related reply replies respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
WITHIN = set("article main content layout wrapper page container story".split())
#: Elements that a class or id never makes surroundings; words behind the last one that counts, and before names that tell a state.
NEVER_AROUND = set("# html body main h1 h2 h3 h4 h5 h6".split())
PARTS = set("area bar block body bottom box button buttons col form icons inner item items left link links list right row section slot top unit wrap".split())
STATES = set("has hide is no show with without".split())
#: Elements of running text carry ids as targets of links; only these ids make them surroundings.
TEXT_TAGS = set("section p ul ol li dl dt dd blockquote pre figure table tr td".split())
TEXT_IDS = set("breadcrumb breadcrumbs comment comments disqus masthead navbar related replies respond sidebar".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SELF_CLOSED, UNQUOTED_SLASH = re.compile(r"/\s*\Z"), re.compile(r"""=\s*[^\s"'>][^\s"'>]*/\s*\Z|=\s*/\s*\Z""")
RAW_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(script|style)(?![\w-]).*?(?:</\1(?![\w-])|\Z)|<(/?)({"|".join(sorted(RAW - TO_END - OPEN, reverse=True))})(?![\w-])((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.S | re.I,
)
#: A block is common if at least so many pages of a host, and at least this share of them, have it: one page alone tells nothing.
LEAST_PAGES, TEMPLATE_SHARE = 2, 0.5
#: Groups of up to so many siblings that repeat are one group.
PERIOD = 4


class Node:
    """An element: its label, its children, and blocks of text (text, characters that are links) before each child."""

    __slots__ = ("label", "tag", "children", "parent")

    def __init__(self, tag: str, label: str, parent: Node | None):
        self.tag, self.label, self.parent, self.children = tag, label, parent, []


@lru_cache(4096)
def _label(tag: str, attributes: str) -> str:
    names = set()
    for m in ATTRIBUTE.finditer(attributes):
        words = re.sub(r"[^a-z \-_]", "", " ".join((m.group(2) or m.group(3) or m.group(4) or "").lower().replace(".", " ").split()))
        names.update("#" * (m.group(1).lower() == "id") + w for w in words.split())
    return ".".join([tag, *sorted(names)])


def _raw_ends(source: str) -> dict[int, int]:
    """Where each element that is not read ends, by its start; those without an end tag of their own are left out."""
    ends, open_ = {}, {}
    for m in RAW_TOKEN.finditer(source):
        tag = (m.group(3) or "").lower()
        if m.group(2):
            if open_.get(tag):
                ends[open_[tag].pop()] = m.end()
        elif tag and not (SELF_CLOSED.search(m.group(4)) and not UNQUOTED_SLASH.search(m.group(4))):
            open_.setdefault(tag, []).append(m.start())
    return ends


def makes_node(tag: str, attributes: str) -> bool:
    """Whether an element is a node of the tree: blocks are, and others that are known to surround an article."""
    return tag in BLOCK or tag in AROUND_TAGS or tag not in INLINE and tag not in VOID and _surrounding(_label(tag, attributes), False)


def parse(source: str) -> Node:
    """The tree of a page. Texts are children too: (text, whether within a link)."""
    root = here = Node("#", "#", None)
    at, links, size, ends = 0, 0, len(source), None
    open_others: set[str] = set()
    while at < size:
        start, m = source.find("<", at), None
        while start >= 0 and not (m := TOKEN.match(source, start)):
            start = source.find("<", start + 1)  # no tag: a character of the text
        text = source[at:start] if m else source[at:]
        if text:
            here.children.append((text, links > 0))
        if not m:
            break
        at, tag = m.end(), (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag in INLINE:
                links = max(0, links - 1) if tag == "a" else links
                continue
            if not makes_node(tag, "") and tag not in open_others:
                continue
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here, links = node.parent, 0
                open_others.discard(tag)
            continue
        if tag in RAW:
            if SELF_CLOSED.search(m.group(3)) and not UNQUOTED_SLASH.search(m.group(3)):
                continue
            if tag in TO_END or tag in OPEN:
                end = re.compile(rf"</{re.escape(tag)}(?![\w-])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size if tag in TO_END else at
            else:
                ends = _raw_ends(source) if ends is None else ends
                at = ends.get(start, at)
            continue
        if tag in INLINE:
            if tag in ("br", "mtr", "mtd", "mspace"):
                here.children.append((" ", False))
            links += tag == "a"
            continue
        if not makes_node(tag, m.group(3)):
            continue
        if tag not in BLOCK and tag not in AROUND_TAGS:
            open_others.add(tag)
        closes = {"p"} if tag in ENDS_P else ENDS_OWN.get(tag, ())
        node = here
        while closes and node is not root:
            if node.tag in closes:
                here = node.parent
                break
            if node.tag in SCOPES:
                break
            node = node.parent
        new = Node(tag, _label(tag, m.group(3)), here)
        here.children.append(new)
        if tag not in VOID:
            here, links = new, 0
    return root


class Page:
    """A parsed page: its shape, and its blocks (node number in the shape, text, characters that are links)."""

    def __init__(self, source: str):
        self.labels: list[str] = []
        self.parents: list[int] = []
        self.blocks: list[tuple[int, str, int]] = []
        kids: list[list[int]] = []
        trails: list[list[int]] = []  # the last children of each node, one number for those that are one node

        def number(label: str, parent: int) -> int:
            """Like siblings in a row are one node, and so are those of like groups in a row."""
            trail = trails[parent] if parent >= 0 else []
            recent = [self.labels[t] for t in trail] + [label]
            for p in range(1, PERIOD + 1):
                if p == 1 and recent[-2:-1] == [label] or p > 1 and len(recent) >= 2 * p and recent[-p:] == recent[-2 * p : -p]:
                    found = trail[-p]
                    break
            else:
                found = len(self.labels)
                self.labels.append(label)
                self.parents.append(parent)
                kids.append([])
                trails.append([])
                if parent >= 0:
                    kids[parent].append(found)
            trail.append(found)
            del trail[: -2 * PERIOD]
            return found

        def close(at: int, run: list) -> None:
            text = " ".join(html.unescape("".join(t for t, _ in run)).split())
            if text:
                self.blocks.append((at, text, len("".join(t for t, link in run if link).strip())))
            run.clear()

        todo = [(iter([parse(source)]), -1, [])]
        while todo:
            rest, at, run = todo[-1]
            child = next(rest, None)
            if child is None:
                close(at, run)
                todo.pop()
            elif isinstance(child, tuple):
                run.append(child)
            else:
                close(at, run)
                todo.append((iter(child.children), number(child.label, at), []))
        self.shape = _written(self.labels, kids, 0)
        self.order = _preorder(kids)

    def numbered(self) -> list[tuple[int, str, int]]:
        """The blocks with the numbers of ``read_shape``."""
        return [(self.order[at], text, link) for at, text, link in self.blocks]


def _preorder(kids: list[list[int]]) -> list[int]:
    order, todo, count = [0] * len(kids), [0], 0
    while todo:
        at = todo.pop()
        order[at] = count
        count += 1
        todo.extend(reversed(kids[at]))
    return order


def _written(labels: list[str], kids: list[list[int]], top: int) -> str:
    """A shape as text: each label in preorder with its depth."""
    out, todo = [], [(top, 0)]
    while todo:
        at, depth = todo.pop()
        out.append(f"{depth}:{labels[at]}")
        todo.extend((k, depth + 1) for k in reversed(kids[at]))
    return " ".join(out)


@lru_cache(4096)
def read_shape(shape: str) -> tuple[list[str], list[int], list[list[int]]]:
    """Labels, parents and children of a shape, in preorder."""
    labels, parents, kids, path = [], [], [], []
    for number, item in enumerate(shape.split(" ")):
        depth, label = item.split(":", 1)
        del path[int(depth) :]
        labels.append(label)
        parents.append(path[-1] if path else -1)
        kids.append([])
        if path:
            kids[path[-1]].append(number)
        path.append(number)
    return labels, parents, kids


@lru_cache(4096)
def align(shape: str, reference: str) -> list[int]:
    """Simple tree matching: for each node of a shape its partner in the reference, or -1.

    Partners have equal labels, their parents are partners, and the order of siblings is kept; the number
    of partners is the largest possible.
    """
    labels, _, kids = read_shape(shape)
    others, _, other_kids = read_shape(reference)
    by_label = [_by_label(others, below) for below in other_kids]
    known: dict[tuple[int, int], tuple[int, list]] = {}
    # From the leaves up, without recursion: a pair is weighed when all pairs of its children are.
    todo = [(0, 0, False)] if labels[0] == others[0] else []
    while todo:
        a, b, ready = todo.pop()
        if (a, b) in known:
            continue
        if not ready and kids[a] and other_kids[b]:
            todo.append((a, b, True))
            for x in kids[a]:
                todo.extend((x, other_kids[b][j], False) for j in by_label[b].get(labels[x], ()) if kids[x] and other_kids[other_kids[b][j]])
            continue
        above, moves = np.zeros(len(other_kids[b]) + 1, np.int32), []
        for x in kids[a] if other_kids[b] else ():
            here = above[1:].copy()
            where = by_label[b].get(labels[x])
            if where is not None:
                # A pair without children on one side is one pair of nodes.
                weights = 1 if not kids[x] else np.array([known.get((x, other_kids[b][j]), (1,))[0] for j in where], np.int32)
                here[where] = np.maximum(here[where], above[where] + weights)
            row = np.append(np.int32(0), np.maximum.accumulate(here))
            moves.append((np.packbits(row == above), np.packbits(row[1:] == row[:-1])))
            above = row
        known[a, b] = int(above[-1]) + 1, moves

    partner = [-1] * len(labels)
    pairs = [(0, 0)] if labels[0] == others[0] else []
    while pairs:
        a, b = pairs.pop()
        partner[a], moves = b, known[a, b][1] if (a, b) in known else []
        i, j = len(moves), len(other_kids[b])
        while i and j:
            up, left = moves[i - 1]
            if up[j >> 3] >> (7 - (j & 7)) & 1:
                i -= 1
            elif left[(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1:
                j -= 1
            else:
                pairs.append((kids[a][i - 1], other_kids[b][j - 1]))
                i, j = i - 1, j - 1
    return partner


def _by_label(labels: list[str], nodes: list[int]) -> dict[str, np.ndarray]:
    """The places of siblings by their label."""
    places: dict[str, list[int]] = {}
    for j, node in enumerate(nodes):
        places.setdefault(labels[node], []).append(j)
    return {label: np.array(p) for label, p in places.items()}


def _names_around(name: str, among: set[str]) -> bool:
    """Whether a name, or its last word before words for parts, is one of ``among``."""
    words = [w for w in re.split("[-_]", name) if w]
    if len(words) > 1 and words[0] in STATES or not WITHIN.isdisjoint(words):
        return False
    while len(words) > 1 and words[-1] in PARTS and words[-1] not in among:
        words.pop()
    return bool(words) and words[-1] in among


@lru_cache(4096)
def _surrounding(label: str, inside: bool) -> bool:
    """Whether an element is known to surround an article; ``inside``: it stands in an article or main element."""
    tag, *names = label.split(".")
    if "-" in tag:
        names.append(tag)  # an element of the page's own: its name tells what it is
    if tag in AROUND_TAGS or tag == "header" and not inside:
        return True
    if tag in NEVER_AROUND or any(w in WITHIN for name in names for w in re.split("[-_#]", name)):
        return False
    for name in names:
        if name[0] != "#":
            if _names_around(name, AROUND):
                return True
        elif tag in TEXT_TAGS and name.strip("#-_") in TEXT_IDS or tag not in TEXT_TAGS and _names_around(name[1:], AROUND):
            return True
    return False


def _flags(shape: str, amounts: dict[int, tuple[int, int]]) -> tuple[list[bool], list[bool], list[bool]]:
    """For each node: whether it surrounds an article; whether it or one above it does; whether it is or is in an article element.

    A form, or what only its name makes surroundings, is none if it holds what no other part of the page can be: the
    only article elements, or most of the text while a main heading or any text worth mention stands nowhere else.
    """
    labels, parents, _ = read_shape(shape)
    tags = [label.split(".", 1)[0] for label in labels]
    named, inside = [], []
    for label, tag, parent in zip(labels, tags, parents):
        within = parent >= 0 and inside[parent]
        named.append(_surrounding(label, within))
        inside.append(within or tag in ("article", "main"))
    fixed = [n and (t == "header" or t in AROUND_TAGS and t != "form") for n, t in zip(named, tags)]
    shut = list(fixed)
    for i, parent in enumerate(parents):
        shut[i] = shut[i] or parent >= 0 and shut[parent]
    chars = [0 if shut[i] or 2 * links > held else held for i in range(len(labels)) for held, links in (amounts.get(i, (0, 0)),)]
    whole, articles, titles = list(chars), [t in ("article", "main") and not s for t, s in zip(tags, shut)], [t == "h1" and not s for t, s in zip(tags, shut)]
    for i in range(len(labels) - 1, 0, -1):
        whole[parents[i]] += whole[i]
        articles[parents[i]] |= articles[i]
        titles[parents[i]] |= titles[i]
    while True:
        around = []
        for i, parent in enumerate(parents):
            around.append(named[i] or parent >= 0 and around[parent])
        may = [i for i, parent in enumerate(parents) if named[i] and not fixed[i] and not shut[i] and whole[i] and not (parent >= 0 and around[parent])]
        if not may or any(t in ("article", "main") and not a for t, a in zip(tags, around)):
            return named, around, inside
        best = max(may, key=lambda i: (articles[i], whole[i]))
        if not articles[best]:
            free = sum(c for c, a, t in zip(chars, around, tags) if not a and t != "h1")
            titled = any(t == "h1" and not a for t, a in zip(tags, around))
            if 2 * whole[best] <= whole[0] or (free > 0 if titled else not titles[best] and 10 * free >= whole[best]):
                return named, around, inside
        named[best] = False


def content_nodes(shape: str, amounts: dict[int, tuple[int, int]]) -> list[bool]:
    """Which nodes hold the article, from the characters and link characters of each.

    Surroundings known by name are left out, and so are slots outside of article elements that are mostly links. Of the
    rest the article elements are taken if they hold a third of the text; else the smallest element with four fifths of it.
    """
    labels, parents, kids = read_shape(shape)
    _, around, inside = _flags(shape, amounts)
    mass = [0] * len(labels)
    open_ = [not around[i] and (inside[i] or 2 * amounts.get(i, (0, 0))[1] <= amounts.get(i, (0, 0))[0]) for i in range(len(labels))]
    for i in range(len(labels) - 1, -1, -1):
        mass[i] += amounts.get(i, (0, 0))[0] if open_[i] else 0
        if parents[i] >= 0:
            mass[parents[i]] += mass[i]
    if 3 * sum(amounts.get(i, (0, 0))[0] for i in range(len(labels)) if open_[i] and inside[i]) >= mass[0] > 0:
        return [o and w for o, w in zip(open_, inside)]
    top = 0
    while heavy := [k for k in kids[top] if 5 * mass[k] >= 4 * mass[0] > 0]:
        top = heavy[0]
    if not kids[top] and parents[top] >= 0 and labels[top].split(".")[0] in ("p", "h1", "h2", "h3", "li", "blockquote", "pre"):
        top = parents[top]
    below = [False] * len(labels)
    for i in range(len(labels)):
        below[i] = i == top or parents[i] >= 0 and below[parents[i]]
    return [o and b for o, b in zip(open_, below)]


def _amounts(blocks: list[tuple[int, str, int]]) -> dict[int, tuple[int, int]]:
    out: dict[int, tuple[int, int]] = {}
    for at, text, link in blocks:
        chars, links = out.get(at, (0, 0))
        out[at] = chars + len(text), links + link
    return out


def wrapper(reference: str, amounts: dict[int, tuple[int, int]], constant: set[int]) -> list[int]:
    """The content nodes of a host's reference.

    Constant slots are template and left out, but never those in an article or main element, nor if they hold most of the text.
    """
    take, (_, _, inside) = content_nodes(reference, amounts), _flags(reference, amounts)
    wanted = [i for i, t in enumerate(take) if t]
    varying = [i for i in wanted if inside[i] or i not in constant]
    chars = lambda nodes: sum(amounts.get(i, (0, 0))[0] for i in nodes)
    return varying if 2 * chars(varying) >= chars(wanted) else wanted


def read_page(source: str, reference: str | None, wanted: list[int]) -> str:
    """The main text of a page by the wrapper of its host: the reference and its content nodes.

    A node without a partner goes with the nearest one above it that has one. A page on which the
    wrapper finds nothing is read by itself.
    """
    page = Page(source)
    blocks, chosen = page.numbered(), None
    if reference:
        partner, (named, _, _), (_, parents, _) = align(page.shape, reference), _flags(page.shape, _amounts(blocks)), read_shape(page.shape)
        good, take = set(wanted), []
        for i, other in enumerate(partner):
            take.append(other in good if other >= 0 else parents[i] >= 0 and take[parents[i]] and not named[i])
        chosen = [b for b in blocks if take[b[0]]]
    if not chosen:
        take = content_nodes(page.shape, _amounts(blocks))
        chosen = [b for b in blocks if take[b[0]]]
    return "\n".join(text for _, text, _ in chosen)


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


SLOTS = "array<struct<node:int,chars:long,links:long>>"


def _parsed(source: DataFrame) -> DataFrame:
    """By page: host, shape, (node, digest) of its blocks, and (node, characters, link characters) of its slots."""
    slot = pa.list_(pa.struct([("node", pa.int32()), ("chars", pa.int64()), ("links", pa.int64())]))
    block = pa.list_(pa.struct([("node", pa.int32()), ("digest", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, digests, slots = [], [], []
            for text in batch.column("html"):
                page = Page(text.as_py())
                blocks = page.numbered()
                shapes.append(page.shape)
                digests.append([{"node": n, "digest": d} for n, d in sorted({(n, _digest(t)) for n, t, _ in blocks})])
                slots.append([{"node": n, "chars": c, "links": k} for n, (c, k) in _amounts(blocks).items()])
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(shapes, pa.string()), pa.array(digests, block), pa.array(slots, slot)], ["host", "shape", "digests", "slots"])

    return source.select("host", "html").mapInArrow(run, f"host string, shape string, digests array<struct<node:int,digest:long>>, slots {SLOTS}")


def wrappers(source: DataFrame) -> DataFrame:
    """(host, html) to ``host``, ``reference`` and ``wanted`` (its content nodes)."""
    parsed = materialize(_parsed(source), "pages")
    shapes = parsed.groupBy("host", "shape").agg(F.count("*").alias("pages"))
    hosts = shapes.groupBy("host").agg(F.min_by("shape", F.struct(-F.col("pages"), F.col("shape"))).alias("reference"), F.sum("pages").alias("all"))
    hosts = materialize(hosts, "hosts")
    each = parsed.select("host", F.explode(F.array_distinct(F.transform("digests", lambda d: d["digest"]))).alias("digest"))
    counts = each.groupBy("host", "digest").agg(F.count("*").alias("n"))
    common = counts.join(hosts, "host").where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= F.col("all") * TEMPLATE_SHARE)).select("host", "digest", F.lit(True).alias("common"))
    # Which slots of a shape hold other blocks than common ones.
    held = parsed.select("host", "shape", F.explode("digests").alias("b")).groupBy("host", "shape", "b.node", "b.digest").agg(F.lit(1).alias("one"))
    varying = held.join(materialize(common, "common"), ["host", "digest"], "left").groupBy("host", "shape", "node").agg(F.max(F.col("common").isNull()).alias("varies"))
    slots = parsed.select("host", "shape", F.explode("slots").alias("s")).groupBy("host", "shape", "s.node").agg(F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"))
    slots = slots.join(varying, ["host", "shape", "node"]).groupBy("host", "shape").agg(F.collect_list(F.struct("node", "chars", "links", "varies")).alias("slots")).join(hosts, "host")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, shape, reference, held in zip(*(batch.column(c).to_pylist() for c in ("host", "shape", "reference", "slots"))):
                partner = align(shape, reference)
                rows += [(host, partner[s["node"]], s["chars"], s["links"], s["varies"]) for s in held if partner[s["node"]] >= 0]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["host", "node", "chars", "links", "varies"])

    met = slots.select("host", "shape", "reference", "slots").mapInArrow(aligned, "host string, node int, chars long, links long, varies boolean")
    sums = met.groupBy("host", "node").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max("varies").alias("varies"))
    gathered = hosts.join(sums.groupBy("host").agg(F.collect_list(F.struct("node", "chars", "links", "varies")).alias("slots")), "host", "left")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = []
            for reference, held in zip(batch.column("reference").to_pylist(), batch.column("slots").to_pylist()):
                amounts = {s["node"]: (s["chars"], s["links"]) for s in held or ()}
                wanted.append(wrapper(reference, amounts, {s["node"] for s in held or () if not s["varies"]}))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("reference"), pa.array(wanted, pa.list_(pa.int32()))], ["host", "reference", "wanted"])

    return materialize(gathered.select("host", "reference", "slots").mapInArrow(decide, "host string, reference string, wanted array<int>"), "wrappers")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``key``, ``url`` and ``text``: blocks in page order joined by a line break, empty where there are none.

    A null or empty page has an empty text. Pages without a host in their address form one group. One row
    for each row. Other columns are not carried. Wrappers are a row for each host, joined by it without a hint.
    """
    page = pages.select(column(key).alias("key"), column(url).cast("string").alias("url"), host_of(column(url).cast("string")).alias("host"), F.coalesce(column(source), F.lit("")).alias("html"))
    read = page.join(wrappers(page.select("host", "html")), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                read_page(h.as_py(), r.as_py(), w.as_py() or [])
                for h, r, w in zip(*(batch.column(c) for c in ("html", "reference", "wanted")))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], [key, "url", "text"])

    return read.select("key", "url", "html", "reference", "wanted").mapInArrow(run, f"`{key}` {page.schema['key'].dataType.simpleString()}, url string, text string")
