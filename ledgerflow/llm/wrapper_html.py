"""Operator 9: main text of web pages by wrapper induction.

Pages of one host share a wrapper.  Each page is parsed into a DOM tree, and a
compact copy of it (runs of equal sibling blocks folded, texts as hashes and
lengths) is aligned with the host's reference page by simple tree matching, the
dynamic programme that finds the largest order-preserving match of two trees.
Subtrees of equal shape match node by node, children are first paired from both
ends, and what is left takes a programme of linear memory per pair of shapes.
Over all pages of the host, a reference node whose text is the same on most of
them is *template*; the others are *slots*.  The content slot is found from the
body downwards: into the container that holds most of the varying text, never
into one that is a menu, header, footer, sidebar, notice, advert, form or
comment list by its tag, role or class, and never below an article element.

A page's text is what its node aligned with the content slot holds: all articles
and sections of it, without such parts and, outside an article, without template
nodes.  Where alignment found no slot, it is the first article or main element,
else the body.  Inside an article nothing is dropped for being common: a line
shared by many articles stays.

Statistics are counted per (host, reference node) with partial aggregation, so a
host with a third of all pages costs each task one row per node.  Pages travel
compressed, and only if the wrappers are too large for a broadcast join.

Cases: null or empty html, or a page without content, gives the empty text.
Pages without a parsable host form one host.  Broken markup: an unclosed
element ends with its parent, a stray end tag is skipped, a cut-off page ends
where it ends.  Very deep and very long pages are taken whole: trees lie in
arrays and are walked with stacks, without a limit on depth, nodes or bytes.
Repeated rows are extracted row by row.  Extra columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import pickle
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

#: A reference node is template if its text is the same on this share of the host's pages, of at least MIN_PAGES.
CONSTANT_SHARE, MIN_PAGES = 0.6, 4
#: Part of a node's varying text that a child must hold to become the content slot instead.
MAIN_SHARE = 0.7

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td
tfoot th thead title tr ul""".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset({"article", "main"})
#: Kinds whose id is the anchor of a text.
ANCHORED = HEADING | {"p", "section"}
CONTAINER = frozenset("article body center div main section table tbody td tr".split())
#: A start tag ends an open element of these kinds first (up to the named borders).
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"})}
DROP_TAGS = frozenset("""head script style noscript template iframe svg nav aside footer form button select option input textarea
menu dialog object embed canvas audio video label title""".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROP_WORDS = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts
advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay
newsletter subscribe subscription signup login share sharing social comment comments reply replies disqus respond related recommended
widget toolbar pagination pager copyright disclaimer form search""".split())
#: Words that only say how a part is laid out.
FRAME_WORDS = frozenset("""area bar block body bottom box button buttons card cards container content icon icons inner item items left link
links list outer panel posts right section slot top unit wrap wrapper""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "article", "drop", "junk", "order")

    def __init__(self, tag: str, attributes: str = "", article: bool = False):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        named = tag not in DROP_TAGS and bool(attributes.strip())
        loose = tag in DROP_TAGS or named and _unwanted(attributes)
        #: ``junk``: judged as part of the content; ``drop``: judged by its place, of which an article is always content.
        self.junk = loose and (not named or _unwanted(attributes, tag))
        self.article = article or tag in ARTICLE
        self.drop = self.junk if self.article else loose
        self.order = -1


def _unwanted(attributes: str, within: str | None = None) -> bool:
    """Is an element with these attributes a menu, notice, advert and so on, or hidden?

    Outside content any word of a class or id tells.  Of an element of kind ``within``
    inside content, a whole class or id must say it (class="ad", "related-posts", but not
    id="related-work"), and headings, paragraphs and sections are not judged by their id.
    """
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "class" or name == "id" and within not in ANCHORED:
            for part in value.split():
                said = {w.lower() for w in _WORDS.findall(part)}
                if said & DROP_WORDS and (within is None or said <= DROP_WORDS | FRAME_WORDS):
                    return True
        elif name == "role":
            if value.lower() in DROP_ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def parse(source: str) -> Node:
    """DOM tree of a page."""
    root = Node("html")
    stack = [root]
    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.match(source, at)
        at = m.end()
        end, start = m.group(1), m.group(2)
        if start is not None:
            tag = start.lower()
            if tag == "html":
                continue
            if tag in BLOCK:
                _close(stack, {"p"}, {"td", "th", "article", "section", "div", "body", "table", "button"})
            if tag in ENDS:
                _close(stack, *ENDS[tag])
            node = Node(tag, m.group(3) or "", article=stack[-1].article)
            stack[-1].children.append(node)
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                node.children.append(source[at:close.start() if close else size])
                at = close.end() if close else size
            elif tag not in VOID and not (m.group(3) or "").endswith("/"):
                stack.append(node)
        elif end is not None:
            _close(stack, {end.lower()}, frozenset(), outermost=end.lower() in BLOCK)
        elif not m.group().startswith(("<!", "<?")):
            stack[-1].children.append(m.group())
    return root


def _close(stack: list[Node], tags: set[str], borders: set[str] | frozenset[str], outermost: bool = True) -> None:
    """End the innermost open element of ``tags``; inline end tags do not reach across blocks."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in borders or not outermost and stack[i].tag in BLOCK:
            return


# -- compact trees and their alignment -------------------------------------------------------------------------------

class Tree(NamedTuple):
    """Block elements in document order, one entry a node; ``size``: the nodes of its subtree, which follow each other."""

    label: list[str]
    box: list[bool]
    drop: list[bool]
    digest: list[int]
    length: list[int]
    size: list[int]

    def children(self, number: int) -> Iterator[int]:
        at, end = number + 1, number + self.size[number]
        while at < end:
            yield at
            at += self.size[at]


def compact(root: Node) -> Tree:
    """The tree of block elements, numbered in document order; neighbouring leaf blocks of one kind are one node."""
    tree = Tree([], [], [], [], [], [])
    frames: list[tuple[Node, list[Iterator[Node | str]], list[str], list[int]]] = []
    runs: list[str | None] = []  # kind of the leaf block before, for each open element

    def enter(node: Node) -> None:
        node.order = len(tree.label)
        tree.label.append(node.tag if node.tag not in ("div", "section", "td") else f"{node.tag}{re.sub(r'[0-9]+', '', node.attributes)}")
        tree.box.append(node.tag in CONTAINER)
        tree.drop.append(node.drop)
        for column in (tree.digest, tree.length, tree.size):
            column.append(0)
        frames.append((node, [iter(node.children if node.tag not in RAW else ())], [], []))
        runs.append(None)

    def leave(node: Node, text: list[str], inside: list[int]) -> None:
        at = node.order
        own = _SPACE.sub(" ", "".join(text)).strip()
        tree.digest[at] = hash_text("|".join([own, *(str(tree.digest[c]) for c in inside)])) if inside else hash_text(own)
        tree.length[at] = len(own) + sum(tree.length[c] for c in inside)
        tree.size[at] = len(tree.label) - at
        if not frames:
            return
        siblings = frames[-1][3]
        if inside or runs[-1] != node.tag:
            siblings.append(at)
            runs[-1] = None if inside else node.tag
        else:
            node.order = first = siblings[-1]
            digest, length = tree.digest[at], tree.length[at]
            for column in tree:
                column.pop()
            tree.digest[first] = hash_text(f"{tree.digest[first]}|{digest}")
            tree.length[first] += length

    enter(root)
    while frames:
        node, within, text, inside = frames[-1]
        for c in within[-1]:
            if isinstance(c, str):
                text.append(c)
            elif c.tag in BLOCK:
                enter(c)
                break
            elif c.tag not in RAW:
                within.append(iter(c.children))
                break
        else:
            within.pop()
            if not within:
                frames.pop()
                runs.pop()
                leave(node, text, inside)
    return tree


def hash_text(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()) >> 1 if text else 0


def _shapes(tree: Tree, known: dict[tuple, int]) -> list[int]:
    """A number for each node's subtree, equal for subtrees of equal labels throughout."""
    out = [0] * len(tree.label)
    for at in range(len(out) - 1, -1, -1):
        out[at] = known.setdefault((tree.label[at], *(out[c] for c in tree.children(at))), len(known))
    return out


def _last_line(gains: Iterable[np.ndarray], width: int) -> np.ndarray:
    """Best totals of order-preserving matches of all rows with the first 0, 1, ... columns."""
    line = np.zeros(width + 1, np.int64)
    for gain in gains:
        line[1:] = np.maximum.accumulate(np.maximum(line[1:], line[:-1] + gain))
    return line


def align(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Simple tree matching: the largest order-preserving match, as pairs of document-order numbers of the two trees.

    Children of equal shape at the front or back of two lists are in some largest
    match of the lists (whatever else either is matched with gains no more), so
    only the children between them need the dynamic programme.
    """
    if a.label[0] != b.label[0]:
        return []
    numbers: dict[tuple, int] = {}
    of_a, of_b = _shapes(a, numbers), _shapes(b, numbers)
    worth: dict[tuple[int, int], int] = {}

    def between(i: int, j: int) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        """Pairs of equal children at both ends, the children between them."""
        x, y = list(a.children(i)), list(b.children(j))
        shorter = min(len(x), len(y))
        head = next((k for k in range(shorter) if of_a[x[k]] != of_b[y[k]]), shorter)
        tail = next((k for k in range(shorter - head) if of_a[x[-1 - k]] != of_b[y[-1 - k]]), shorter - head)
        ends = [*zip(x[:head], y[:head]), *zip(x[len(x) - tail:], y[len(y) - tail:])]
        return ends, x[head:len(x) - tail], y[head:len(y) - tail]

    def gain(c: int, d: int) -> int:
        if a.label[c] != b.label[d]:
            return 0
        return a.size[c] if of_a[c] == of_b[d] else worth[of_a[c], of_b[d]]

    def gains(x: list[int], y: list[int]) -> dict[int, np.ndarray]:
        """What a child of each shape in ``x`` gains with each of ``y``."""
        first, place = np.unique([of_b[d] for d in y], return_index=True, return_inverse=True)[1:]
        return {shape: np.array([gain(c, y[k]) for k in first], np.int64)[place] for shape, c in {of_a[c]: c for c in x}.items()}

    def best(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """The match of two lists of children, by halves: memory grows with their lengths, not their product."""
        if not x or not y:
            return []
        table, out = gains(x, y), []
        todo = [(0, len(x), 0, len(y))]
        while todo:
            low, high, left, right = todo.pop()
            if low == high or left == right:
                continue
            if high - low == 1:
                row = table[of_a[x[low]]][left:right]
                k = int(row.argmax())
                if row[k]:
                    out.append((x[low], y[left + k]))
                continue
            middle = (low + high) // 2
            before = _last_line((table[of_a[c]][left:right] for c in x[low:middle]), right - left)
            after = _last_line((table[of_a[c]][left:right][::-1] for c in reversed(x[middle:high])), right - left)[::-1]
            split = left + int((before + after).argmax())
            todo += [(low, middle, left, split), (middle, high, split, right)]
        return out

    todo = [(0, 0)]
    while todo:  # worth of pairs of shapes, inner ones first
        i, j = todo[-1]
        if of_a[i] == of_b[j] or (of_a[i], of_b[j]) in worth:
            todo.pop()
            continue
        ends, x, y = between(i, j)
        kinds = [{s: n for n in side for s in (of[n],)}.items() for side, of in ((x, of_a), (y, of_b))]
        missing = [(c, d) for s, c in kinds[0] for t, d in kinds[1] if s != t and a.label[c] == b.label[d] and (s, t) not in worth]
        if missing:
            todo += missing
            continue
        todo.pop()
        inner = 0
        if x and y:
            table = gains(x, y)
            inner = int(_last_line((table[of_a[c]] for c in x), len(y))[-1])
        worth[of_a[i], of_b[j]] = 1 + inner + sum(a.size[c] for c, _ in ends)
    pairs: list[tuple[int, int]] = []
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if of_a[i] == of_b[j]:
            pairs += zip(range(i, i + a.size[i]), range(j, j + b.size[j]))
            continue
        pairs.append((i, j))
        ends, x, y = between(i, j)
        todo += ends
        todo += best(x, y)
    return pairs


def content_slot(reference: Tree, varying: dict[int, int]) -> int:
    """Number of the reference node that holds the content; ``varying``: characters of varying text by node."""
    def mass(number: int) -> int:
        return 0 if reference.drop[number] else varying.get(number, 0)

    label, number = reference.label, 0
    while label[number] != "article" and not label[number].startswith("main"):
        total = sum(map(mass, reference.children(number)))
        inside = [(mass(c), c) for c in reference.children(number) if reference.box[c] or label[c] in ("body", "html")]
        best = max(inside, key=lambda x: x[0], default=None)
        named = [x for x in inside if label[x[1]] in ("article", "main")]
        if best is None or best[0] < MAIN_SHARE * max(1, total) and not (label[number] == "html" and label[best[1]] == "body"):
            if len(named) == 1 and named[0][0] > 0:
                best = named[0]
            else:
                break
        number = best[1]
    return number


# -- extraction ------------------------------------------------------------------------------------------------------

def blocks(node: Node, skip: set[int]) -> list[str]:
    """Text blocks under a node in page order; ``skip``: numbers of template nodes, which stay inside an article or main element."""
    content = node.tag not in ("body", "html")
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip(" ")
        run.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node, Iterator[Node | str], bool, bool]] = []

    def enter(n: Node, headings_only: bool, article: bool) -> None:
        if n.tag in BLOCK:
            flush()
        stack.append((n, iter(n.children), headings_only, article or n.tag in ARTICLE))

    enter(node, False, False)
    while stack:
        n, rest, headings_only, article = stack[-1]
        for c in rest:
            if isinstance(c, str):
                if not headings_only or n.tag in HEADING:
                    run.append(c)
            elif c.tag == "br":
                run.append(" ")
            elif c.tag == "header" or (drop := c.junk if content else c.drop) and c.tag not in DROP_TAGS and re.search(r"\bheader\b", c.attributes, re.I):
                enter(c, True, article)  # an article's own header: its headings
                break
            elif not drop and (article or c.order < 0 or c.order not in skip):
                enter(c, headings_only and c.tag not in HEADING, article)
                break
        else:
            stack.pop()
            if n.tag in BLOCK:
                flush()
    flush()
    return out


def _find(node: Node, test) -> list[Node]:
    """The outermost nodes of the kind, in page order."""
    found: list[Node] = []
    stack = [node]
    while stack:
        n = stack.pop()
        if test(n):
            found.append(n)
        else:
            stack += [c for c in reversed(n.children) if isinstance(c, Node) and not c.drop]
    return found


def extract(source: str | None, wrapper: tuple[Tree, int, frozenset[int]] | None) -> str:
    """Main text of a page; ``wrapper``: reference tree, number of the content slot, numbers of template nodes."""
    if not source:
        return ""
    root = parse(source)
    tree = compact(root)
    place: dict[int, int] = {}
    if wrapper is not None:
        place = dict(align(tree, wrapper[0]))
    slot = next((n for n, r in place.items() if wrapper is not None and r == wrapper[1] and r), None)
    nodes = _find(root, lambda n: n.order == slot and n.tag in CONTAINER) if slot is not None else []  # several if a run was folded
    if not nodes:
        nodes = _find(root, lambda n: n.tag == "article") or _find(root, lambda n: n.tag == "main" or 'role="main"' in n.attributes) or _find(root, lambda n: n.tag == "body") or [root]
        nodes = nodes[:1]
    skip = {n for n, r in place.items() if r in wrapper[2]} if wrapper is not None else set()
    return "\n".join(b for node in nodes for b in blocks(node, skip))


# -- Spark -----------------------------------------------------------------------------------------------------------

def host_of(url: str = "url") -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))


def induce(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, wrapper): one wrapper per host from all of its pages, written."""
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pickle.dumps(compact(parse(h)), 5) if h else None for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["host", "tree"])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, tree, reference in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = pickle.loads(tree), pickle.loads(reference)
                out += [(host, r, int(a.digest[n] == b.digest[r]), a.length[n]) for n, r in align(a, b)]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["host", "node", "same", "chars"])

    def wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for reference, pages_seen, nodes in zip(*(batch.column(c).to_pylist() for c in ("reference", "pages", "nodes"))):
                tree = pickle.loads(reference)
                share = {n["node"]: n["same"] / pages_seen for n in nodes}
                constant = {n for n, s in share.items() if n and s >= CONSTANT_SHARE and pages_seen >= MIN_PAGES}
                varying = {n["node"]: n["chars"] for n in nodes if n["node"] not in constant}
                packed.append(pickle.dumps((tree, content_slot(tree, varying), frozenset(constant)), 5))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(packed, pa.binary())], names=["host", "wrapper"])

    compacted = core.write_stage(pages.select(host_of(url).alias("host"), source).mapInArrow(trees, "host string, tree binary").where("tree is not null"), "page-trees")
    references = core.write_stage(compacted.groupBy("host").agg(F.min("tree").alias("reference"), F.count("*").alias("pages")), "page-references")
    matched = compacted.join(references, "host").select("host", "tree", "reference").mapInArrow(counts, "host string, node int, same long, chars long")
    nodes = matched.groupBy("host", "node").agg(F.sum("same").alias("same"), F.sum("chars").alias("chars"))
    nodes = nodes.groupBy("host").agg(F.collect_list(F.struct("node", "same", "chars")).alias("nodes"))  # nodes of one reference page
    return core.write_stage(references.join(nodes, "host").mapInArrow(wrappers, "host string, wrapper binary"), "page-wrappers")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    wrappers = induce(pages, url, source)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            body = pa.array([squeeze.compress(h.encode()) if h else None for h in batch.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), body], names=["page_id", "url", "host", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        known: dict[bytes, tuple] = {}
        for batch in batches:
            texts = []
            for body, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if wrapper is not None and wrapper not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[wrapper] = pickle.loads(wrapper)
                texts.append(extract(unpack.decompress(body).decode() if body else None, known.get(wrapper)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    packed = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), F.col(source).alias("html")).mapInArrow(pack, "page_id long, url string, host string, body binary")
    joined = packed.join(wrappers, "host", "left").select("page_id", "url", "body", "wrapper")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_wrapper_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(core.read(spark, sf_dir, "pages"))
