"""Main texts of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.session import stored

START = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*)([^<>"']*)(>?)|[!?/])""")
BODY = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var".split()
)

# Elements that an opening tag ends where it stands directly in one of the same kind.
CLOSED_BY = {t: frozenset((t,)) for t in ("li", "option", "tr", "p")}
CLOSED_BY |= {t: frozenset(("td", "th")) for t in ("td", "th")}
CLOSED_BY |= {t: frozenset(("dt", "dd")) for t in ("dt", "dd")}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)

# Elements, roles and words in classes and ids that mark what is not the article.
BOILERPLATE = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe svg "
    "object canvas dialog menu".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
HINTS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promotion recommended related respond replies share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
# Words that a class or id may have beside those and still mark the same.
NEUTRAL = frozenset(
    "area articles bar block body bottom box btn button buttons card container content form group heading icons "
    "inner item items label left link links list main message news note outer panel post posts primary right row "
    "secondary section site slot stories story text thread title top unit wrap wrapper zone".split()
)
# First words of a class that says what a page has around it, not what the element is.
ABOUT = frozenset("has no with without".split())
ARTICLE = frozenset(("article", "main"))
HEADER_WORDS = frozenset(("header",))

# A text is part of the template where it stands at the same node in this share of a host's
# pages, and in so many at least.
TEMPLATE_SHARE = 0.8
TEMPLATE_PAGES = 5

# Less than this share of a page's text, and its varying texts alone are no article.
VARYING_SHARE = 0.05

# Share of letters in links that makes a block outside an article, or a slot, a list of links.
LINK_SHARE = 0.5

# Layouts that one task aligns, and the nodes of a merged tree that are kept, heaviest first.
FAN_IN = 64
TEMPLATE_NODES = 16_384

# Children of a node told apart in a layout; the fewer, the larger a layout would be otherwise.
WIDTHS = (64, 16, 4, 1)
LAYOUT_NODES = 4_096

# Hosts, and layouts of a host, that a task keeps at hand.
KNOWN = 256


@dataclass(frozen=True)
class Standing:
    """What the labels from the root down say of a node.

    ``out`` tells whether it is no part of the article: by all marks, by those that an article
    around it does not overrule, and by tags and roles alone. ``hinted`` says that a class in
    the article, or one of a page without article, has a word of the list among others.
    """

    article: bool = False
    out: tuple[bool, bool, bool] = (False, False, False)
    hinted: bool = False


@dataclass
class Node:
    """An element that is no inline one; its label is its tag with class, id and role words."""

    label: str
    standing: Standing
    children: list[Node] = field(default_factory=list)


@dataclass
class Block:
    """A stretch of text without a block's edge in it, under the node that holds it."""

    node: Node
    text: str
    linked: int


def label_of(tag: str, attributes: str) -> str:
    found = []
    if attributes:
        for match in ATTRIBUTE.finditer(attributes):
            value = (match[2] or match[3] or match[4] or "").lower()
            if match[1].lower() == "role":
                found += [f"@{w}" for w in TOKEN.findall(value)]
            else:
                found += [f".{'-'.join(w)}" for w in map(TOKEN.findall, value.split()) if w]
    return tag + "".join(sorted(set(found)))


def marks(name: str, words: frozenset[str]) -> bool:
    """Whether a whole class or id says one of the words, and nothing but neutral words beside."""
    parts = set(name.split("-"))
    return bool(parts & words) and parts <= words | NEUTRAL


def hints(name: str) -> bool:
    """Whether a class or id has a word of the list at all."""
    parts = name.split("-")
    return parts[0] not in ABOUT and not HINTS.isdisjoint(parts)


def below(above: Standing, label: str) -> Standing:
    """The standing of a node with this label under one of the given standing."""
    tag = re.match(r"[^.@]*", label)[0]
    names = re.findall(r"\.([a-z-]+)", label)
    roles = set(re.findall(r"@([a-z]+)", label))
    if tag in BOILERPLATE or roles & ROLES or tag == "header" and not above.article:
        return replace(above, out=(True, True, True))
    if tag in ARTICLE or roles & ARTICLE:
        return Standing(True, above.out, above.article and above.hinted)
    if tag in ("html", "body"):
        return above
    every, inner, bare = above.out
    if any(marks(n, HINTS) or not above.article and marks(n, HEADER_WORDS) for n in names):
        every, inner = True, inner or above.article
    return Standing(above.article, (every, inner, bare), above.hinted or any(map(hints, names)))


def tokens(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of all tags, comments and declarations of a page.

    The tag is empty for the latter two. Where quotes leave a tag without an end, it and all
    later ones of the page end at the next ``>``; what has none behind it is text. Every
    character is looked at a fixed number of times.
    """
    at, quoted = 0, True
    while match := START.search(text, at):
        start = match.start()
        slash, tag, attributes, closed = match.groups()
        if closed:
            at = match.end()
            yield start, at, slash, tag.lower(), attributes
            continue
        if text.startswith("<!--", start):
            end = text.find("-->", start + 4)
            at = len(text) if end < 0 else end + 3
            yield start, at, "", "", ""
            continue
        stop = text.find(">", match.end())
        if stop < 0:
            return
        if tag and quoted:
            end = BODY.match(text, match.end()).end()
            quoted = end < len(text) and text[end] == ">"
            stop = end if quoted else stop
        at = stop + 1
        yield start, at, slash or "", (tag or "").lower(), text[match.end(2) : stop] if tag else ""


def parsed(html: str | None) -> tuple[Node, list[Block]]:
    """The tree of a page and its texts in order, with character references decoded.

    Elements that HTML closes by itself are closed; a closing tag that fits no open element is
    left out; what is open at the end is closed there. A link left open ends with the element
    that it began in.
    """
    text = html or ""
    root = Node("", Standing())
    stack: list[tuple[str, Node]] = [("", root)]
    open_tags: Counter[str] = Counter()
    blocks: list[Block] = []
    pieces: list[str] = []
    standings: dict[tuple[int, str], Standing] = {}
    linked = link = at = 0

    def add(piece: str) -> None:
        nonlocal linked
        pieces.append(piece)
        if link:
            linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if pieces:
            words = " ".join(entities.unescape("".join(pieces)).split())
            if words:
                blocks.append(Block(stack[-1][1], words, linked))
            pieces.clear()
        linked = 0

    def close(until: int) -> None:
        nonlocal link
        flush()
        for tag, _ in stack[until:]:
            open_tags[tag] -= 1
        del stack[until:]
        if until < link:
            link = 0

    for start, end, slash, tag, attributes in tokens(text):
        if start < at:
            # Inside a script, a style or the like.
            continue
        if start > at:
            add(text[at:start])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if slash else len(stack)
            continue
        if tag in ("br", "wbr"):
            pieces.append(" " if tag == "br" else "")
            continue
        if slash:
            if open_tags[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            elif tag == "p":
                flush()
            continue
        flush()
        ended = CLOSED_BY.get(tag)
        if ended and stack[-1][0] in ended or tag in ENDS_P and stack[-1][0] == "p":
            close(len(stack) - 1)
        label, above = label_of(tag, attributes), stack[-1][1]
        # Nodes share their standings, which live as long as the page.
        key = (id(above.standing), label)
        if key not in standings:
            standings[key] = below(above.standing, label)
        node = Node(label, standings[key])
        above.children.append(node)
        if tag in RAW:
            ending = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            stop = ending.start() if ending else len(text)
            if tag in ("title", "textarea") and (body := " ".join(entities.unescape(text[at:stop]).split())):
                blocks.append(Block(node, body, 0))
            at = ending.end() if ending else len(text)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, node))
            open_tags[tag] += 1
    if at < len(text):
        add(text[at:])
    flush()
    return root, blocks


class Tree:
    """Labelled nodes in the order of a page, each with its parent's number and a weight."""

    def __init__(self) -> None:
        self.labels: list[str] = []
        self.parents: list[int] = []
        self.weights: list[int] = []
        self.children: list[list[int]] = []

    def add(self, label: str, parent: int, weight: int = 1) -> int:
        number = len(self.labels)
        self.labels.append(label)
        self.parents.append(parent)
        self.weights.append(weight)
        self.children.append([])
        if parent >= 0:
            self.children[parent].append(number)
        return number

    def text(self) -> str:
        return json.dumps([self.labels, self.parents, self.weights])

    @classmethod
    def of(cls, text: str, weight: int | None = None) -> Tree:
        tree = cls()
        for label, parent, n in zip(*json.loads(text), strict=True):
            tree.add(label, parent, n if weight is None else weight)
        return tree

    def pruned(self, most: int) -> Tree:
        """The heaviest nodes. No node is heavier than its parent, so these are a tree, too."""
        if len(self.labels) <= most:
            return self
        order = sorted(range(len(self.labels)), key=lambda k: (-self.weights[k], k))[:most]
        tree, named = Tree(), {-1: -1}
        for k in sorted(order):
            named[k] = tree.add(self.labels[k], named[self.parents[k]], self.weights[k])
        return tree


def grouped(nodes: list[Node], width: int) -> list[tuple[str, list[Node]]]:
    """Nodes of one parent as up to ``width`` labelled groups.

    Neighbours with the same label are a group. Where that gives too many, all with the same
    label are one, else all with the same tag, else all nodes.
    """
    groups: list[tuple[str, list[Node]]] = []
    for node in nodes:
        if groups and groups[-1][0] == node.label:
            groups[-1][1].append(node)
        else:
            groups.append((node.label, [node]))
    for name in (lambda x: x, lambda x: re.match(r"[^.@]*", x)[0], lambda x: "*"):
        if len(groups) <= width:
            break
        whole: dict[str, list[Node]] = {}
        for label, members in groups:
            whole.setdefault(name(label), []).extend(members)
        groups = list(whole.items())
    return groups


def folded(root: Node) -> tuple[Tree, dict[int, int]]:
    """The layout of a page and, by the identity of its nodes, their numbers in it.

    Repeated nodes are one with the children of all. Pages with more than ``LAYOUT_NODES``
    unlike nodes get a coarser layout, so that matching stays cheap.
    """
    for width in WIDTHS:
        tree = Tree()
        places: dict[int, int] = {}
        waiting = [(root.label, [root], -1)]
        while waiting and (len(tree.labels) <= LAYOUT_NODES or width == WIDTHS[-1]):
            label, nodes, parent = waiting.pop()
            number = tree.add(label, parent)
            for node in nodes:
                places[id(node)] = number
            groups = grouped([c for node in nodes for c in node.children], width)
            waiting += [(name, members, number) for name, members in reversed(groups)]
        if not waiting:
            break
    return tree, places


class Matching:
    """Simple tree matching: the most nodes of two trees that match in order, and which.

    Roots must have the same label. Children are matched by dynamic programming; equal
    subtrees at either end of two lists of children always match in a best way, so these
    are left out of it.
    """

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b = a, b
        names: dict[tuple, int] = {}
        self.same = [self._names(t, names) for t in (a, b)]
        self.sizes = [1] * len(a.labels)
        for k in range(len(a.labels) - 1, 0, -1):
            self.sizes[a.parents[k]] += self.sizes[k]
        self.gains: dict[tuple[int, int], int] = {}
        if a.labels[0] == b.labels[0]:
            self._weigh()

    @staticmethod
    def _names(tree: Tree, names: dict[tuple, int]) -> list[int]:
        found = [0] * len(tree.labels)
        for k in range(len(tree.labels) - 1, -1, -1):
            key = (tree.labels[k], *(found[c] for c in tree.children[k]))
            found[k] = names.setdefault(key, len(names))
        return found

    def _ends(self, i: int, j: int) -> tuple[list[int], list[int], int, int]:
        left, right = self.a.children[i], self.b.children[j]
        same = [self.same[0][x] for x in left], [self.same[1][y] for y in right]
        least = min(len(left), len(right))
        head = next((k for k in range(least) if same[0][k] != same[1][k]), least)
        tail = next((k for k in range(least - head) if same[0][-1 - k] != same[1][-1 - k]), least - head)
        return left, right, head, tail

    def _table(self, left: list[int], right: list[int]) -> list[list[int]]:
        best = [[0] * (len(right) + 1)]
        for x in left:
            row = [0]
            for j, y in enumerate(right):
                row.append(max(best[-1][j + 1], row[-1], best[-1][j] + self.gains.get((x, y), 0)))
            best.append(row)
        return best

    def _weigh(self) -> None:
        order = [(0, 0)]
        for i, j in order:
            if self.same[0][i] != self.same[1][j]:
                left, right, head, tail = self._ends(i, j)
                by_label: dict[str, list[int]] = {}
                for y in right[head : len(right) - tail]:
                    by_label.setdefault(self.b.labels[y], []).append(y)
                for x in left[head : len(left) - tail]:
                    order += [(x, y) for y in by_label.get(self.a.labels[x], ())]
        for i, j in reversed(order):
            if self.same[0][i] == self.same[1][j]:
                self.gains[i, j] = self.sizes[i]
                continue
            left, right, head, tail = self._ends(i, j)
            ends = sum(self.sizes[x] for x in left[:head] + left[len(left) - tail :])
            middle = self._table(left[head : len(left) - tail], right[head : len(right) - tail])
            self.gains[i, j] = 1 + ends + middle[-1][-1]

    @property
    def size(self) -> int:
        return self.gains.get((0, 0), 0)

    def pairs(self, i: int, j: int) -> list[tuple[int, int]]:
        """The matching children of two nodes that match."""
        left, right, head, tail = self._ends(i, j)
        ends = list(zip(left[:head], right[:head], strict=True))
        tails = list(zip(left[len(left) - tail :], right[len(right) - tail :], strict=True))
        left, right = left[head : len(left) - tail], right[head : len(right) - tail]
        best, found = self._table(left, right), []
        m, n = len(left), len(right)
        while m and n:
            gain = self.gains.get((left[m - 1], right[n - 1]), 0)
            if gain and best[m][n] == best[m - 1][n - 1] + gain:
                m, n = m - 1, n - 1
                found.append((left[m], right[n]))
            elif best[m][n] == best[m - 1][n]:
                m -= 1
            else:
                n -= 1
        return ends + found[::-1] + tails


def merged(template: Tree, layout: Tree) -> Tree:
    """A template with the nodes of a layout that it does not have put between its own."""
    matching = Matching(template, layout)
    tree = Tree()
    waiting = [(0, 0 if matching.size else -1, -1)]
    while waiting:
        i, j, parent = waiting.pop()
        weight = (template.weights[i] if i >= 0 else 0) + (layout.weights[j] if j >= 0 else 0)
        number = tree.add(template.labels[i] if i >= 0 else layout.labels[j], parent, weight)
        left = template.children[i] if i >= 0 else []
        right = layout.children[j] if j >= 0 else []
        pairs = matching.pairs(i, j) if i >= 0 and j >= 0 else []
        spot_a = {x: k for k, x in enumerate(left)}
        spot_b = {y: k for k, y in enumerate(right)}
        children: list[tuple[int, int]] = []
        done = taken = 0
        for x, y in pairs:
            children += [(k, -1) for k in left[done : spot_a[x]]] + [(-1, k) for k in right[taken : spot_b[y]]]
            children.append((x, y))
            done, taken = spot_a[x] + 1, spot_b[y] + 1
        children += [(k, -1) for k in left[done:]] + [(-1, k) for k in right[taken:]]
        waiting += [(x, y, number) for x, y in reversed(children)]
    return tree


def aligned(template: Tree, layout: Tree) -> dict[int, int]:
    """The number in the template of every node of a layout that matches."""
    matching = Matching(template, layout)
    found: dict[int, int] = {}
    waiting = [(0, 0)] if matching.size else []
    while waiting:
        i, j = waiting.pop()
        found[j] = i
        waiting += matching.pairs(i, j)
    return found


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Page:
    """A page with its layout, its texts and their places in it."""

    def __init__(self, html: str | None):
        root, self.blocks = parsed(html)
        self.layout, places = folded(root)
        self.places = [places[id(b.node)] for b in self.blocks]


class Aligner:
    """Places of pages in one template; a layout met before is not matched again."""

    def __init__(self, template: str):
        self.template = Tree.of(template)
        self.known: dict[str, dict[int, int]] = {}

    def places(self, page: Page) -> list[int | None]:
        name = page.layout.text()
        if name not in self.known:
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[name] = aligned(self.template, page.layout)
        return [self.known[name].get(p) for p in page.places]


def main_text(page: Page, places: list[int | None], fixed: set[tuple[int, int]], lists: set[int]) -> str:
    """The texts of the article in order.

    ``fixed`` holds (place, hash) of texts that a host's pages share, ``lists`` the places that
    are lists of links on them. Where a page has an article, it is what stands in
    one, less what is marked; of that, shared texts and lists of links go where a class hints
    at it, for an article's own sentence may be on every page. Elsewhere the induced template
    decides: shared texts and lists of links go, what varies stays unless it is marked. Where
    the texts that stay are less than a twentieth, the host's pages are too alike to tell.

    Articles under marked classes count where they hold more text than all that is not under
    any, and classes do not count where they would leave nothing of a page whose texts vary.
    """
    rows = []
    for block, place in zip(page.blocks, places, strict=True):
        links = block.linked > LINK_SHARE * len(block.text)
        shared = (place, text_hash(block.text)) in fixed
        rows.append((block, block.node.standing, shared, links or place in lists))
    Row = tuple[Block, Standing, bool, bool]

    def left(level: int) -> list[Row]:
        kept = [r for r in rows if not r[1].out[level]]
        if level == 1 or any(r[1].article for r in kept):
            return [r for r in kept if r[1].article]
        return [r for r in kept if r[0].linked <= LINK_SHARE * len(r[0].text)]

    def size(kept: list[Row]) -> int:
        return sum(len(r[0].text) for r in kept)

    def template(row: Row) -> bool:
        _, standing, shared, links = row
        return (shared or links) and (standing.hinted or not standing.article)

    kept = left(0)
    if not any(r[1].article for r in kept) and size(wider := left(1)) > size(kept):
        kept = wider
    if not kept:
        kept = [r for r in left(2) if not r[2]]
    varying = [r for r in kept if not template(r)]
    if size(varying) >= VARYING_SHARE * size(kept):
        kept = varying
    return " ".join(r[0].text for r in kept)


def host_of(url: str | Column) -> Column:
    """The host of an address in lower case without port and user; empty where there is none."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def _counted(rows: Counter[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame([(*row, n) for row, n in rows.items()], columns=columns, dtype=object)


def layouts(pages: DataFrame) -> DataFrame:
    """(host, layout, n): the distinct layouts of every host."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["host"], (Page(h).layout.text() for h in batch["html"]), strict=True)
            yield _counted(Counter(pairs), ["host", "layout", "n"])

    found = pages.select("host", "html").mapInPandas(find, "host string, layout string, n long")
    return found.groupBy("host", "layout").agg(F.sum("n").alias("n"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): one tree that all layouts of a host align with.

    Layouts are merged some dozens at a time, most frequent first, in as many rounds as the
    host with most layouts needs. A node weighs the pages that have it; of a tree that grows
    beyond ``TEMPLATE_NODES`` the heaviest nodes are kept, since no text of the others can be
    on most pages.
    """
    found = stored(layouts(pages), "layouts")
    most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        ordered = batch.sort_values(["n", "layout"], ascending=[False, True])
        template = None
        for text, n, whole in zip(ordered["layout"], ordered["n"], ordered["merged"], strict=True):
            tree = Tree.of(text, None if whole else int(n))
            template = merged(template, tree).pruned(TEMPLATE_NODES) if template else tree
        row = {"host": ordered["host"].iloc[0], "layout": template.text(), "n": int(ordered["n"].sum())}
        return pd.DataFrame([row | {"merged": True}])

    kind = "host string, layout string, n long, merged boolean"
    found = found.withColumn("merged", F.lit(False))
    while most > 1:
        most = -(-most // FAN_IN)
        group = F.pmod(F.xxhash64("layout"), F.lit(most)).alias("group")
        found = found.groupBy("host", group).applyInPandas(merge, kind)
        found = stored(found, "layouts")
    return found.select("host", F.col("layout").alias("template"))


def constants(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(host, shared, lists): (place, hash) of texts of a host's template, places of lists of links.

    Counts are
    over all pages of a host, by partial sums; a text counts once a page. Since a text is kept
    only where most pages have it, a host's list is no longer than a page or two and its tree.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, Aligner] = {}
        for batch in batches:
            rows: dict[tuple, list[int]] = {}
            for host, html, template in zip(batch["host"], batch["html"], batch["template"], strict=True):
                if host not in known:
                    if len(known) >= KNOWN:
                        known.clear()
                    known[host] = Aligner(template)
                page = Page(html)
                met: dict[tuple, tuple[int, int]] = {(host, None, None): (0, 0)}
                for place, block in zip(known[host].places(page), page.blocks, strict=True):
                    if place is not None:
                        size, linked = met.get((host, place, None), (0, 0))
                        met[host, place, None] = size + len(block.text), linked + min(block.linked, len(block.text))
                        met[host, place, text_hash(block.text)] = (0, 0)
                for key, (size, linked) in met.items():
                    row = rows.setdefault(key, [0, 0, 0])
                    row[0] += 1
                    row[1] += size
                    row[2] += linked
            columns = ["host", "place", "hash", "pages", "size", "linked"]
            yield pd.DataFrame([(*key, *row) for key, row in rows.items()], columns=columns, dtype=object)

    joined = pages.select("host", "html").join(found, "host")
    kind = "host string, place long, hash long, pages long, size long, linked long"
    sums = [F.sum(c).alias(c) for c in ("pages", "size", "linked")]
    counts = joined.mapInPandas(find, kind).groupBy("host", "place", "hash").agg(*sums)
    counts = stored(counts.where((F.col("pages") >= TEMPLATE_PAGES) | F.col("place").isNull()), "texts")
    total = counts.where("place is null").select("host", F.col("pages").alias("all"))
    links = F.col("hash").isNull() & (F.col("linked") > LINK_SHARE * F.col("size"))
    shared = F.col("hash").isNotNull() & (F.col("pages") >= TEMPLATE_SHARE * F.col("all"))
    fixed = counts.where("place is not null").join(total, "host")
    return fixed.groupBy("host").agg(
        F.collect_list(F.when(shared, F.struct("place", "hash"))).alias("shared"),
        F.collect_list(F.when(links, F.col("place"))).alias("lists"),
    )


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Pages of a host are aligned with the host's template, a tree merged from all its layouts
    by simple tree matching. Texts that stay the same at a node of it, and nodes that are lists
    of links, belong to the template; the others are content unless what holds them is marked
    as menu, header, footer, sidebar, notice, advert, form, script, style or reader comments
    (``main_text``). White space in a block becomes one space, and blocks are joined by one.

    Null and empty pages give an empty text; a page whose host has fewer than five is judged
    by its marks alone, and pages without an address share a host. Nothing recurses and every
    page is scanned once, so depth, unclosed tags and many unlike children do no harm. Repeated
    rows give one row each; an empty table gives none.
    """
    rows = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    found = templates(rows)
    fixed = constants(rows, found)
    fixed = found.join(fixed, "host", "left")
    wrappers = stored(fixed.withColumns({c: F.coalesce(c, F.array()) for c in ("shared", "lists")}), "wrappers")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[Aligner, set, set]] = {}
        for batch in batches:
            texts = []
            columns = (batch[c] for c in ("host", "html", "template", "shared", "lists"))
            for host, html, template, shared, lists in zip(*columns, strict=True):
                if host not in known:
                    if len(known) >= KNOWN:
                        known.clear()
                    known[host] = Aligner(template), {(c["place"], c["hash"]) for c in shared}, set(lists)
                aligner, fixed, slots = known[host]
                page = Page(html)
                texts.append(main_text(page, aligner.places(page), fixed, slots))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"].astype(object), "text": texts})

    joined = rows.join(wrappers, "host")
    texts = joined.mapInPandas(extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
