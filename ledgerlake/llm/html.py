"""Main text of web pages by wrapper induction.

Pages of one host share a template.  Each page's DOM is reduced to a tree in which runs
of siblings of the same kind are one node (a list has any number of items), and aligned
with the tree of a reference page by simple tree matching: the largest set of node pairs
that keeps parents, order and kind.  Each layout of a host that ``FEWEST`` distinct pages
have gets its own reference.  Counted over all distinct pages with one reference (pages
of the same texts count once), a node has a template text if this stands in
nearly all pages that the node occurs in; it is left out where a page has this text, and
all else is content, also another text at the same node.

The main text is the content in the page's article (or main) element, or all content of a
page without one; an article's own paragraphs, headings and lists are always content,
so copies of one article on a host don't turn into template.  Scripts, styles, menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are known by element, role or class and never
count.  With fewer than ``FEWEST`` aligned pages nothing is taken for template.

Character references are decoded once, white space inside a block becomes one space,
blocks are trimmed and joined by one space in page order.  Null or empty pages have the
text "".  Repeated pages are each extracted, a null URL belongs to the host "".
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written
from ledgerlake.llm.urls import host_of

FEWEST, SAME = 5, 0.9
#: Elements that an article holds as its own text, whatever other pages say.
TEXTUAL = frozenset("article main p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption address".split())
#: Elements whose blocks are the main text: those of articles, without one those of main.
HOLDS = {"article": 2, "main": 1}
#: Start tags up to this length are described once in a task for all elements that have them.
SHORT = 200
#: References of all hosts are broadcast up to this many bytes, else joined by host.
BROADCAST_BYTES = 32 << 20
#: Parsed references that a task keeps, in characters of their pages.
TREE_CHARS = 4 << 20
LEVELS = ("_k0", "_k1", "_k2", "_k3")
ADDED = ("text", "n_chars")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
UNSEEN = frozenset("script style template noscript".split())
SKIPPED = frozenset("script style noscript template head title nav footer aside form button select textarea input iframe object embed svg canvas dialog menu xmp noembed noframes".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SKIPPED_CLASS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|advertisement|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|newsletter|subscribe|popup|modal|nav\w*|menu\w*|breadcrumbs?|header|masthead|"
    r"footer|sidebar|side-bar|widget\w*|comments?|comment-\w+|replies|disqus\w*|respond|share|social\w*|related|toolbar|skip-link)(?:$|[\s_-])", re.IGNORECASE)
#: A start tag closes these open ones.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          **{t: {"p"} for t in "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()}}
#: ... but not beyond these.
SCOPES = frozenset("table ul ol dl div article section main body html td th aside nav footer header form blockquote".split())
#: Text, then what begins with the "<" behind it: a start tag of which neither the name nor
#: a value holds "<" (name, attributes), an end tag, CDATA, another start tag (only its "<"),
#: or a "<" that is text.  Comments, doctypes and instructions are no group.  No part is read
#: beyond the next "<" in vain, so all take time linear in the page.
_PART = re.compile(
    r"([^<]*+)(?:<(?:([a-zA-Z][^\s<>/\"']*+)((?:[\s/](?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)?+)>|/\s*+([a-zA-Z][^\s<>/]*+)[^<>]*+>?|!--.*?(?:-->|\Z)|"
    r"!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*+>?|((?=[a-zA-Z]))|()))?", re.DOTALL)
_ATTRIBUTES, _END, _CDATA, _START, _SIGN = range(3, 8)
_RAW_END = {t: re.compile(rf"</{t}[\s>/]", re.IGNORECASE) for t in RAW}
#: End tags that close nothing outside a scope, and elements that a slash does not close.
_SCOPED, _UNCLOSED = INLINE | {"p", "li"}, INLINE | {"p", "div"}
_NAME_END, _SPECIAL = re.compile(r"[\s>/]"), re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)", re.IGNORECASE)


_NUMBER = re.compile("[0-9]+")


class _Ends:
    """Where start tags of a page end, in time linear in the page.

    A tag ends at the first ">" outside quotes.  From a quote on, that place depends on the
    quote alone, so it is found once for each; a search that starts before the last one's
    result and after its start has the same result.
    """

    def __init__(self, page: str):
        self.page, self.known = page, {}
        self.seen = {_NAME_END: (0, -1), _SPECIAL: (0, -1)}

    def _next(self, pattern: re.Pattern, at: int) -> int:
        start, found = self.seen[pattern]
        if not start <= at <= found:
            m = pattern.search(self.page, at)
            found = m.start() if m else len(self.page)
            self.seen[pattern] = at, found
        return found

    def of(self, at: int) -> tuple[int, int] | None:
        """End of the name that begins at ``at`` and place of the tag's ">", if it has one."""
        name = self._next(_NAME_END, at)
        quote, passed = self._next(_SPECIAL, name), []
        while quote < len(self.page) and self.page[quote] != ">" and quote not in self.known:
            passed.append(quote)
            close = self.page.find(self.page[quote], quote + 1)
            m = _SPECIAL.search(self.page, close + 1) if close >= 0 else None
            quote = m.start() if m else len(self.page)
        end = self.known.get(quote, quote)
        for q in passed:
            self.known[q] = end
        return (name, end) if end < len(self.page) else None


class Node:
    __slots__ = ("tag", "kind", "children", "skipped")

    def __init__(self, tag: str, kind: str, skipped: bool):
        self.tag, self.kind, self.children, self.skipped = tag, kind, [], skipped


@lru_cache(10_000)
def _described(tag: str, attributes: str) -> tuple[str, bool]:
    """Kind of an element, and whether its tag, role, class or attributes make it skipped."""
    found = {m[0].lower(): (m[1] or m[2] or m[3] or "").strip() for m in _ATTRIBUTE.findall(attributes)} if attributes else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    skipped = tag in SKIPPED or found.get("role", "").lower() in SKIPPED_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    if names and tag not in ("html", "body", "main", "article"):
        skipped = skipped or bool(SKIPPED_CLASS.search(names))
    return f"{tag}.{_NUMBER.sub('0', found.get('class', ''))}", skipped  # numbered classes are one kind


def parse(page: str) -> Node:
    """The page's tree; children are nodes and strings.  Tags may be left open."""
    root = Node("#", "#", False)
    stack, at, ends, size, part, unescape = [root], 0, None, len(page), _PART.match, entities.unescape
    while at < size:
        m = part(page, at)
        at = m.end()
        text, tag, attributes, end, cdata, _, _ = m.groups()
        if text:
            stack[-1].children.append(unescape(text) if "&" in text else text)
        what = m.lastindex
        if what == _START:
            ends = ends or _Ends(page)
            found = ends.of(at)
            if found:
                tag, attributes, at = page[at:found[0]], page[found[0]:found[1]], found[1] + 1
            else:
                what = _SIGN
        if what == _SIGN:
            stack[-1].children.append("<")
        elif what == _CDATA:
            stack[-1].children.append(cdata)
        elif what == _END:
            end = end.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == end:
                    del stack[i:]
                    break
                if end in _SCOPED and stack[i].tag in SCOPES:
                    break
        elif tag is not None:
            tag = tag.lower()
            for closed in CLOSES.get(tag, ()):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == closed:
                        del stack[i:]
                        break
                    if stack[i].tag in SCOPES:
                        break
            kind, skipped = (_described if len(tag) + len(attributes) <= SHORT else _described.__wrapped__)(tag, attributes)
            if tag == "header" and not skipped:
                skipped = not any(n.tag in ("article", "main") for n in stack)
            node = Node(tag, kind, skipped)
            stack[-1].children.append(node)
            if tag in RAW:
                close = _RAW_END[tag].search(page, at)
                stop = close.start() if close else size
                node.children.append(page[at:stop])
                at = stop
                if close:
                    gt = page.find(">", stop)
                    at = gt + 1 if gt >= 0 else size
            elif tag not in VOID and not attributes.rstrip().endswith("/"):
                stack.append(node)
            elif tag not in VOID and tag in _UNCLOSED:
                stack.append(node)  # the slash means nothing in HTML
    return root


def blocks(root: Node) -> list[tuple[Node, int, str]]:
    """Text blocks under a node that are not skipped, in page order, each with its block
    element and what holds it (2: an article, 1: only a main element, 0: neither); inline
    elements do not end a block."""
    out, now = [], []

    def end(owner: Node, held: int) -> None:
        text = " ".join("".join(now).split())
        if text:
            out.append((owner, held, text))
        now.clear()

    owner, held = root, 0
    work: list = [(root, root, 0)]
    while work:
        x, within, kept = work.pop()
        if type(x) is str:
            now.append(x)
            continue
        if x is not None:
            if x.tag in UNSEEN:
                continue  # takes no room, so it ends no block either
            if x.tag in INLINE:
                if not x.skipped:
                    work += [(c, within, kept) for c in reversed(x.children)]
                continue
        if now:
            end(owner, held)
        owner, held = within, kept
        if x is not None and not x.skipped:
            holds = max(kept, HOLDS.get(x.tag, 0))
            if len(x.children) == 1 and type(x.children[0]) is str:
                now.append(x.children[0])
                end(x, holds)
            else:
                owner, held = x, holds
                work.append((None, within, kept))
                work += [(c, x, holds) for c in reversed(x.children)]
    end(owner, held)
    return out


def articles(root: Node) -> list[Node]:
    """Outermost article elements that are not skipped, or else the main elements."""
    for wanted in ("article", "main"):
        found, work = [], [root]
        while work:
            x = work.pop()
            if x.tag == wanted and not x.skipped:
                found.append(x)
            elif not x.skipped or x.tag == "#":
                work.extend(c for c in reversed(x.children) if not isinstance(c, str))
        if found:
            return found
    return []


class Group:
    """A run of siblings of one kind: a node of the reduced tree."""

    __slots__ = ("kind", "children", "members", "own", "shape", "size")

    def __init__(self, kind: str, members: list[Node], texts: dict[int, list[str]]):
        self.kind, self.members = kind, members
        self.own = "\n".join(t for m in members for t in texts.get(id(m), ()))
        self.children = []


def reduced(root: Node, every: list[tuple[Node, int, str]] | None = None) -> Group:
    """The tree of groups, made from the top so that deep pages need no recursion.  A
    group's own text is that of its members' blocks (``every``, if known), inline
    descendants included."""
    texts: dict[int, list[str]] = {}
    for node, _, text in blocks(root) if every is None else every:
        texts.setdefault(id(node), []).append(text)
    top = Group(root.kind, [root], texts)
    work, order = [top], []
    while work:
        g = work.pop()
        order.append(g)
        runs: dict[str, list[Node]] = {}
        for member in g.members:
            for c in member.children:
                if isinstance(c, str) or c.tag in ("script", "style"):
                    continue
                runs.setdefault(c.kind, []).append(c)
        g.children = [Group(k, ms, texts) for k, ms in runs.items()]
        work.extend(g.children)
    for g in reversed(order):
        g.size = 1 + sum(c.size for c in g.children)
        g.shape = hash((g.kind, *(c.shape for c in g.children)))
    return top


def _alike(a: Group, b: Group) -> bool:
    """Whether the trees are the same, so that every node meets its twin."""
    return a.shape == b.shape and a.size == b.size


def _ends(a: list[Group], b: list[Group]) -> tuple[int, int]:
    """How many siblings at the start and at the end are the same trees: an optimal
    matching pairs them."""
    n = min(len(a), len(b))
    head = next((i for i in range(n) if not _alike(a[i], b[i])), n)
    tail = next((i for i in range(n - head) if not _alike(a[-1 - i], b[-1 - i])), n - head)
    return head, tail


def _places(groups: list[Group], start: int, stop: int) -> dict[str, list[int]]:
    places: dict[str, list[int]] = {}
    for j in range(stop - 1, start - 1, -1):
        places.setdefault(groups[j].kind, []).append(j)
    return places


def matching(a: Group, b: Group) -> tuple[int, list[tuple[Group, Group]]]:
    """Simple tree matching: the number of matched nodes and the pairs.

    Pairs of nodes whose parents may be matched are listed from the top and weighed from
    the bottom, without recursion.  Siblings are matched by their heaviest common
    subsequence, found over the pairs of one kind only (as Hunt and Szymanski do).
    """
    if a.kind != b.kind:
        return 0, []
    listed = [] if _alike(a, b) else [(a, b)]
    for x, y in listed:  # grows
        head, tail = _ends(x.children, y.children)
        places = _places(y.children, head, len(y.children) - tail)
        for c in x.children[head:len(x.children) - tail]:
            if c.children:
                listed += [(c, y.children[j]) for j in places.get(c.kind, ()) if y.children[j].children and not _alike(c, y.children[j])]
    weight: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], list[tuple[Group, Group]]] = {}

    def weighed(c: Group, d: Group) -> int:
        return c.size if _alike(c, d) else weight.get((id(c), id(d)), 1)

    for x, y in reversed(listed):
        xs, ys = x.children, y.children
        head, tail = _ends(xs, ys)
        stop = len(ys) - tail
        places = _places(ys, head, stop)
        best: list[tuple[int, tuple | None]] = [(0, None)] * (stop - head + 1)  # maxima of prefixes, as a Fenwick tree
        for c in xs[head:len(xs) - tail]:
            for j in places.get(c.kind, ()):  # from the last, so none builds on another of c
                total, chain, k = 0, None, j - head
                while k:
                    if best[k][0] > total:
                        total, chain = best[k]
                    k &= k - 1
                entry = total + weighed(c, ys[j]), (chain, c, ys[j])
                k = j - head + 1
                while k < len(best):
                    if best[k][0] < entry[0]:
                        best[k] = entry
                    k += k & -k
        total, chain, k = 0, None, stop - head
        while k:
            if best[k][0] > total:
                total, chain = best[k]
            k &= k - 1
        pairs = [*zip(xs[:head], ys[:head]), *zip(xs[len(xs) - tail:], ys[stop:])]
        weight[id(x), id(y)] = 1 + total + sum(c.size for c, _ in pairs)
        while chain:
            chain, c, d = chain
            pairs.append((c, d))
        chosen[id(x), id(y)] = pairs
    out = [(a, b)]
    for x, y in out:  # grows
        out += zip(x.children, y.children) if _alike(x, y) else chosen.get((id(x), id(y)), ())
    return len(out), out


def numbered(top: Group) -> dict[int, int]:
    """Place of each group of a reference tree, in page order."""
    places, work = {}, [top]
    while work:
        g = work.pop()
        places[id(g)] = len(places)
        work.extend(reversed(g.children))
    return places


def _mark(text: str) -> int:
    """A 64-bit hash that is the same in all tasks; 0 for no text."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if text else 0


def aligned(page: str, reference: Group, places: dict[int, int]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]], int]:
    """The page's text blocks, each with the place of its element in the reference's tree
    (-1: none, or never template) and the hash of that node's text on this page; place
    and hash of every aligned node; the hash of all blocks' texts."""
    root = parse(page)
    found = articles(root)
    every = blocks(root)
    own, nodes = {}, []
    for r, g in matching(reference, reduced(root, every))[1]:
        nodes.append((places[id(r)], _mark(g.own)))
        for m in g.members:
            own[id(m)] = nodes[-1]
    parts = [b for b in every if b[1] == HOLDS[found[0].tag]] if found else every
    return [(*((-1, 0) if held and node.tag in TEXTUAL else own.get(id(node), (-1, 0))), text) for node, held, text in parts], nodes, _mark("\n".join(t for _, _, t in every))


@lru_cache(100_000)
def _kind(kind: str) -> int:
    return _mark(kind)


def layout(root: Node) -> tuple[list[int], int]:
    """Hashes of a page's layout, from the finest to the coarsest, and its number of paths.
    A layout is the set of the paths (of kinds) to elements that may hold a block: all of
    them, those without text elements, and these down to two elements and to one."""
    every, boxes, depths = set(), set(), ({1}, {1})
    work = [(c, 1, 0, True) for c in root.children if not isinstance(c, str)]
    while work:
        x, path, depth, box = work.pop()
        if x.skipped or x.tag in VOID:
            continue
        if x.tag not in INLINE and x.tag not in ("html", "body"):
            path, depth = (path * 0x9E3779B97F4A7C15 + _kind(x.kind)) % (1 << 64), depth + 1
            box = box and (x.tag not in TEXTUAL or x.tag in ("article", "main"))
            every.add(path)
            if box:
                boxes.add(path)
                if depth <= 2:
                    depths[0].add(path)
                if depth <= 1:
                    depths[1].add(path)
        work.extend((c, path, depth, box) for c in x.children if not isinstance(c, str))
    return [_mark(f"{k} {sorted(paths)}") for k, paths in enumerate((every, boxes, *depths))], len(every)


def _lists(rows: list[list[tuple]], types: dict[str, pa.DataType]) -> pa.Array:
    """A column of lists of structs, made of one flat column for each of their fields."""
    columns = [pa.array([x[i] for row in rows for x in row], t) for i, t in enumerate(types.values())]
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, rows))], pa.int32()), pa.StructArray.from_arrays(columns, list(types)))


def _layouts(rows: DataFrame) -> DataFrame:
    """Per page with text: host, layout hashes, number of paths, hash of its texts, order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "_page"):
            out = []
            for page in batch.column("_page").to_pylist():
                root = parse(page)
                keys, paths = layout(root)
                out.append((*keys, paths, _mark("\n".join(t for _, _, t in blocks(root)))))
            yield pa.RecordBatch.from_arrays([batch.column("_host"), batch.column("_order"), *(pa.array(c, pa.int64()) for c in zip(*out))], ["_host", "_order", *LEVELS, "_paths", "_said"])

    return rows.select("_host", "_order", "_page").mapInArrow(run, "_host string, _order long, " + ", ".join(f"{k} long" for k in (*LEVELS, "_paths", "_said"))).where("_said <> 0")


def _with_layout(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "_page"):
            keys = [layout(parse(page))[0][0] for page in batch.column("_page").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "_layout"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("_layout", T.LongType())]))


def _looked_up(pages: DataFrame, table: DataFrame, keys: dict[str, str], small: bool) -> DataFrame:
    """``pages`` with the columns of ``table``, whose columns ``keys`` names."""
    side = F.broadcast(table) if small else table
    on = [pages[k] == side[v] for k, v in keys.items()]
    return pages.join(side, on, "left").drop(*keys.values())


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """All columns of ``pages`` but the HTML, with text and n_chars; input columns of
    these names are replaced.

    A first pass hashes the pages' layouts.  A page belongs to the finest of its layouts
    that ``FEWEST`` distinct pages of the host have, or else to the host; pages left in a group
    with fewer join the host's largest group.  The reference of a group is its page with the most paths (ties: the first in the order of a hash);
    pages without text are none and belong to no group.  The tables of layouts and
    references are broadcast if their measured size allows, else joined by their keys.
    Each page is aligned once; its blocks and the hashes of its nodes' texts are written,
    texts are counted per group and node over distinct pages, and a block whose text turns
    out template is left out.
    """
    kept = [c for c in pages.columns if c not in (*ADDED, html)]
    rows = pages.select(*kept, host_of(F.col(url)).alias("_host"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("_page"))
    hashed = rows.select("_host", "_page", F.xxhash64("_page").alias("_order"))
    seen = written(_layouts(hashed).groupBy("_host", *LEVELS, "_paths", "_said").agg(F.min("_order").alias("_order")), "page-layouts")
    level = F.posexplode(F.array(*LEVELS, F.lit(0).cast("long"))).alias("level", "group")
    members = seen.select("_host", "_said", F.struct((-F.col("_paths")).alias("paths"), F.col("_order").alias("order")).alias("r"), level)
    members = members.groupBy("_host", "level", "group", "_said").agg(F.min("r").alias("r"))
    groups = members.groupBy("_host", "level", "group").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r")).where((F.col("n") >= FEWEST) | (F.col("level") == len(LEVELS)))
    known = seen.select("_host", F.col(LEVELS[0]).alias("_l"), level).distinct().join(written(groups, "page-groups"), ["_host", "level", "group"])
    known = known.groupBy("_host", "_l").agg(F.min(F.struct("level", "group", "r")).alias("g"))
    known = written(known.select(F.col("_host").alias("_h"), "_l", F.col("g.group").alias("_group"), F.col("g.r.order").alias("_first")), "page-group-of-layout")
    # Groups that too few pages were left for: these pages join the host's largest group.
    pages_of = seen.groupBy("_host", F.col(LEVELS[0]).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    sizes = known.join(pages_of, (F.col("_h") == F.col("_host")) & (F.col("_l") == F.col("_k"))).groupBy("_h", "_group", "_first").agg(F.sum("n").alias("n"))
    sizes = written(sizes, "page-group-sizes")
    largest = sizes.where(F.col("n") >= FEWEST).groupBy(F.col("_h").alias("_lh")).agg(F.max(F.struct("n", "_group", "_first")).alias("_main"))
    small_groups = sizes.where(F.col("n") < FEWEST).select(F.col("_h").alias("_sh"), F.col("_group").alias("_sg")).distinct()
    moved = small_groups.join(largest, F.col("_sh") == F.col("_lh")).select("_sh", "_sg", "_main")
    known = known.join(moved, (F.col("_h") == F.col("_sh")) & (F.col("_group") == F.col("_sg")), "left").select(
        "_h", "_l", F.coalesce("_main._group", "_group").alias("_group"), F.coalesce("_main._first", "_first").alias("_first"))
    known = written(known, "page-group-of-layout")
    wanted = known.select("_h", "_first").distinct()
    few = (known.agg(F.sum(F.length("_h") + 100)).first()[0] or 0) <= BROADCAST_BYTES
    wanted = F.broadcast(wanted) if few else wanted
    references = hashed.join(wanted, (hashed["_host"] == wanted["_h"]) & (hashed["_order"] == wanted["_first"])).groupBy("_h", F.col("_first").alias("_f")).agg(F.min("_page").alias("_reference"))
    references = written(references, "page-references")
    small = (references.agg(F.sum(F.length("_reference") + 100)).first()[0] or 0) <= BROADCAST_BYTES
    more = T.StructType.fromDDL("_host string, _group bigint, _blocks array<struct<place: int, mark: bigint, text: string>>, _nodes array<struct<place: int, mark: bigint>>, _said bigint")
    schema = T.StructType([*pages.select(*kept).schema.fields, *more.fields])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[tuple, tuple] = {}
        room = TREE_CHARS
        for batch in W.pieces(batches, "_page"):
            blocks_of, nodes_of, said = [], [], []
            for host, first, page, reference in zip(*(batch.column(c).to_pylist() for c in ("_host", "_first", "_page", "_reference"))):
                if (host, first) not in trees:
                    room -= len(reference or "")
                    if room < 0:
                        trees.clear()
                        room = TREE_CHARS - len(reference or "")
                    tree = reduced(parse(reference or ""))
                    trees[host, first] = tree, numbered(tree)
                parts, nodes, whole = aligned(page, *trees[host, first])
                blocks_of.append(parts)
                nodes_of.append(nodes)
                said.append(whole)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in kept), batch.column("_host"), batch.column("_group"),
                _lists(blocks_of, {"place": pa.int32(), "mark": pa.int64(), "text": pa.string()}),
                _lists(nodes_of, {"place": pa.int32(), "mark": pa.int64()}), pa.array(said, pa.int64())], schema.names)

    grouped = _looked_up(_with_layout(rows), known, {"_host": "_h", "_layout": "_l"}, few)
    given = _looked_up(grouped, references, {"_host": "_h", "_first": "_f"}, small)
    parsed = written(given.select(*kept, "_host", "_group", "_first", "_page", "_reference").mapInArrow(align, schema), "page-blocks")
    distinct = parsed.where("_group IS NOT NULL").groupBy("_host", "_group", "_said").agg(F.min("_nodes").alias("_nodes"))
    texts = distinct.select("_host", "_group", F.explode("_nodes").alias("n")).groupBy("_host", "_group", "n.place", "n.mark").agg(F.count(F.lit(1)).alias("n"))
    nodes = texts.groupBy("_host", "_group", "place").agg(F.sum("n").alias("n"), F.max(F.struct("n", "mark")).alias("most"))
    template = nodes.where((F.col("n") >= FEWEST) & (F.col("most.n") >= SAME * F.col("n")) & (F.col("most.mark") != 0))
    template = template.groupBy(F.col("_host").alias("_h"), F.col("_group").alias("_g")).agg(F.map_from_entries(F.collect_list(F.struct("place", "most.mark"))).alias("_template"))  # nodes of one page
    marked = _looked_up(parsed.drop("_nodes", "_said"), written(template, "page-templates"), {"_host": "_h", "_group": "_g"}, small)
    slots = F.filter("_blocks", lambda b: ~F.coalesce(F.try_element_at("_template", b["place"]) == b["mark"], F.lit(False)))
    return marked.select(*kept, F.array_join(F.transform(slots, lambda b: b["text"]), " ").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
