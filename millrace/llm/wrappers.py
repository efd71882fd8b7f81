"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tags and texts.  Runs that repeat are folded into a repeated group.  The
streams of a host's pages are aligned one after the other with what came out so far: equal tags
match, texts that differ become slots, repeated groups are aligned inside, and what only one side
has becomes optional.  The result, the host's wrapper, has no unions and accepts all its pages.

The main region of a page is what lies in its ``article`` or ``main``; a page without these has it
in the element that holds the slots of the wrapper, as text outside it that never changes is the
site's and not the page's; pages that are all copies of one have no site's text to tell.  Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out by
element, role or class.  Each page is judged by its own elements and by what it aligns with in its host's wrapper.

Wrappers are built where the pages lie, and merged in three steps, so that a host with very many
pages is no single group; which pages come first changes the wrapper's optional parts, not what it
accepts.  Null pages and pages without main text give empty texts; pages whose URL is null or has
no host share one wrapper.  Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.workspace import stored

from .batches import column, texts_of
from .graph import join_salted
from .urls import url_parts

#: Longest run of nodes that is looked for as a repeated group.
LONGEST_GROUP = 12
#: Largest wrapper table that is sent to all executors, in bytes.
SENT_BYTES = 32 << 20
#: A host's wrappers are merged in so many parts at first, then in fewer.
PARTS = (256, 16, 1)
#: Largest table of an alignment, and the streams' lengths in one of several tables.
CELLS, WINDOW = 1 << 20, 512
#: Lengths of the runs of keys at which long streams are cut.
RUNS = (16, 8, 4, 2, 1)
#: So many page shapes are remembered.
SHAPES = 2_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?/>"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[a-z/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.IGNORECASE | re.DOTALL)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

# Elements by what they do to text.
MAIN = {"article", "main"}
ASIDE = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "header"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "input", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "base", "area", "col", "source"}
REGIONS = {"div", "section"}
TITLES = {"h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "advertorial", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "contentinfo", "cookie",
    "cookies", "discussion", "disqus", "footer", "header", "login", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "paid", "popup", "promo", "replies", "search",
    "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
}
#: Words that leave the meaning of a word of ASIDE_WORDS beside them as it is.
NEUTRAL_WORDS = {
    "area", "article", "bar", "block", "bottom", "box", "button", "buttons", "consent", "container",
    "content", "form", "global", "google", "icon", "icons", "item", "items", "left", "level",
    "link", "links", "list", "main", "media", "message", "mobile", "page", "post", "primary",
    "reader", "right", "secondary", "section", "signup", "site", "slot", "sticky", "thread", "top",
    "unit", "user", "widget", "widgets", "wrap", "wrapper",
}
#: Elements that end an open paragraph, and those that end others before them, by where they look.
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div",
          "dl", "dt", "dd", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre",
          "search", "section", "summary", "table", "ul"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table", "tr"}),
        "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"})}
TAG, TEXT, REPEAT = 0, 1, 2


class Node:
    """A tag, a text or a repeated group; ``value`` is the tag, a constant text (None: a slot) or
    the group's nodes, ``source`` the places of a page's texts that stand here."""

    __slots__ = ("kind", "value", "optional", "source")

    def __init__(self, kind, value, optional=False, source=None):
        self.kind, self.value, self.optional, self.source = kind, value, optional, source or []

    def key(self) -> str:
        """Equal for nodes that can be aligned."""
        if self.kind == TAG:
            return self.value
        return "#" if self.kind == TEXT else "+" + self.value[0].key()

    def shape(self) -> str:
        """Equal for nodes of the same structure."""
        if self.kind == REPEAT:
            return "(" + " ".join(node.shape() for node in self.value) + ")+"
        return self.key()

    def packed(self):
        value = [node.packed() for node in self.value] if self.kind == REPEAT else self.value
        return [self.kind, value, int(self.optional)]

    @staticmethod
    def unpacked(packed) -> Node:
        kind, value, optional = packed
        return Node(kind, [*map(Node.unpacked, value)] if kind == REPEAT else value, bool(optional))


def tag_token(tag: str, attrs: str) -> str:
    """The tag with the words of its class, id and role that tell it from the main text.

    A word counts if it stands alone or with words that say no more than where and what kind the
    element is, as in ``site-header`` or ``comment-list``, but not in ``no-sidebar``.
    """
    name = tag.lower()
    if not attrs or name[0] == "/" or name in MAIN or name in ("html", "body"):
        return name
    words = set()
    for found in ATTRIBUTE.findall(attrs):
        for token in (found[1] or found[2] or found[3]).lower().split():
            parts = {part for part in re.split(r"[^a-z]+", token) if part}
            if {"side", "bar"} <= parts:
                parts = parts - {"side", "bar"} | {"sidebar"}
            if parts <= ASIDE_WORDS | NEUTRAL_WORDS:
                words |= parts & ASIDE_WORDS
    return " ".join([name, *sorted(words)])


def parse(html: str | None) -> tuple[list[Node], list[str | None]]:
    """The folded stream of a page, and its texts with None where a block starts or ends."""
    nodes, pieces = [], []
    for found in TOKEN.finditer(html or ""):
        tag, text = found["tag"], found["text"]
        if text is not None:
            if nodes and nodes[-1].kind == TEXT:
                nodes[-1].source.append(len(pieces))
            elif text.isspace():
                pass
            else:
                nodes.append(Node(TEXT, text, source=[len(pieces)]))
            pieces.append(unescape(text))
        elif tag is not None:
            token = tag_token(tag, found["attrs"])
            name = token.partition(" ")[0].lstrip("/")
            if name == "br":
                pieces.append(" ")
            elif name not in INLINE:
                pieces.append(None)
            nodes.append(Node(TAG, token))
    return fold(nodes), pieces


def fold(nodes: list[Node]) -> list[Node]:
    """Runs of equal neighbours become repeated groups, short ones first, until none are left."""
    changed = True
    while changed:
        changed = False
        for size in range(1, LONGEST_GROUP + 1):
            shapes = [node.shape() for node in nodes]
            result, at = [], 0
            while at < len(nodes):
                end = at + size
                if (end < len(nodes) and shapes[at] == shapes[end]
                        and shapes[at:end] == shapes[end:end + size]
                        and not (size == 1 and nodes[at].kind != TAG)):
                    body = nodes[at:end]
                    while shapes[at:at + size] == shapes[end:end + size]:
                        for one, other in zip(body, nodes[end:end + size]):
                            absorb(one, other)
                        end += size
                    result.append(Node(REPEAT, body))
                    at, changed = end, True
                else:
                    result.append(nodes[at])
                    at += 1
            nodes = result
    return nodes


def absorb(one: Node, other: Node) -> None:
    """``other``, of the same shape, is one more occurrence of ``one``."""
    if one.kind == TEXT:
        one.source += other.source
        if one.value != other.value:
            one.value = None
    elif one.kind == REPEAT:
        for x, y in zip(one.value, other.value):
            absorb(x, y)


def align(left: list[Node], right: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """The alignment of two streams with the most in common; main and side elements weigh most.

    Streams too long for one table are cut at runs of keys that both have once, the longest runs
    first and the parts between them again; a long part without any goes through tables that follow
    each other.  So the work is linear in long pages, and no node is left out.
    """
    a, b = [n.key() for n in left], [n.key() for n in right]
    pairs: list[tuple[int | None, int | None]] = []
    # Spans of both streams still to be aligned, the next one last.
    spans = [(0, len(a), 0, len(b))]
    while spans:
        i, i_end, j, j_end = spans.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        same = 0
        while same < min(i_end - i, j_end - j) and a[i_end - 1 - same] == b[j_end - 1 - same]:
            same += 1
        if same:
            spans.append((i_end - same, i_end, j_end - same, j_end))
            i_end, j_end = i_end - same, j_end - same
        if i == i_end or j == j_end:
            pairs += [(k, None) for k in range(i, i_end)]
            pairs += [(None, k) for k in range(j, j_end)]
        elif (i_end - i) * (j_end - j) <= CELLS:
            pairs += [(x if x is None else x + i, y if y is None else y + j)
                      for x, y in align_table(a[i:i_end], b[j:j_end])]
        else:
            cuts = common_runs(a[i:i_end], b[j:j_end])
            if cuts:
                parts, x, y = [], i, j
                for at, other in cuts:
                    parts.append((x, i + at, y, j + other))
                    x, y = i + at, j + other
                spans += reversed([*parts, (x, i_end, y, j_end)])
            else:
                # The pairs of one table are kept but for its last ones, which may be better in the next.
                table = align_table(a[i:min(i_end, i + WINDOW)], b[j:min(j_end, j + WINDOW)])
                table = table[:max(1, len(table) // 2)]
                pairs += [(x if x is None else x + i, y if y is None else y + j) for x, y in table]
                spans.append((i + sum(x is not None for x, _ in table), i_end,
                              j + sum(y is not None for _, y in table), j_end))
    return [(None if x is None else left[x], None if y is None else right[y]) for x, y in pairs]


def common_runs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Where the longest of the runs of keys stand that both streams have once, in order."""
    for size in RUNS:
        once = []
        for keys in (a, b):
            places: dict[tuple, int] = {}
            for at in range(len(keys) - size + 1):
                run = tuple(keys[at:at + size])
                places[run] = -1 if run in places else at
            once.append({run: at for run, at in places.items() if at >= 0})
        both = sorted((at, once[1][run]) for run, at in once[0].items() if run in once[1])
        # The longest chain of places that rise on both sides.
        ends: list[int] = []
        last: list[tuple] = []
        for pair in both:
            length = bisect_left(ends, pair[1])
            link = (pair, last[length - 1] if length else None)
            if length == len(ends):
                ends.append(pair[1])
                last.append(link)
            else:
                ends[length], last[length] = pair[1], link
        chain, link = [], last[-1] if last else None
        while link:
            chain.append(link[0])
            link = link[1]
        if chain:
            return chain[::-1]
    return []


def align_table(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """The best alignment of keys, from a table of all prefixes."""
    weight = {key: 20 if key.lstrip("/").partition(" ")[0] in MAIN | ASIDE else
              1 if key == "#" else 3 for key in {*a, *b}}
    best = [[0] * (len(b) + 1)]
    for key in a:
        above, row, plus = best[-1], [0], weight[key]
        for j, other in enumerate(b):
            value = above[j] + plus if key == other else 0
            row.append(max(value, above[j + 1], row[j]))
        best.append(row)
    i, j, pairs = len(a), len(b), []
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and best[i][j] == best[i - 1][j - 1] + weight[a[i - 1]]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif j and (not i or best[i][j] == best[i][j - 1]):
            j -= 1
            pairs.append((None, j))
        else:
            i -= 1
            pairs.append((i, None))
    return pairs[::-1]


def expose(nodes: list[Node], other: list[Node]) -> list[Node]:
    """Single occurrences of what the other side repeats, as repeated groups."""
    bodies = {tuple(n.shape() for n in node.value): node for node in other if node.kind == REPEAT}
    if not bodies:
        return nodes
    shapes, result, at = [n.shape() for n in nodes], [], 0
    while at < len(nodes):
        for body in bodies:
            if tuple(shapes[at:at + len(body)]) == body:
                result.append(Node(REPEAT, nodes[at:at + len(body)],
                                   any(n.optional for n in nodes[at:at + len(body)])))
                at += len(body)
                break
        else:
            result.append(nodes[at])
            at += 1
    return result


def merge(wrapper: list[Node], page: list[Node], placed: list | None = None) -> list[Node]:
    """The wrapper that accepts both; ``placed`` gets (node of the result, places of texts)."""
    result = []
    for one, other in align(expose(wrapper, page), expose(page, wrapper)):
        node = one or other
        if one is None or other is None:
            node.optional = True
            if one is None and placed is not None:
                note(node, placed)
        else:
            node.optional = one.optional or other.optional
            if node.kind == TEXT:
                if one.value != other.value:
                    node.value = None
                if placed is not None:
                    placed.append((node, other.source))
            elif node.kind == REPEAT:
                node.value = merge(one.value, other.value, placed)
        result.append(node)
    return result


def note(node: Node, placed: list) -> None:
    if node.kind == TEXT:
        placed.append((node, node.source))
    elif node.kind == REPEAT:
        for inner in node.value:
            note(inner, placed)


class Open:
    """An open element of a page."""

    __slots__ = ("name", "aside", "holds_main")

    def __init__(self, name: str, aside: bool):
        self.name, self.aside, self.holds_main = name, aside, False


def close(open_tags: list[Open], names: set[str], within: set[str] = frozenset()) -> None:
    """End the last of ``names``, with all in it, unless one of ``within`` was opened in it."""
    for at in range(len(open_tags) - 1, -1, -1):
        if open_tags[at].name in names:
            del open_tags[at:]
            return
        if open_tags[at].name in within:
            return


def main_texts_of(page: list[Node], slots: list[bool]) -> list[bool]:
    """For each text node of a page in order, whether it is main text.

    ``slots`` says which of them the host's wrapper has as slots.  They decide on pages without
    article or main: constant texts are the site's where they lie outside the element that holds
    the slots.  A page without slots is main text but for its side elements.
    """
    texts, open_tags = [], []
    mains: list[bool] = []

    def read(nodes: list[Node]) -> None:
        for node in nodes:
            if node.kind == REPEAT:
                read(node.value)
            elif node.kind == TEXT:
                texts.append(tuple(open_tags))
            elif node.value[0] == "/":
                close(open_tags, {node.value[1:]})
            else:
                start(*node.value.split(" "))

    def start(name: str, *words: str) -> None:
        if name in ENDS_P:
            close(open_tags, {"p"})
        if name in VOID or name in ("html", "body"):
            return
        if name in ENDS:
            close(open_tags, *ENDS[name])
        # The title block of an article is part of it; a page's header is not.
        inner = any(tag.name in MAIN for tag in open_tags)
        aside = name in ASIDE and not (inner and name == "header") or bool(words) and not (
            inner and set(words) == {"header"})
        if name in MAIN:
            mains.append(not any(tag.aside for tag in open_tags))
            for tag in open_tags:
                tag.holds_main = True
        open_tags.append(Open(name, aside))

    read(page)
    # What holds all there is of main text is no side element.
    free = any(mains)

    def is_aside(tag: Open) -> bool:
        return tag.aside and (free or not tag.holds_main)

    kept = [not any(map(is_aside, tags)) for tags in texts]
    if mains:
        return [keep and any(tag.name in MAIN for tag in tags) for keep, tags in zip(kept, texts)]
    held = [[tag for tag in tags if tag.name in REGIONS]
            for keep, slot, tags in zip(kept, slots, texts) if keep and slot]
    region = list(held[0]) if held else []
    for tags in held[1:]:
        same = [a is b for a, b in zip(region, tags)]
        region = region[:same.index(False) if False in same else len(same)]

    def inside() -> list[bool]:
        return [keep and (not region or any(tag is region[-1] for tag in tags))
                for keep, tags in zip(kept, texts)]

    # A part with titles only is not all of the text.
    while region and all(any(tag.name in TITLES for tag in tags)
                         for keep, tags in zip(inside(), texts) if keep):
        region.pop()
    return inside()


class Wrapper:
    """A host's wrapper; alignments are remembered by the shape of pages.

    ``only`` is the hash of its pages if they are all copies of one, "" if they are not, and None
    without pages.
    """

    def __init__(self, nodes: list[Node] | None = None, only: str | None = None):
        self.nodes, self.only = nodes, only
        self.known: dict[str, list] = {}

    def see(self, only: str | None) -> None:
        if only is not None:
            self.only = only if self.only in (None, only) else ""

    def learn(self, page: list[Node], html: str | None = None) -> None:
        if not page:
            return
        self.see("" if html is None else hashlib.blake2b(
            html.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest())
        if self.nodes is None:
            self.nodes = page
            return
        shape = " ".join(node.shape() for node in page)
        slots = self.known.get(shape)
        if slots is not None:
            values: list = []
            for node in page:
                note_values(node, values)
            for node, value in zip(slots, values):
                if node.value != value:
                    node.value = None
            return
        before = len(self.nodes)
        placed: list = []
        texts = sum(count_texts(node) for node in page)
        optional = [node.optional for node in self.nodes]
        self.nodes = merge(self.nodes, page, placed)
        if len(self.nodes) != before or [n.optional for n in self.nodes] != optional:
            self.known.clear()
        elif len(placed) == texts:
            if len(self.known) >= SHAPES:
                self.known.clear()
            self.known[shape] = [node for node, _ in placed]

    def join(self, other: Wrapper) -> None:
        self.nodes = other.nodes if self.nodes is None else merge(self.nodes, other.nodes or [])
        self.see(other.only)
        self.known.clear()

    def packed(self) -> str:
        return json.dumps([self.only, [node.packed() for node in self.nodes or []]])

    @staticmethod
    def unpacked(packed: str) -> Wrapper:
        only, nodes = json.loads(packed)
        return Wrapper([*map(Node.unpacked, nodes)] or None, only)


def count_texts(node: Node) -> int:
    return sum(map(count_texts, node.value)) if node.kind == REPEAT else node.kind == TEXT


def note_values(node: Node, values: list) -> None:
    if node.kind == TEXT:
        values.append(node.value)
    elif node.kind == REPEAT:
        for inner in node.value:
            note_values(inner, values)


class Extractor:
    """Reads pages with a finished wrapper."""

    def __init__(self, packed: str):
        self.packed = packed
        self.known: dict[str, list[bool]] = {}

    def slots(self, page: list[Node], place: dict[int, int]) -> list[bool]:
        """For each text of the page, found by its first place, whether it stands in a slot."""
        wrapper = Wrapper.unpacked(self.packed)
        found, placed = [wrapper.only != ""] * len(place), []
        merge(wrapper.nodes or [], page, placed)
        for node, source in placed:
            if source and node.value is None:
                found[place[source[0]]] = True
        return found

    def text(self, html: str | None) -> str:
        page, pieces = parse(html)
        shape = " ".join(node.shape() for node in page)
        sources: list = []
        for node in page:
            note(node, sources)
        main = self.known.get(shape)
        if main is None:
            if len(self.known) >= SHAPES:
                self.known.clear()
            place = {source[0]: k for k, (_, source) in enumerate(sources)}
            # The page is read before the alignment changes its groups.
            plain = [Node.unpacked(node.packed()) for node in page]
            main = self.known[shape] = main_texts_of(plain, self.slots(page, place))
        taken = {at for keep, (_, source) in zip(main, sources) if keep for at in source}
        blocks, block = [], []
        for at, piece in enumerate([*pieces, None]):
            if piece is None:
                line = " ".join("".join(block).split())
                if line:
                    blocks.append(line)
                block = []
            elif at in taken or piece.isspace():
                block.append(piece)
        return "\n".join(blocks)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``wrapper`` of the pages (host, html)."""
    def learn(batches):
        task, found, size = TaskContext.get().partitionId(), {}, 0

        def out() -> pa.RecordBatch:
            return pa.record_batch({
                "host": list(found), "part": pa.array([task] * len(found), pa.int32()),
                "wrapper": [w.packed() for w in found.values()]})

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                size += host not in found
                found.setdefault(host, Wrapper()).learn(parse(html)[0], html)
                if size > 20_000:
                    yield out()
                    found, size = {}, 0
        if found:
            yield out()

    def join(table: pa.Table) -> pa.Table:
        total = Wrapper()
        for packed in sorted(table["wrapper"].to_pylist()):
            total.join(Wrapper.unpacked(packed))
        part = table["part"][0].as_py()
        return pa.table({"host": [table["host"][0].as_py()],
                         "part": pa.array([part], pa.int32()), "wrapper": [total.packed()]})

    schema = "host string, part int, wrapper string"
    merged = pages.mapInArrow(learn, schema)
    for parts in PARTS:
        merged = merged.withColumn("part", F.expr(f"part % {parts}")) \
            .groupBy("host", "part").applyInArrow(join, schema)
    return stored(merged.drop("part"), "wrappers")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """One row per page: id, url and main ``text``."""
    host, _ = url_parts(column(url_col))
    source = pages.select(host.alias("host"), column(html_col).alias("html"),
                          column(id_col).alias("id"), column(url_col).alias("url"))
    wrappers = infer_wrappers(source.select("host", "html"))
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    both = source.join(F.broadcast(wrappers), "host") if size <= SENT_BYTES else join_salted(
        source, wrappers, ["host"], F.col("id"))
    kinds = {name: source.schema[name].dataType.simpleString() for name in ("id", "url")}

    def run(batches):
        readers: dict[str, Extractor] = {}
        for batch in batches:
            texts = []
            for host, html, packed in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                          batch.column(2)):
                if host not in readers:
                    if len(readers) > 1_000:
                        readers.clear()
                    readers[host] = Extractor(packed.as_py())
                texts.append(readers[host].text(html))
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(4), pa.array(texts, pa.string())],
                ["id", "url", "text"])

    return both.select("host", "html", "wrapper", "id", "url").mapInArrow(
        run, f"id {kinds['id']}, url {kinds['url']}, text string").toDF(id_col, url_col, "text")
