"""HTML extraction with consensus host paths.

Each page is parsed leniently. Its text blocks score the containers they stand in (length without link
text). The containers that hold article text, the best one and those of a fifth of its score, climb to
their common ancestor; below the body they stay a set. A headline that stands before them joins the set.
Paths are generalised: tags and classes from the root down, digits masked. In Spark, the pages of a host
vote for their sets of paths, separately for each template, the containers that occur in a page. Every page
is then read again. Where at least three pages of its host and template have voted and two thirds agree,
their set is taken; a page on which that set has little of the text, or without such a consensus, keeps
its own.

Text inside menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments
and hidden elements is left out wherever it stands. Class names count by whole words, and a form or an
element that is named like a notice is kept if it wraps the page: if it holds most of the text and next to
nothing is kept beside it. A block is the text between two boundaries of block elements: character
references decoded, white space (line breaks too) one space, trimmed.

A quote opens an attribute's value only behind ``=``, and the value ends at the next such quote however
far it is; a quote that is never closed is a plain character.

Defined results: null or empty html gives an empty text; a null URL is of the host "", as is one
without ``://``; a page without a scored container gives all its text outside dropped elements; equal
rows are voters of their own; unclosed elements end where HTML would end them, at the latest with the page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, written
from millsight.llm.url_filter import split_url

#: Containers hold article text from this share of the best one's score and this score on.
PART_SHARE, PART_SCORE = 0.2, 60
#: Votes and their share that make a consensus, and the share of a page's own text it must have there.
LEAST_VOTES, AGREEMENT, LEAST_SHARE = 3, 2 / 3, 0.4
#: A wrapper holds over half of a page's text, and next to it less than this share of its own is kept.
BESIDE = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)|=)*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s/=>][^\s/=>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?"
)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Tags and words of classes, ids and roles that HTML pages use (fixed values).
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark "
    "picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "nav footer aside form script style noscript template button select textarea iframe object "
    "svg canvas head menu dialog title xmp noembed noframes".split()
)
#: What is never a wrapper of the article.
NEVER_KEPT = DROPPED - {"form"}
COMMENT_WORDS = frozenset(
    "comment comments commentlist respond reply replies disqus nav navbar menu footer sidebar".split()
)
DROPPED_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertise advertisement advertisements advertising adverting banner notice aside "
    "widget widgets modal consent cookie cookies gdpr login search pager pagination toolbar topbar masthead "
    "outbrain taboola alert complementary contentinfo navigation dialog copyright skip sponsor sponsors "
    "sponsored sponsoring newsletter newsletters breadcrumb breadcrumbs sidebars navbars social socials share "
    "shares sharing sharebar sharebox related recommend recommended recommendation recommendations promo "
    "promos promoted promotion promotions popup popups subscribe subscription subscriptions".split()
)
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}


class Node:
    __slots__ = ("tag", "parent", "path", "drop", "wrapper", "dropped", "article")

    def __init__(self, tag, parent, path, drop, wrapper, article):
        self.tag, self.parent, self.path = tag, parent, path
        # Named as something to drop; perhaps a wrapper of the page; dropped itself or with a parent.
        self.drop, self.wrapper, self.dropped = drop, wrapper, False
        self.article = article


class Page:
    """Elements and the pieces of text: (block number, element, inside a link, raw text)."""

    def __init__(self, html: str):
        self.nodes: list[Node] = []
        self.pieces: list[tuple[int, Node, bool, str]] = []
        root = Node("", None, "", False, False, None)
        stack, block, links, at = [root], 0, 0, 0
        search = _TOKEN.search
        while True:
            token = search(html, at)
            end = token.start() if token else len(html)
            if end > at:
                self.pieces.append((block, stack[-1], links > 0, html[at:end]))
            if not token:
                break
            at = token.end()
            closing, opening, attributes = token.groups()
            if opening:
                tag = opening.lower()
                if tag == "br":
                    self.pieces.append((block, stack[-1], links > 0, " "))
                elif tag not in VOID:
                    inline = tag in INLINE
                    if not inline:
                        block += 1
                        self._imply_ends(stack, tag)
                        links = sum(node.tag == "a" for node in stack)
                    elif tag == "a":
                        links += 1
                    if not attributes.endswith("/") or inline or tag in RAW:
                        stack.append(self._element(tag, attributes, stack[-1]))
                    if tag in RAW:
                        found = re.compile(f"</{tag}", re.I).search(html, at)
                        at = found.start() if found else len(html)
                elif tag == "hr":
                    block += 1
            elif closing:
                tag = closing.lower()
                inline = tag in INLINE
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        del stack[depth:]
                        links = sum(node.tag == "a" for node in stack)
                        break
                    if inline and stack[depth].tag not in INLINE:
                        break
                if not inline:
                    block += 1
        self._drop()

    def _drop(self) -> None:
        """Mark dropped elements, but for wrappers of the page."""

        def mark() -> None:
            for node in self.nodes:  # parents first
                node.dropped = node.drop or node.parent.dropped

        mark()
        if not any(node.drop and node.wrapper for node in self.nodes):
            return
        held: dict[int, int] = {}
        total = kept = 0
        for _, node, _, text in self.pieces:
            size = 0 if text.isspace() or node.tag in RAW else len(text)
            total += size
            kept += 0 if node.dropped else size
            while size and node is not None:
                held[id(node)] = held.get(id(node), 0) + size
                node = node.parent
        for node in self.nodes:
            size = held.get(id(node), 0)
            if node.drop and node.wrapper and 2 * size > total and kept < BESIDE * size:
                node.drop = False
        mark()

    @staticmethod
    def _imply_ends(stack: list[Node], tag: str) -> None:
        ended, within = CLOSES.get(tag, ("p", ("table", "button", "object")))
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ended.split():
                del stack[depth:]
                return
            if stack[depth].tag in within:
                return

    def _element(self, tag: str, attributes: str, parent: Node) -> Node:
        classes, words, hidden = "", [], False
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id", "role"):
                    for word in value.split():
                        words.append(_PART.findall(_CAMEL.sub(" ", word).lower()))
                    if name == "class":
                        classes = "".join("." + c for c in sorted(value.lower().split()))
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    hidden = True
                elif name == "style":
                    hidden |= "display:none" in value.replace(" ", "").lower()
        article = parent.article
        drop, wrapper = hidden, not hidden
        if tag not in ("html", "body", "article", "main"):
            named = [word for parts in words for word in _dropping_words(parts)]
            header = (tag == "header" or ["header"] in words) and article is None
            drop = drop or tag in DROPPED or bool(named) or header
            wrapper = wrapper and tag not in NEVER_KEPT and COMMENT_WORDS.isdisjoint(named)
        path = re.sub(r"\d+", "#", f"{parent.path}>{tag}{classes}")
        node = Node(tag, parent, path, drop, wrapper, article)
        if node.tag in ("article", "main") and article is None:
            node.article = node
        self.nodes.append(node)
        return node

    def containers(self) -> list[tuple[Node, float]]:
        """The containers of text and their scores; one inside an article stands for the article."""
        weight: dict[int, list] = {}
        for block, node, linked, text in self.pieces:
            if not node.dropped and not text.isspace():
                held = weight.setdefault(block, [node, 0, 0])
                held[1] += len(text)
                held[2] += linked and len(text)
        found: dict[int, list] = {}
        for node, size, linked in weight.values():
            value = size - 2.0 * linked
            if value < 20:
                continue
            while node.parent is not None and (node.tag in INLINE or node.tag in _LEAVES):
                node = node.parent
            node = node.article or node
            if node.tag not in ("", "html"):
                found.setdefault(id(node), [node, 0.0])[1] += value
        return [(node, score) for node, score in found.values()]

    def own_paths(self) -> tuple[str, str | None]:
        """The page's template and its set of paths, each as one text; no set without a container."""
        scored = self.containers()
        template = " ".join(sorted({node.path for node, _ in scored}))
        if not scored:
            return template, None
        best = max(score for _, score in scored)
        chosen = [n for n, s in scored if s == best or (s >= PART_SHARE * best and s >= PART_SCORE)]
        common = _common_ancestor(chosen)
        if common.tag in ("", "html", "body") and len(chosen) > 1:
            paths = {node.path for node in chosen}
        else:
            paths = {common.path}
        return template, " ".join(sorted(paths | self._headline(paths)))

    def _headline(self, paths: set[str]) -> set[str]:
        """The path of the last h1 before the chosen text, if that has none of its own."""
        inside = self._within(paths)
        if any(node.tag == "h1" and not node.dropped and inside(node) for node in self.nodes):
            return set()
        found: set[str] = set()
        for _, node, _, text in self.pieces:
            if not node.dropped and not text.isspace():
                if inside(node):
                    break
                while node is not None and node.tag != "h1":
                    node = node.parent
                found = {node.path} if node is not None else found
        return found

    @staticmethod
    def _within(paths: set[str]):
        known: dict[int, bool] = {}

        def within(node: Node | None) -> bool:
            if node is None:
                return False
            found = known.get(id(node))
            if found is None:
                found = known[id(node)] = node.path in paths or within(node.parent)
            return found

        return within

    def text_at(self, paths: str | None) -> str:
        """The blocks inside elements of a set of paths (no set: anywhere), joined by line breaks."""
        within = self._within(set((paths or "").split(" ")))
        blocks: dict[int, list[str]] = {}
        for block, node, _, text in self.pieces:
            if not node.dropped and (paths is None or within(node)):
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks.values())
        return "\n".join(filter(None, lines))


def _common_ancestor(nodes: Sequence[Node]) -> Node:
    chains = []
    for node in nodes:
        chain = []
        while node is not None:
            chain.append(node)
            node = node.parent
        chains.append(chain[::-1])
    common = chains[0][0]
    for level in zip(*chains, strict=False):
        if any(node is not level[0] for node in level):
            break
        common = level[0]
    return common


_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol pre blockquote td th tr tbody dt dd dl".split())


def _dropping_words(parts: Sequence[str]) -> list[str]:
    """First and last words of a class, id or role that name something outside the article."""
    if not parts or not {"with", "no", "has", "without"}.isdisjoint(parts):
        return []
    return [p for p in (parts[0], parts[-1]) if p in DROPPED_WORDS]


def template_name(containers: str) -> int:
    """A signed 64-bit name of a template."""
    return xxhash.xxh3_64_intdigest(containers.encode()) - (1 << 63)


def own_paths(html: str | None) -> tuple[int, str | None]:
    """The page's template and set of paths."""
    template, paths = Page(html or "").own_paths()
    return template_name(template), paths


def extract(html: str | None, winner: str | None) -> tuple[str, str | None]:
    """The page's main text and the set of paths it was taken from."""
    page = Page(html or "")
    _, own = page.own_paths()
    own_text = page.text_at(own)
    if winner is not None and winner != own:
        text = page.text_at(winner)
        if len(text) >= LEAST_SHARE * len(own_text) and text:
            return text, winner
    return own_text, own


def _votes(batches):
    for batch in batches:
        hosts, pages = (c.to_pylist() for c in batch.columns)
        found = [own_paths(html) for html in pages]
        columns = [pa.array(hosts, pa.string()), pa.array([f[0] for f in found], pa.int64())]
        columns.append(pa.array([f[1] for f in found], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, ["host", "template", "paths"])


def _templates(batches):
    for batch in batches:
        found = [own_paths(html)[0] for html in batch.column(batch.num_columns - 1).to_pylist()]
        columns = [*batch.columns, pa.array(found, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_template"])


def _extractions(batches):
    for batch in batches:
        *kept, winners, pages = batch.columns
        pairs = zip(pages.to_pylist(), winners.to_pylist(), strict=True)
        found = [extract(html, winner) for html, winner in pairs]
        columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
        names = [*batch.schema.names[:-2], "text", "path"]
        yield pa.RecordBatch.from_arrays([*kept, *columns], names)


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The sets of paths that the pages of a host and template agree on: host, template, paths."""
    asked = pages.select(split_url(F.col(url))[0].alias("host"), F.col(html).cast("string"))
    votes = asked.mapInArrow(_votes, "host string, template long, paths string")
    tally = votes.filter("paths IS NOT NULL").groupBy("host", "template", "paths").agg(F.count("*").alias("votes"))
    won = tally.groupBy("host", "template").agg(
        F.max_by("paths", F.struct("votes", "paths")).alias("paths"),
        F.max("votes").alias("most"),
        F.sum("votes").alias("all"),
    )
    agreed = (F.col("all") >= LEAST_VOTES) & (F.col("most") >= F.lit(AGREEMENT) * F.col("all"))
    return written(won.filter(agreed).select("host", "template", "paths"), "host-paths")


def main_text(
    pages: DataFrame, carry: Sequence[str] = ("page_id",), url: str = "url", html: str = "html"
) -> DataFrame:
    """Carried columns, text and the set of paths it was taken from, for every page."""
    winners = host_paths(pages, url, html)
    winners = counted_broadcast(
        winners.select(F.col("host").alias("_host"), F.col("template").alias("_of"), F.col("paths").alias("_winner"))
    )
    asked = pages.select(
        *carry, split_url(F.col(url))[0].alias("_at"), F.col(html).cast("string").alias("_html")
    )
    types = [f.simpleString().replace(":", " ", 1) for f in asked.schema.fields]
    asked = asked.mapInArrow(_templates, ", ".join([*types, "_template long"]))
    same = (F.col("_at") == F.col("_host")) & (F.col("_template") == F.col("_of"))
    asked = asked.join(winners, same, "left").select(*carry, "_winner", "_html")
    return asked.mapInArrow(_extractions, ", ".join([*types[:-2], "text string", "path string"]))
