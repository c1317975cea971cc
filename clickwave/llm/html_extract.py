"""Main text of web pages by wrapper induction over the pages of a host.

A page is parsed into a tree of block elements with the text runs between them
as leaves.  The pages of a host are told apart by layout: the set of neighbours
in the sequence of its container tags, articles left out.  Up to ``BASES`` pages
of each layout are its bases, and *every* page of the layout is aligned with
them by simple tree matching (the heaviest order-preserving matching of children
whose labels agree, top-down).  A leaf of a base is constant if at least
``AGREE`` of the pages that have a leaf in its place have the same text there,
and these are at least ``PLACED`` of the layout's pages; inside an article all
of at least ``ARTICLE_PAGES`` other pages must agree.  The constants, and the
elements above them, are the layout's wrapper.  Every page is aligned with the
wrappers of its layout; leaves that fall on a constant are template, all others
are slots that hold content.

Of the slots, those are left out that their elements mark as something other
than the article: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, hidden parts and reader comments.  A class name, id or role
marks an element if all its words do, or say no more than a place or a shape
(``cookie-notice``, ``AdBox``; not ``market-share`` or ``has-sidebar``).  If the
page has an article (else a main) element, only slots inside it count; otherwise
no name marks an element that holds most of the page's unlinked text.

Scale: bases are chosen by a partial minimum over (layout, residue of the page's
hash), short pages first; what pages agree on is counted per (layout, base,
leaf), one narrow row a page, so a hot host is spread over all tasks and no
group of pages meets in one.  Trees are kept as outlines with hashed texts.
Bases and wrappers are joined to the pages: broadcast while there are at most
``SMALL_LAYOUTS``, else by a sort-merge join whose hot layouts Spark splits.

Defined results: null or empty html gives an empty text; a page with a null or
host-less url, or alone in its layout, is read without a wrapper; repeated rows
are extracted alike and count once in a wrapper; an empty table gives no rows;
elements may be nested to any depth; no other column is read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.llm.common import small_side

BASES = 3
#: Pages below this length are equally good bases; of longer ones the shortest.
BASE_CHARS = 20_000
SMALL_LAYOUTS = 2000
#: Share of the pages with a leaf in the place that must agree, the least share
#: of such pages, and the number of other pages for leaves of an article.
AGREE, PLACED, ARTICLE_PAGES = 0.75, 0.4, 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*+>"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S | re.I)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var").split())
BREAKS = frozenset("br hr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
NOT_CONTENT = frozenset("head nav footer aside form button dialog menu".split())
#: Words in class, id or role that mark a part as something else than the article.
NOT_ARTICLE = frozenset((
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager "
    "search searchbox copyright disclaimer comment comments commentlist discussion disqus respond reply replies "
    "complementary contentinfo").split())

#: Words that tell a place or a shape beside such a word, and nothing else.
NEUTRAL = frozenset((
    "area bar block box button buttons container content form group header heading icon icons inline inner item items left "
    "link links list main mobile outer page panel post posts primary right row secondary section site slot sticky text "
    "title top bottom unit user wrap wrapper").split())
#: Of the marking words, the ones that mark an article element as a comment or a teaser.
NOT_MAIN = frozenset("ad advert advertisement comment reply related recommended promo sponsored teaser".split())


class Node:
    __slots__ = ("tag", "label", "kids", "up", "off", "links", "text", "key")

    def __init__(self, tag: str, label: str, up: "Node | None", off: int):
        self.tag, self.label, self.up, self.off = tag, label, up, off
        self.kids: list[Node] = []
        self.links, self.text, self.key = 0, "", ""


def parse(page: str) -> Node:
    """The tree of block elements; leaves (tag ``#``) hold the text runs with
    their white space reduced, and how many of their characters are links."""
    root = at = Node("", "", None, 0)
    run: list[str] = []
    linked, in_link = 0, 0

    def flush():
        nonlocal linked
        text = " ".join(entities.unescape("".join(run)).split()) if run else ""
        if text:
            leaf = Node("#", "#", at, 0)
            leaf.text, leaf.links = text, min(linked, len(text))
            leaf.key = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            at.kids.append(leaf)
        run.clear()
        linked = 0

    def close(tag, only_to=None):
        nonlocal at
        node = at
        while node is not root and node.tag != tag:
            if only_to and node.tag in only_to:
                return
            node = node.up
        if node is not root:
            flush()
            at = node.up

    end = 0
    for m in _TOKEN.finditer(page):
        if m.start() > end:
            piece = page[end:m.start()]
            run.append(piece)
            linked += len(piece) if in_link else 0
        end = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "a":
                in_link = 0
            elif tag in INLINE:
                if at.tag == tag:  # an inline part that is left out
                    flush()
                    at = at.up
            elif tag not in VOID:
                in_link = 0
                close(tag)
                if tag == "p":
                    flush()
            continue
        if tag in VOID:
            run.append(" " if tag in BREAKS else "")
            continue
        label, off = _look(tag, m["attrs"])
        if tag in INLINE and not off:
            in_link = 1 if tag == "a" else in_link
            continue
        in_link = 0
        if tag not in INLINE:
            if tag in CLOSES:
                for shut in CLOSES[tag]:
                    close(shut, {"ul", "ol", "dl", "table", "body", "html"})
            if at.tag == "p":
                close("p")
        flush()
        if not m["attrs"].rstrip().endswith("/") or tag in INLINE:
            node = Node(tag, label, at, off)
            at.kids.append(node)
            at = node
    run.append(page[end:])
    linked += len(page) - end if in_link else 0
    flush()
    return root


def _marks(name: str, words: frozenset[str]) -> bool:
    """Whether a class name, id or role says that its element is one of ``words``."""
    parts = {w.lower() for w in _WORDS.findall(name)}
    return bool(parts & words) and parts <= words | NOT_ARTICLE | NEUTRAL


def _look(tag: str, attrs: str) -> tuple[str, int]:
    """Label of an element, and what says that it is no content: 2 for its tag
    or that it is hidden, 1 for its names alone, 0 for nothing."""
    off = 2 if tag in NOT_CONTENT else 0
    if not attrs or attrs.isspace():
        return tag, off
    found = {}
    for name, a, b, c, bare in _ATTR.findall(attrs):
        found[(name or bare).lower()] = a or b or c
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        off = 2
    if not off and tag not in ("html", "body", "main"):
        words = NOT_MAIN if tag == "article" else NOT_ARTICLE
        off = int(any(_marks(name, words) for k in ("class", "id", "role") for name in found.get(k, "").split()))
    if found.get("role", "").lower() == "main":
        return "main", off
    return f"{tag}.{found.get('class', '')}", off


def leaves(node: Node) -> list[Node]:
    out, stack = [], [node]
    while stack:
        node = stack.pop()
        if node.tag == "#":
            out.append(node)
        stack.extend(reversed(node.kids))
    return out


def align(a: Node, b: Node, same_text: bool) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of two nodes whose labels agree: the weight of the
    heaviest matching and its pairs of leaves, last ones first.  Equal leaves
    weigh 2, other pairs of leaves 1, or nothing with ``same_text``."""
    open_, value = [_match(a, b, same_text)], None
    while open_:  # each step asks for the pair of elements that it needs next
        try:
            pair = open_[-1].send(value)
        except StopIteration as done:
            open_.pop()
            value = done.value
        else:
            open_.append(_match(*pair, same_text))
            value = None
    return value


def _match(a: Node, b: Node, same_text: bool):
    x, y = a.kids, b.kids
    # equal leaves at both ends weigh the most they can: they are matched right away
    low, high = 0, min(len(x), len(y))
    while low < high and x[low].tag == "#" == y[low].tag and x[low].key == y[low].key:
        low += 1
    tail, high = 0, high - low
    while tail < high and x[-1 - tail].tag == "#" == y[-1 - tail].tag and x[-1 - tail].key == y[-1 - tail].key:
        tail += 1
    out = [(x[-1 - k], y[-1 - k]) for k in range(tail)]
    head = [(x[k], y[k]) for k in reversed(range(low))]
    x, y = x[low:len(x) - tail], y[low:len(y) - tail]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    pairs: dict[tuple[int, int], list] = {}
    for i, p in enumerate(x):
        row, above = best[i + 1], best[i]
        for j, q in enumerate(y):
            w = 0
            if p.label == q.label:
                if p.tag == "#":
                    w = 2 if p.key == q.key else 0 if same_text else 1
                    if w:
                        pairs[i, j] = [(p, q)]
                elif len(p.kids) == 1 == len(q.kids) and p.kids[0].tag == "#" == q.kids[0].tag:
                    f, g = p.kids[0], q.kids[0]  # most elements hold a single run of text
                    w = 3 if f.key == g.key else 1 if same_text else 2
                    pairs[i, j] = [(f, g)] if w > 1 else []
                elif p.kids and q.kids:
                    w, pairs[i, j] = yield p, q
                else:
                    w, pairs[i, j] = 1, []
            row[j + 1] = max(above[j + 1], row[j], above[j] + w)
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            out += pairs[i - 1, j - 1]
            i, j = i - 1, j - 1
    return best[len(x)][len(y)] + 2 * (low + tail) + 1, out + head


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags or node.label in tags:
            return True
        node = node.up
    return False


def outline(root: Node, keep: set[int] | None = None) -> str:
    """The leaves (those numbered in ``keep``) and the elements above them, as a
    JSON list of (depth, label) and (depth, "#", hashed text) in page order."""
    rows, path, stack, n = [], [], [(root, 0)], -1
    while stack:
        node, depth = stack.pop()
        del path[depth:]
        if node.tag != "#":
            path.append([node.label, False])
            stack.extend((k, depth + 1) for k in reversed(node.kids))
            continue
        n += 1
        if keep is not None and n not in keep:
            continue
        new = depth
        while new and not path[new - 1][1]:
            new -= 1
        for k in range(new, depth):
            rows.append([k, path[k][0]])
            path[k][1] = True
        rows.append([depth, "#", node.key])
    return json.dumps(rows, ensure_ascii=False) if rows else ""


def load_wrapper(text: str) -> Node:
    path: list[Node] = []
    for depth, label, *key in json.loads(text):
        del path[depth:]
        node = Node(label.split(".")[0], label, path[-1] if path else None, 0)
        if key:
            node.key = key[0]
        if path:
            path[-1].kids.append(node)
        path.append(node)
    return path[0]


def agreement(base: Node, page: Node) -> tuple[list[int], list[int]]:
    """Numbers of the leaves of ``base`` that have one of ``page`` in their
    place, and of those with the same text there."""
    number = {id(leaf): n for n, leaf in enumerate(leaves(base))}
    pairs = align(base, page, False)[1]
    return [number[id(p)] for p, _ in pairs], [number[id(p)] for p, q in pairs if p.key == q.key]


def constants(base: Node, others: int, placed: dict[int, int], same: dict[int, int]) -> set[int]:
    """Leaves of ``base`` on which the other pages of its layout agree."""
    out = set()
    for n, leaf in enumerate(leaves(base)):
        at, equal = placed.get(n, 0), same.get(n, 0)
        if _inside(leaf, ("article", "main")):
            if equal == others >= ARTICLE_PAGES:
                out.add(n)
        elif equal >= max(1, AGREE * at) and at >= PLACED * others:
            out.add(n)
    return out


def induce(pages: Iterable[str]) -> str:
    """The wrapper that the smallest of some pages of a layout gives, as an
    outline; empty if there is none."""
    trees = sorted((parse(p) for p in dict.fromkeys(pages) if p), key=lambda t: len(leaves(t)))
    if len(trees) < 2:
        return ""
    placed: dict[int, int] = {}
    same: dict[int, int] = {}
    for page in trees[1:]:
        for tally, found in zip((placed, same), agreement(trees[0], page)):
            for n in found:
                tally[n] = tally.get(n, 0) + 1
    return outline(trees[0], constants(trees[0], len(trees) - 1, placed, same))


def extract(page: str | None, *wrappers: Node) -> str:
    """Main text: the content slots in page order, joined by one space."""
    if not page:
        return ""
    root = parse(page)
    template = {id(q) for wrapper in wrappers for _, q in align(wrapper, root, True)[1]}
    found = leaves(root)
    articles = _holders(found, ("article",)) or _holders(found, ("main",))
    spared = _with(found, articles) if articles else _most(found)
    out, known = [], {}
    for leaf in found:
        if id(leaf) not in template and not _left_out(leaf.up, articles, spared, known):
            out.append(leaf.text)
    return " ".join(out)


def _left_out(node: Node, articles: set[int], spared: set[int], known: dict[int, tuple[bool, bool, bool]]) -> bool:
    """Whether the elements around a leaf leave it out.  ``known`` tells of each
    element: it or one above leaves out, is in a chosen article, in any article."""
    way = []
    while node is not None and id(node) not in known:
        way.append(node)
        node = node.up
    off, inside, any_article = known[id(node)] if node is not None else (False, False, False)
    for node in reversed(way):
        inside = inside or id(node) in articles
        any_article = any_article or node.tag == "article" or node.label == "article"
        header = node.tag == "header" and not inside and not any_article
        if node.off or header:
            free = id(node) in spared and (
                node.tag in ("div", "section", "body", "main", "header") if articles else node.off == 1)
            off = off or not free
        known[id(node)] = off, inside, any_article
    return off or bool(articles and not inside)


def _with(found: list[Node], articles: set[int]) -> set[int]:
    """The chosen articles and all elements above them."""
    out: set[int] = set()
    for leaf in found:
        node, under = leaf.up, False
        while node is not None and id(node) not in out:
            under = under or id(node) in articles
            if under:
                out.add(id(node))
            node = node.up
    return out


def _most(found: list[Node]) -> set[int]:
    """Elements that hold more than half of the page's unlinked text."""
    own: dict[int, list] = {}
    total = 0
    for leaf in found:
        n = len(leaf.text) - leaf.links
        total += n
        own.setdefault(id(leaf.up), [leaf.up, 0])[1] += n
    held: dict[int, int] = {}
    for node, n in own.values():
        while node is not None and n:
            held[id(node)] = held.get(id(node), 0) + n
            node = node.up
    return {k for k, n in held.items() if 2 * n > total}


def _holders(found: list[Node], tags: tuple[str, ...]) -> set[int]:
    """Outermost elements with such a tag that hold text.  Those in a part left
    out do not count, unless all are in parts that only their class or id
    leaves out: then these are taken for the page's layout."""
    clear, marked = set(), set()
    for leaf in found:
        node, top, way = leaf.up, None, 0
        while node is not None:
            if (node.tag in tags or node.label in tags) and not node.off:
                top = node
            if node.off:
                way = max(way, 1 if top is not None and node.tag in ("div", "section") else 2)
            node = node.up
        if top is not None and way < 2:
            (marked if way else clear).add(id(top))
    return clear or marked


def host_of(url: Column) -> Column:
    """Lower-cased host; null without one."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


_CONTAINER = (r"(?i)<(/?(?:div|section|nav|header|footer|aside|main|form)\b"
              r"(?:[^>]*?\sclass\s*=\s*(?:\x22[^\x22>]*|'[^'>]*|[^\s>\x22']+))?)")


def layout_of(page: Column) -> Column:
    """Hash of the pairs of neighbours in the sequence of container tags (with
    their classes), what lies between the first and the last article left out."""
    outside = F.concat_ws("<", F.substring_index(page, "<article", 1),
                          F.when(page.contains("</article"), F.substring_index(page, "</article", -1)))
    tags = F.concat_ws("<", F.regexp_extract_all(outside, F.lit(_CONTAINER), F.lit(1)))
    tags = F.split(F.lower(F.regexp_replace(tags, r"(?i)\s[^<]*?\bclass\s*=\s*", " ")), "<")
    # the array is bound to a name, so that it is made once
    pairs = F.transform(F.array(tags), lambda t: F.array_sort(F.array_distinct(F.zip_with(
        F.concat(F.array(F.lit("")), t), F.concat(t, F.array(F.lit(""))), lambda x, y: F.concat_ws(">", x, y)))))
    return F.xxhash64(pairs)


def _pages_of_hosts(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    return (pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
            .where(F.col("host").isNotNull() & (F.length("html") > 0))
            .withColumn("layout", layout_of(F.col("html"))).withColumn("h", F.xxhash64("html")))


def layout_bases(slim: DataFrame, bases: int = BASES) -> DataFrame:
    """``host, layout, trees``: outlines of up to ``bases`` pages, by page hash."""
    size = F.greatest(F.length("html"), F.lit(BASE_CHARS))
    few = (slim.groupBy("host", "layout", F.pmod("h", F.lit(bases)).alias("part"))
           .agg(F.min(F.struct(size.alias("size"), "h")).alias("least"))
           .select(F.col("host").alias("_h"), F.col("layout").alias("_l"), F.col("least.h").alias("_x")))
    few = slim.join(small_side(few, bases * SMALL_LAYOUTS),
                    (F.col("host") == F.col("_h")) & (F.col("layout") == F.col("_l")) & (F.col("h") == F.col("_x")))
    few = few.groupBy("host", "layout", "h").agg(F.first("html").alias("html"))  # one of equal pages

    def outlines(batches):
        for b in batches:
            yield b.assign(tree=[outline(parse(x)) for x in b["html"]])[["host", "layout", "h", "tree"]]
    few = few.mapInPandas(outlines, "host string, layout long, h long, tree string").where(F.col("tree") != "")
    return few.groupBy("host", "layout").agg(F.collect_list(F.struct("h", "tree")).alias("trees"))


class _Trees(dict):
    """Trees of the outlines met last."""

    def __missing__(self, text: str) -> Node:
        if len(self) > 500:
            self.clear()
        tree = self[text] = load_wrapper(text)
        return tree


_FOUND = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("layout", T.LongType()), T.StructField("h", T.LongType()),
    T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("base", T.LongType()), T.StructField("placed", T.ArrayType(T.IntegerType())),
        T.StructField("same", T.ArrayType(T.IntegerType()))])))])


def layout_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", bases: int = BASES) -> DataFrame:
    """``host, layout, wrappers``: what all pages of a layout have in common
    with each of its bases."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_FOUND)
    slim = _pages_of_hosts(pages, url_col, html_col)
    based = layout_bases(slim, bases)
    held = small_side(based, SMALL_LAYOUTS)
    keys = ["host", "layout"]

    def compare(batches):
        known = _Trees()
        for batch in batches:
            found = []
            for page, h, trees in zip(batch.column(2), batch.column(3), batch.column(4)):
                root, h, mine = parse(page.as_py()), h.as_py(), []
                for base in trees.as_py():
                    if base["h"] != h:
                        placed, same = agreement(known[base["tree"]], root)
                        mine.append({"base": base["h"], "placed": placed, "same": same})
                found.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(found, arrow.field("found").type)], schema=arrow)
    each = (slim.join(held, keys).select(*keys, "html", "h", "trees").mapInArrow(compare, _FOUND)
            .groupBy(*keys, "h").agg(F.first("found").alias("found"))  # copies count once
            .select(*keys, F.explode("found").alias("f")).select(*keys, "f.*"))
    # leaf -1 counts the other pages themselves
    votes = (each.select(*keys, "base", F.explode(F.concat(F.array(F.lit(-1)), "placed")).alias("leaf"), "same")
             .withColumn("same", F.array_contains("same", F.col("leaf")).cast("int"))
             .groupBy(*keys, "base", "leaf").agg(F.count(F.lit(1)).alias("placed"), F.sum("same").alias("same"))
             .groupBy(*keys, "base").agg(F.collect_list(F.struct("leaf", "placed", "same")).alias("votes")))
    trees = based.select(*keys, F.explode("trees").alias("t")).select(*keys, F.col("t.h").alias("base"), "t.tree")

    def decide(batches):
        for b in batches:
            wrappers = []
            for tree, found in zip(b["tree"], b["votes"]):
                base = load_wrapper(tree)
                placed = {v["leaf"]: v["placed"] for v in found}
                keep = constants(base, placed.pop(-1), placed, {v["leaf"]: v["same"] for v in found})
                wrappers.append(outline(base, keep))
            yield b.assign(wrapper=wrappers)[["host", "layout", "wrapper"]]
    return (votes.join(trees, [*keys, "base"]).select(*keys, "tree", "votes")
            .mapInPandas(decide, "host string, layout long, wrapper string").where(F.col("wrapper") != "")
            .groupBy(*keys).agg(F.collect_list("wrapper").alias("wrappers")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              bases: int = BASES) -> DataFrame:
    """One row per page: id, url, ``text``, ``n_chars``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wrappers = small_side(layout_wrappers(pages, url_col, html_col, bases), SMALL_LAYOUTS).select(
        F.col("host").alias("_h"), F.col("layout").alias("_l"), F.col("wrappers").alias("_w"))
    slim = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("_html"),
                        host_of(F.col(url_col)).alias("_host"), layout_of(F.col(html_col).cast("string")).alias("_layout"))
    joined = (slim.join(wrappers, (F.col("_host") == F.col("_h")) & (F.col("_layout") == F.col("_l")), "left")
              .select(id_col, url_col, "_html", "_w"))
    schema = T.StructType([joined.schema[0], joined.schema[1], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        known = _Trees()
        for batch in batches:
            texts = [extract(page.as_py(), *(known[w] for w in found.as_py() or ()))
                     for page, found in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=arrow)
    return joined.mapInArrow(run, schema)
