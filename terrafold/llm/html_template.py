"""Main text of web pages by removal of site templates.

Every page is parsed into text blocks, each with the hashes of the element subtrees it lies in.
Spark counts the subtrees per host; blocks inside a subtree that recurs across many pages of their
host are deleted. Elements whose tag, role or name says that they are no article (menus, footers, forms,
adverts, reader comments) go on any host, as a host with few pages has nothing to count; a class or
id says so only by all its words, and never of what holds an article.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path

#: A subtree is a template only if it is on so many pages of its host that differ in their text; large hosts ask for more.
TEMPLATE_PAGES = 4
#: The pages of a host are dealt out to so many parts when subtrees and templates meet.
SALTS = 16

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_SPECIAL = re.compile("""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_TELLING = re.compile("class|id|role|hidden|style", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math canvas object xmp noembed".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: inside an article they stay, however often their words recur.
_TEXT = _HEADINGS | frozenset("p li pre blockquote dt dd td th tr figcaption caption".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form header hr main menu nav ol p "
    "pre section table ul".split()
) | _HEADINGS
_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_BARE = frozenset("head nav footer aside button select datalist dialog menu audio video map".split())
_BARE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
_BARE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar sidenav menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus respond replies share "
    "sharing social related recommended widget toolbar pagination pager login skip".split()
)
#: Of these, what no article is called, be it the longest text beside one.
_SURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr popup newsletter "
    "comment comments commentlist disqus respond replies".split()
)
#: Of these, what names reader comments, menus and sidebars, be they most of a page's words.
_ALWAYS_WORDS = frozenset(
    "comment comments commentlist disqus respond replies menu nav navbar navigation sidebar sidenav breadcrumb breadcrumbs".split()
)
#: What may stand beside them in a name; with other words (has-sidebar, share-prices) a name says nothing.
_PLAIN_WORDS = frozenset(
    "area bar bottom box btn button buttons desktop footer form global header icon icons item items left link links list main "
    "mobile page post posts primary right secondary section site slot text title to top unit".split()
)


class _Node:
    __slots__ = ("bare", "barred", "depth", "digest", "inline", "inside", "main", "named", "parent", "parts", "place", "tag", "under", "words")

    def __init__(self, tag: str, parent: _Node | None, attributes: dict[str, str], bare: bool, inline: bool = False) -> None:
        self.tag, self.parent, self.bare, self.inline = tag, parent, bare, inline
        self.named = _is_named(tag, attributes) if attributes and not bare else 0
        #: Whether it is a main element, or holds one.
        self.main = not bare and _is_main(tag, attributes)
        self.inside = self.main or parent is not None and parent.inside
        self.parts: list = []
        #: Whether it is bare by its tag or state, or within such; its words outside of those.
        self.under = bare
        self.words = 0
        #: Plain elements of the same tag that are open within an inline one.
        self.depth = self.digest = 0
        #: Whether it or one around it is bare, names counted; its number among the subtrees that may be templates.
        self.barred, self.place = False, -1


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _open_inline(node: _Node, tag: str) -> _Node | None:
    """The open inline node of a tag, within the enclosing block."""
    while node.inline and node.tag != tag:
        node = node.parent
    return node if node.inline else None


def _attributes(text: str) -> dict[str, str]:
    """The values of the attributes by name, in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        if name:
            out.setdefault(name.lower(), value.strip("\"'").lower())
    return out


def _is_bare(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element by its tag, role or state is no part of an article."""
    if tag in _BARE or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    return (
        "hidden" in attributes
        or attributes.get("role") in _BARE_ROLES
        or attributes.get("aria-hidden") == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")) is not None
    )


def _is_named(tag: str, attributes: dict[str, str]) -> int:
    """Whether a class or the id, by all its words, names something that is no part of an article.

    1 if so, 2 if no article is called that, 3 if it also is none where it is most of the page.
    """
    found = 0
    if tag in ("html", "body") or _is_main(tag, attributes):
        return found
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w and not w[0].isdigit()]
        if any(w in _BARE_WORDS for w in words) and all(w in _BARE_WORDS or w in _PLAIN_WORDS for w in words):
            sure = any(w in _SURE_WORDS for w in words)
            found = max(found, 3 if any(w in _ALWAYS_WORDS for w in words) else 2 if sure else 1)
    return found


def _is_main(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ("article", "main") or attributes.get("role") in ("main", "article")


def _bar_named(nodes: list[_Node], flushed: list[list[tuple[str, _Node]]]) -> None:
    """Forms are bare, and names bar elements, unless they hold a main element.

    Names of comments, menus and sidebars bar whatever their size, others at most half of the page's
    words. Adverts can be most of the words, if there is an article beside them.
    """
    if not any(n.named or n.tag == "form" for n in nodes):
        return
    for item in nodes[1:]:
        # A node stands after its parent.
        item.under = item.bare or item.parent.under
    for item in reversed(nodes):
        if item.main and not item.under and item.parent is not None:
            item.parent.main = True
    for item in nodes[1:]:
        item.bare = item.bare or item.tag == "form" and not item.main
        item.under = item.bare or item.parent.under
    article = 0
    for pieces in flushed:
        for text, item in pieces:
            if not item.under:
                n = len(text.split())
                item.words += n
                article += n * item.inside
    for item in reversed(nodes):
        if item.parent is not None:
            item.parent.words += item.words
    for item in nodes:
        if item.named and not item.main:
            beside = article > item.words * item.inside
            item.bare = item.bare or item.named == 3 or 2 * item.words <= nodes[0].words or item.named == 2 and beside


def _split_block(pieces: list[tuple[str, _Node]]) -> list[tuple[str, _Node, bool]]:
    """The text of a block without its bare inline nodes, then the text of those."""
    out = []
    for bare in (False, True):
        own = [(t, n) for t, n in pieces if n.barred == bare]
        words = " ".join("".join(t for t, _ in own).split())
        if words:
            at = next(n for t, n in own if t.strip())
            while at.inline and not bare:
                at = at.parent
            out.append((words, at, bare))
    return out


class _Ends:
    """Where tags end: at the next > outside of quotes, or where no such is left, at the next > at all.

    A tag whose quotes never close is looked at once; from then on the answers of all later ones come from a
    table made in one pass, so that no page takes time with the square of its length.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.places: list[int] | None = None

    def __call__(self, at: int) -> int:
        """The place after the end of a tag whose name ends at ``at``; -1 if it never ends."""
        if self.places is None:
            found = _REST.match(self.page, at)
            if found:
                return found.end()
            self._look_ahead()
        i = bisect.bisect_left(self.places, at)
        end = self.outside[i]
        return end if end >= 0 else self.page.find(">", at) + 1 or -1

    def _look_ahead(self) -> None:
        """For every quote and >, where a tag ends that is outside of quotes before it."""
        self.places = [m.start() for m in _SPECIAL.finditer(self.page)]
        n = len(self.places)
        self.outside = [-1] * (n + 1)
        # The next place after each quote's partner.
        partner = {'"': -1, "'": -1}
        for i in range(n - 1, -1, -1):
            char = self.page[self.places[i]]
            if char == ">":
                self.outside[i] = self.places[i] + 1
            else:
                if partner[char] >= 0:
                    self.outside[i] = self.outside[partner[char] + 1]
                partner[char] = i


def parse(page: str) -> tuple[list[tuple[str, _Node, bool]], list[_Node]]:
    """(text, enclosing node, bare) of each block, in page order, and all nodes; digests are set."""
    root = _Node("#root", None, {}, False)
    node, nodes, flushed = root, [root], []
    # An inline node does not end its block, so a block's pieces can be of several nodes.
    text: list[tuple[str, _Node]] = []
    #: Open nodes of each tag, so that an end or a sibling without any is not looked for.
    opened: Counter[str] = Counter()

    def flush() -> None:
        if text:
            words = " ".join("".join(t for t, _ in text).split())
            if words:
                node.parts.append(words)
                flushed.append(text.copy())
            text.clear()

    def leave(to: _Node) -> None:
        nonlocal node
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent

    def close(to: _Node) -> None:
        flush()
        leave(to)

    def enter(tag: str, attributes: dict[str, str], bare: bool, inline: bool = False) -> None:
        nonlocal node
        node = _Node(tag, node, attributes, bare, inline)
        node.parent.parts.append(node)
        nodes.append(node)
        opened[tag] += 1

    ends_of = _Ends(page)
    last = page.rfind(">")
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start > last:
            # No tag that begins here can end; a comment need not.
            start = page.find("<!--", start)
        if start < 0:
            start = size
        if start > at:
            text.append((html.unescape(page[at:start]), node))
        at = start
        if at == size:
            break
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page[at + 1 : at + 2] in ("!", "?"):
            at = page.find(">", at) + 1
            continue
        found = _TAG.match(page, at)
        if found is None:
            text.append(("<", node))
            at += 1
            continue
        tag, begin = found[2].lower(), found.end()
        at = ends_of(begin)
        rest = page[begin : at - 1]
        if found[1]:
            if not opened[tag]:
                if tag == "p" or tag in _VOID:
                    # A stray end is at most the end of a block.
                    flush()
                continue
            if tag in _INLINE:
                same = _open_inline(node, tag)
                if same is not None and same.depth:
                    same.depth -= 1
                elif same is not None:
                    leave(same.parent)
                continue
            if tag == "p" or tag in _VOID:
                flush()
            up = node
            while up.tag != tag:
                up = up.parent
            close(up.parent)
            continue
        if tag in _RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            text.append((" ", node))
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        attributes = _attributes(rest) if rest and _TELLING.search(rest) else {}
        if tag in _INLINE:
            bare = _is_bare(tag, attributes, node.inside)
            if bare or attributes and _is_named(tag, attributes):
                enter(tag, attributes, bare, True)
            elif opened[tag] and (same := _open_inline(node, tag)) is not None:
                same.depth += 1
            continue
        flush()
        if tag in _CLOSES_P and opened["p"]:
            up = node
            while up is not None and up.tag not in ("p", "article", "main", "div", "section", "td", "th", "li", "body"):
                up = up.parent
            if up is not None and up.tag == "p":
                close(up.parent)
        if tag in _SAME and any(opened[t] for t in _SAME[tag][0]):
            ends, stops = _SAME[tag]
            up, outer = node, None
            while up is not None and up.tag not in stops:
                if up.tag in ends:
                    outer = up
                up = up.parent
            if outer is not None:
                close(outer.parent)
        enter(tag, attributes, _is_bare(tag, attributes, node.inside))
    flush()
    _bar_named(nodes, flushed)
    for item in nodes:
        item.barred = item.bare or item.parent is not None and item.parent.barred
    blocks = [block for pieces in flushed for block in _split_block(pieces)]
    # A node stands after its parent, so children are done first.
    for item in reversed(nodes):
        parts = "\x00".join(p if isinstance(p, str) else str(p.digest) for p in item.parts)
        item.digest = _hash(f"{item.tag}\x01{parts}")
    return blocks, nodes


def _subtrees(blocks: list[tuple[str, _Node, bool]], nodes: list[_Node]) -> tuple[list[int], list[int]]:
    """Digests of the subtrees around blocks that may be templates, and for each the next one around it.

    The page, its article and the article's running text are no templates. Numbers are set in the nodes: their own, or that of
    the next subtree around them.
    """
    around: set[_Node] = set()
    for _, at, _ in blocks:
        while at is not None and at not in around:
            around.add(at)
            at = at.parent
    digests, ups = [], []
    for item in nodes:
        if item.parent is None:
            continue
        item.place = item.parent.place
        running = item.inside and item.tag in _TEXT
        if item in around and item.tag not in ("html", "body", "main", "article") and not running:
            ups.append(item.place)
            item.place = len(digests)
            digests.append(item.digest)
    return digests, ups


_BLOCK = pa.struct([("text", pa.string()), ("node", pa.int32())])
_PARSED = (
    "_id long, _url string, body long, form long, trees array<long>, digests array<long>, ups array<int>, "
    "blocks array<struct<text: string, node: int>>"
)


def parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that may be article text, the subtrees around them, and hashes of the page's text and of its subtrees."""
    for batch in batches:
        bodies, forms, trees, digests, ups, rows = [], [], [], [], [], []
        for page in batch.column("_html"):
            blocks, nodes = parse(page.as_py() or "")
            own, above = _subtrees(blocks, nodes)
            kept = [{"text": text, "node": at.place} for text, at, bare in blocks if not bare]
            words = "\n".join(b["text"] for b in kept)
            bodies.append(_hash(words))
            trees.append(sorted(set(own)))
            forms.append(_hash(str(trees[-1])))
            digests.append(own)
            ups.append(above)
            rows.append(kept)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                batch.column("_url"),
                pa.array(bodies, pa.int64()),
                pa.array(forms, pa.int64()),
                pa.array(trees, pa.list_(pa.int64())),
                pa.array(digests, pa.list_(pa.int64())),
                pa.array(ups, pa.list_(pa.int32())),
                pa.array(rows, pa.list_(_BLOCK)),
            ],
            ["_id", "_url", "body", "form", "trees", "digests", "ups", "blocks"],
        )


def without_templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of the blocks that no template holds, and how many went; a subtree's bar goes down to those in it."""
    for batch in batches:
        texts, gone = [], []
        columns = [batch.column(c).to_pylist() for c in ("digests", "ups", "blocks", "templates")]
        for digests, ups, blocks, templates in zip(*columns, strict=True):
            known = set(templates or ())
            barred: list[bool] = []
            for digest, up in zip(digests, ups, strict=True):
                barred.append(digest in known or up >= 0 and barred[up])
            kept = [b["text"] for b in blocks if b["node"] < 0 or not barred[b["node"]]]
            texts.append("\n\n".join(kept))
            gone.append(len(blocks) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()), pa.array(gone, pa.int64())],
            ["_id", "_url", "text", "gone"],
        )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def host_templates(pages: DataFrame, least: int = TEMPLATE_PAGES) -> DataFrame:
    """(host, form, salt, templates): the recurring subtrees of the pages of a host with equal subtrees.

    A template is on at least ``least`` pages, and on as many as the cube root of the pages of its host: few of
    a large host share a heading or a byline by chance. Pages of equal text count once, by the
    smallest of their forms. All joins are on exploded keys: a row holds the subtrees of one page at most,
    and a subtree or form of many pages is salted.
    """
    counted = pages.groupBy("host", "body").agg(F.min("form").alias("form")).groupBy("host", "form").agg(F.count("*").alias("n"))
    hosts = counted.groupBy("host").agg(F.ceil(F.cbrt(F.sum("n")) - 1e-9).alias("enough"))
    trees = pages.select("host", "form", F.explode("trees").alias("tree")).distinct().withColumn("salt", F.col("form") % SALTS)
    # A subtree's rows merge before the shuffle; it has as many salts as pages at most.
    places = (
        trees.join(counted, ["host", "form"], "left")
        .groupBy("host", "tree")
        .agg(F.sum("n").alias("n"), F.collect_set("salt").alias("salts"))
        .filter(F.col("n") >= least)
    )
    places = places.join(hosts, "host").filter(F.col("n") >= F.col("enough")).select("host", "tree", F.explode("salts").alias("salt"))
    found = trees.join(places, ["host", "tree", "salt"]).groupBy("host", "form").agg(F.collect_list("tree").alias("templates"))
    salts = pages.select("host", "form", "salt").distinct()
    return salts.join(found, ["host", "form"])


def main_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = TEMPLATE_PAGES,
) -> DataFrame:
    """One row per input row: id, url, text, n_chars, n_template_blocks.

    The text is all that is no template of the host and no menu, form and so on, in or beside article
    and main elements. Null and empty pages, and pages of templates alone, have the empty text.
    Pages without url share the empty host. Repeated rows are extracted each. Long pages, deep nesting and unclosed
    quotes take time in proportion to their length.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    parsed = rows.mapInArrow(parse_pages, _PARSED).withColumn("host", host_of(F.col("_url")))
    parsed = parsed.withColumn("salt", F.xxhash64("_id") % SALTS)
    # Hashes are kept from the first pass, texts are parsed once more: they are far larger.
    path = fresh_path(spark, "subtrees")
    parsed.select("host", "body", "form", "salt", "trees").write.parquet(path)
    templates = host_templates(spark.read.parquet(path), least)
    joined = parsed.drop("trees", "body").join(templates, ["host", "form", "salt"], "left")
    rest = joined.select("_id", "_url", "digests", "ups", "blocks", "templates")
    found = rest.mapInArrow(without_templates, "_id long, _url string, text string, gone long")
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_url").alias(url_col),
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.col("gone").alias("n_template_blocks"),
    )
