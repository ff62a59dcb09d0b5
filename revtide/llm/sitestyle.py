"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element node of the tree stands for all elements with the
same path of tags, classes and ids. It counts how its pages fill it: with which child elements (their
presentation) and with which text (the content of all descendants together). If all pages do so alike the
entropy is low, and the branch is boilerplate; if every page does so in its own way, it is content. A branch of low
importance is taken out of the pages that fill it with one of its common texts, so text that only a few pages
have stays, next to those whose role the markup states (menus, footers, forms, ...) or hints at in classes and
ids (adverts, comments, ...), unless they hold a main part, a heading or a good share of the text.
Where a page declares its main part, only what is inside counts, and there only containers, never
paragraphs or headings, can be taken out for their low importance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Set
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import packed, text_batches
from revtide.session import stored

#: A branch less important than this is boilerplate. What few distinct pages show weighs less: to the importance
#: comes the branch's share of its page's text, times this, over the number of its pages.
MIN_IMPORTANCE = 0.2
DOUBT = 1.5
#: Weight of a node's content where all pages present it alike; each further presentation lowers it by this factor.
DECAY = 0.9
#: Share of a branch's pages from which a text of it is common.
COMMON = 0.05
#: Hashes of word sequences are polynomials of this base over the integers modulo this prime.
BASE, PRIME = 0x1B873593CC9E2D51, (1 << 61) - 1

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("div section aside table ul ol dl header details figure center menu".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet svg math canvas audio video map nav footer "
    "aside form button select textarea input datalist menu dialog title xmp noembed noframes".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
    "tablist tooltip status".split()
)
# Words in classes and ids that tell what an element is for.
HINTS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promotion "
    "promoted banner banners nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs crumbs sidebar "
    "sidebars rail widget widgets header masthead topbar toolbar footer foot bottombar colophon copyright cookie "
    "cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter "
    "subscribe subscription signup login register comment comments commentlist disqus respond replies reply "
    "share sharing social related recommended recommendations trending pagination pager skip legal disclaimer "
    "search form hidden".split()
)
# Words that turn around what stands behind or before them: layout classes such as has-sidebar or comments-open.
BEFORE = frozenset("has have with without no not".split())
AFTER = frozenset("open opened closed enabled disabled".split())
# Of these the words that a text's own sections have too; a heading inside speaks against them, but not against the rest.
WEAK = frozenset(
    "banner banners header masthead footer foot copyright notice notices alert alerts overlay register social skip "
    "legal disclaimer search form hidden promotion notification notifications".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A hint counts for an element with less than this share of its page's text, a weak one for less; the share that
#: articles need to be the declared part.
MINOR = 0.8
WEAK_MINOR = 0.5
LEAST_PART = 0.25
#: Elements nested deeper are children of the last one so deep, as in browsers.
MAX_DEPTH = 512

# An open element that a new one closes, and where the search for it ends.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d{3,}")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element of a page; children are elements and texts in order."""

    __slots__ = ("tag", "attrs", "children", "sign", "path", "size", "hint", "holds", "part", "out")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children = tag, attrs, []
        # Characters of text, how strongly names hint at no text, what it holds against that (1: a heading, 2: a title
        # or main part), whether it declares itself a main part, the verdict.
        self.size, self.hint, self.holds, self.part, self.out = 0, 0, 0, False, False
        # Long numbers in names differ from page to page.
        name = " ".join(sorted(attrs.get("class", "").split())) + "#" + attrs.get("id", "")
        self.sign = f"{tag}.{_DIGITS.sub('', name)}" if len(name) > 1 else tag
        self.path = xxhash.xxh64_intdigest(self.sign, parent.path if parent else 0)


class Open(list):
    """The open elements of a page, outermost first, and how many there are of each name."""

    def __init__(self, nodes: list[Node]):
        super().__init__(nodes)
        self.names = Counter()


def attributes(text: str) -> dict[str, str]:
    return {
        m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)
    } if text else {}


def parse(html: str, markup: bool = True) -> Node:
    """The tree of a page, however badly nested its tags are, in time that grows with its length.

    A tag that never ends is text. If the quotes of one are never closed, tags from there on end at the first ``>``.
    Without ``markup`` only elements that never hold text are out.
    """
    root = Node("#root", {}, None)
    stack, deeper = Open([root]), Counter()
    text = at = 0
    close, size, quotes = -1, len(html), True

    def flush(until: int) -> None:
        if until > text:
            stack[-1].children.append(unescape(html[text:until]))

    while at < size:
        start = html.find("<", at)
        if start < 0:
            break
        if html.startswith(("<!", "<?"), start):
            flush(start)
            mark = "-->" if html.startswith("<!--", start) else ">"
            end = html.find(mark, start + 2 * len(mark) - 2)
            text = at = size if end < 0 else end + len(mark)
            continue
        if close < start:
            close = html.find(">", start)
            if close < 0:
                break
        tag = _NAME.match(html, start)
        if tag is None:
            at = start + 1
            continue
        flush(start)
        end, name = close, tag[2].lower()
        if tag[1]:
            text = at = end + 1
            if deeper[name]:
                deeper[name] -= 1
                continue
            if _close(stack, {name}, frozenset()):
                deeper.clear()
            continue
        if quotes:
            end = _tag_end(html, tag.end())
            if end < 0:
                quotes, end = False, close
        text = at = _open(html, end + 1, name, html[tag.end():end], stack, deeper)
    flush(size)
    if markup:
        judge(root)
    else:
        _bare(root)
    return root


def _tag_end(html: str, at: int) -> int:
    """Where the ``>`` of a tag is, outside quotes; -1 if nowhere."""
    while True:
        stop = _STOP.search(html, at)
        if stop is None or stop[0] == ">":
            return stop.start() if stop else -1
        at = html.find(stop[0], stop.end()) + 1
        if at == 0:
            return -1


def _bare(root: Node) -> None:
    """Mark what never holds text; sizes of all else."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.out = node.tag in RAW or node.tag in ("head", "template")
        if not node.out:
            order.append(node)
            stack += [c for c in node.children if not isinstance(c, str)]
    for node in reversed(order):
        node.size = sum(sum(map(len, c.split())) if isinstance(c, str) else c.size for c in node.children)


def _open(html: str, at: int, name: str, attrs: str, stack: Open, deeper: Counter) -> int:
    """Put a new element into the tree; returns where to go on, behind the end of raw text."""
    depth = len(stack)
    if name in BLOCKS:
        _close(stack, {"p"}, {"table", "td", "th", "div", "article", "section", "li", "blockquote", "body"})
    if name in CLOSED_BY:
        _close(stack, *CLOSED_BY[name])
    if name == "body":
        _close(stack, {"head"}, {"body"})
    if len(stack) < depth:
        deeper.clear()
    node = Node(name, attributes(attrs), stack[-1])
    stack[-1].children.append(node)
    if name in RAW:
        end = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(html, at)
        if name in ("textarea", "title"):
            node.children.append(unescape(html[at:end.start() if end else len(html)]))
        close = html.find(">", end.start()) if end else -1
        return close + 1 if close >= 0 else len(html)
    if name not in VOID and not attrs.endswith("/") or name in BLOCKS - VOID:
        if len(stack) < MAX_DEPTH:
            stack.append(node)
            stack.names[name] += 1
        else:
            deeper[name] += 1
    return at


def _close(stack: Open, names: Set[str], until: Set[str]) -> bool:
    """Close the innermost open element of one of the names and all in it, unless one of ``until`` is met before."""
    if not any(stack.names[name] for name in names):
        return False
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in names:
            for node in stack[depth:]:
                stack.names[node.tag] -= 1
            del stack[depth:]
            return True
        if stack[depth].tag in until:
            return False
    return False


def stated(node: Node) -> bool:
    """Whether an element says beyond doubt that it is no part of the text."""
    if node.tag in DROPPED:
        return True
    attrs = node.attrs
    if not attrs or node.tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def hinted(node: Node) -> int:
    """Whether the classes or the id of an element hint that it is no part of the text: 0, 1 (weakly) or 2."""
    attrs = node.attrs
    if not attrs or node.tag in ("html", "body", "main") or node.tag not in BLOCKS and node.tag not in ("span", "a"):
        return 0
    found = 0
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        for word, following in zip(words, [*words[1:], ""]):
            if word in BEFORE:
                break
            if word in HINTS and following not in AFTER:
                found = max(found, 1 if word in WEAK else 2)
    return found


def declared(node: Node) -> bool:
    """Whether an element declares itself a main part."""
    attrs = node.attrs
    return (
        node.tag in ("main", "article") or attrs.get("role", "").lower() == "main"
        or "articlebody" in attrs.get("itemprop", "").lower()
    )


def judge(root: Node) -> None:
    """Mark what is no part of the text: what is stated, and what is hinted and nothing speaks against.

    Against a hint speak a main part, a title (h1) or a good share of the page's text inside the element, against a
    weak one any heading. A heading that is itself hinted and an article within an article (a comment) do not.
    """
    order: list[tuple[Node, bool]] = []
    stack = [(root, False)]
    while stack:
        node, within = stack.pop()
        node.out = stated(node)
        if node.out:
            continue
        node.hint = hinted(node)
        part = node.part = declared(node)
        if part and not (node.hint and within) or node.tag == "h1" and not node.hint:
            node.holds = 2
        elif node.tag in HEADINGS and not node.hint:
            node.holds = 1
        order.append((node, within))
        within = within or part and node.tag == "article"
        stack += [(c, within) for c in node.children if not isinstance(c, str)]
    for node, _ in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.size += sum(map(len, child.split()))
            elif not child.out:
                node.size += child.size
                node.holds = max(node.holds, child.holds)
    for node, _ in order:
        share = MINOR if node.hint > 1 else WEAK_MINOR
        if node.hint > node.holds and node.size < share * root.size:
            node.out = True


def main_parts(root: Node) -> list[Node]:
    """The outermost elements that declare themselves the main part: main elements and articles, in order.

    Parts without text are not it, nor are articles alone that have only a small part of the page's text, hinted
    branches aside.
    """
    parts, stack, outside = [], [root], 0
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            outside += sum(map(len, node.split()))
        elif node.out or node.hint > node.holds and node is not root:
            continue
        elif node.part:
            parts.append(node)
        else:
            stack += reversed(node.children)
    size = sum(n.size for n in parts)
    alone = all(n.tag != "main" and n.attrs.get("role", "").lower() != "main" for n in parts)
    return [] if not size or alone and size < LEAST_PART * (size + outside) else parts


def outline(root: Node) -> tuple[list[str], list[tuple[Node, bool, int, int]]]:
    """The words of a page, and the elements that a site style tree judges.

    An element comes with whether it is inside a declared main part and with its first word and the one behind its
    last. All are blocks, so no word lies across their edges.
    """
    mains = {id(n) for n in main_parts(root)}
    words: list[str] = []
    pieces: list[str] = []
    spans: list[tuple[Node, bool, int, int]] = []
    stack: list = [(root, False)]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            pieces.append(item)
            continue
        if len(item) == 3:
            words += "".join(pieces).split()
            pieces.clear()
            spans.append((*item, len(words)))
            continue
        node, inside = item
        if node.out:
            continue
        inside = inside or id(node) in mains
        if node.tag in CONTAINERS or not inside and node.tag in BLOCKS and node.tag not in ("html", "body"):
            words += "".join(pieces).split()
            pieces.clear()
            stack.append((node, inside, len(words)))
        elif node.tag in BLOCKS or node.tag == "br":
            pieces.append(" ")
            stack.append(" ")
        stack += [c if isinstance(c, str) else (c, inside) for c in reversed(node.children)]
    words += "".join(pieces).split()
    return words, spans


def words_of(nodes: list[Node], low: frozenset[int] | set[int] = frozenset(), inside: bool = False) -> list[str]:
    """Words in order, blocks apart; branches whose path is in ``low`` are left out."""
    pieces: list[str] = []
    stack: list[Node | str] = list(reversed(nodes))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            pieces.append(node)
            continue
        if node.out or node.path in low and (
            node.tag in CONTAINERS or not inside and node.tag not in ("html", "body")
        ):
            continue
        if node.tag in BLOCKS or node.tag == "br":
            pieces.append(" ")
            stack.append(" ")
        stack += reversed(node.children)
    return "".join(pieces).split()


def main_text(html: str | None, common: Mapping[int, float] | None = None, markup: bool = True) -> str:
    """The main text of a page, given the common contents of unimportant paths of its host.

    A content is taken out where it has at most the stated share of the page's text.
    """
    root = parse(html or "", markup)
    low = set()
    if common:
        words, spans = outline(root)
        found = styles(words, spans)
        sizes = Counter()
        for node, *_ in spans:
            sizes[node.path] += node.size
        low = {p for p, (_, content) in found.items() if sizes[p] <= common.get(content, -1.0) * root.size}
    mains = main_parts(root)
    return " ".join(words_of(mains or [root], low, bool(mains)))


def _prefixes(words: list[str]) -> tuple[list[int], list[int]]:
    """Hashes of the first words, for any number of them, and powers of the base."""
    sums, powers = [0], [1]
    for word in words:
        sums.append((sums[-1] * BASE + xxhash.xxh64_intdigest(word)) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    return sums, powers


def styles(words: list[str], spans: list[tuple[Node, bool, int, int]]) -> dict[int, tuple[int, int]]:
    """Presentation and content of every path of a page that has containers, as hashes, from its ``outline``.

    Elements of one path are taken together. The hash of a content is that of a path and its words; all are
    differences of the hashes of the page's beginnings, so nesting costs nothing.
    """
    sums, powers = _prefixes(words)
    shapes: dict[int, dict[str, None]] = {}
    texts: dict[int, list[str]] = {}
    for node, _, start, end in spans:
        signs = dict.fromkeys(c.sign for c in node.children if not isinstance(c, str))
        shapes.setdefault(node.path, {})["\n".join(signs)] = None
        content = (sums[end] - sums[start] * powers[end - start]) % PRIME
        texts.setdefault(node.path, []).append(f"{content} {end - start}")
    digest = xxhash.xxh64_intdigest
    return {p: (digest("\n\n".join(shapes[p])), digest("\n".join(t), p)) for p, t in texts.items()}


def page_hash(words: list[str], found: dict[int, tuple[int, int]]) -> int:
    """What a page shows; copies that differ in scripts, attributes or stated branches only are one page."""
    shown = " ".join(words)
    return xxhash.xxh64_intdigest("\n".join([shown, *(f"{p} {w}" for p, (_, w) in sorted(found.items()))]))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _styles(frames: Iterator[pd.DataFrame], markup: bool) -> Iterator[pd.DataFrame]:
    """A row per page that has containers; of equal pages of a host in one batch, one."""
    for frame in frames:
        pages = {}
        for host, html in zip(frame["host"], frame["html"]):
            words, spans = outline(parse(html or "", markup))
            found = styles(words, spans)
            if found:
                pages[host, _signed(page_hash(words, found))] = [
                    {"path": _signed(p), "shape": _signed(s), "words": _signed(w)} for p, (s, w) in found.items()
                ]
        if pages:
            yield pd.DataFrame([(*key, f) for key, f in pages.items()], columns=["host", "page", "found"])


def style_counts(pages: DataFrame, markup: bool = True) -> DataFrame:
    """(host, path, kind, value, n): distinct pages of a host per presentation (kind shape) and content (kind words)
    of a path, from rows of (host, html).

    Copies of a page count once. Pages are dealt by host and hash with a few numbers per container, then
    a task sums up its own pages before anything else is shuffled, so a host with most of the pages is no larger
    than its tree times the number of tasks.
    """
    rows = pages.mapInPandas(
        lambda frames: _styles(frames, markup), "host string, page long, found array<struct<path:long, shape:long, words:long>>"
    )
    once = rows.groupBy("host", "page").agg(F.first("found").alias("found")).select("host", F.inline("found"))
    each = once.select("host", "path", F.stack(
        F.lit(2), F.lit("shape"), F.col("shape"), F.lit("words"), F.col("words")
    ).alias("kind", "value"))
    return stored(each.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n")), "styles")


def style_tree(counts: DataFrame) -> DataFrame:
    """The merged tree of every host: (host, path, pages, importance).

    The entropy of a kind is 0 if all pages are alike and 1 if all are different. Importance joins both, the
    presentation's with weight 1 - DECAY^presentations, and is never below that of the content: a branch
    that every page fills with a text of its own is important however alike the pages present it.
    """
    total = counts.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"), F.count("*").alias("values")
    )
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(1.0)
    of = lambda kind, value: F.max(F.when(F.col("kind") == kind, value))
    both = total.groupBy("host", "path").agg(
        F.max("m").alias("pages"), of("shape", entropy).alias("shape"), of("words", entropy).alias("words"),
        of("shape", F.col("values")).alias("values"),
    )
    content = F.pow(F.lit(DECAY), F.col("values"))
    joined = (1 - content) * F.col("shape") + content * F.col("words")
    return both.select("host", "path", "pages", F.greatest("words", joined).alias("importance"))


def host_of(url) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))


def extracted(
    df: DataFrame, html: str = "html", url: str = "url", min_importance: float = MIN_IMPORTANCE, markup: bool = True
) -> DataFrame:
    """``row`` (all columns of ``df``) and ``text``, the main text of each page.

    A null or empty page has an empty text; pages whose url is null or has no host are one host. Equal
    pages count once in the tree. A branch goes if its importance, and its share of the page's text times ``DOUBT``
    over its pages, stay below ``min_importance`` together, so the fewer pages show it the less of a page can go.
    Without ``markup`` the tree alone judges, whatever tags, classes and ids state. The common contents of a host's
    unimportant paths are few, a list per host; pages move only if those lists together are too large to
    broadcast within Spark's own threshold.
    """
    text_batches(df.sparkSession)
    pages = packed(df, host=host_of(df[url]), html=df[html])
    counts = style_counts(pages.select("host", "html"), markup)
    share = (F.lit(min_importance) - F.col("importance")) * F.col("pages") / DOUBT
    dull = style_tree(counts).withColumn("share", share).filter("pages > 1 and share > 0")
    each = counts.filter("kind = 'words'").join(stored(dull, "dull"), ["host", "path"])
    each = each.filter((F.col("n") > 1) & (F.col("n") >= COMMON * F.col("pages")))
    limits = F.sort_array(F.collect_list(F.struct("value", "share")))
    common = each.groupBy(F.col("host").alias("of")).agg(limits.alias("limits")).select(
        "of", F.col("limits.value").alias("common"), F.col("limits.share").alias("shares"))
    common = stored(common, "unimportant")
    found = pages.join(common, pages["host"] == common["of"], "left").select("row", "html", "common", "shares")

    @F.pandas_udf("string")
    def text(htmls: pd.Series, commons: pd.Series, shares: pd.Series) -> pd.Series:
        def known(values, limits) -> dict[int, float]:
            return {} if values is None else {v % (1 << 64): s for v, s in zip(values.tolist(), limits.tolist())}

        return pd.Series(
            [main_text(h, known(c, s), markup) for h, c, s in zip(htmls, commons, shares)], dtype=object
        )

    return found.select("row", text("html", "common", "shares").alias("text"))
