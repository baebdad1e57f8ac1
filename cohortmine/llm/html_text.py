"""HTML extraction (operator 5): main text of pages by a site style tree.

The pages of one host are merged into a style tree: element nodes by their path of tags and
classes, each with its distinct child sequences (presentation) and texts (content) and how many
distinct pages show them. A node's importance is the larger of the two entropies, each as a
share of the most that its pages allow; a branch that shows the same on nearly all pages says
little and is cut. Elements whose tag, role or class names a menu, header, footer, sidebar,
notice, advert, form, script or comment section are of no importance on any page, unless the
name is one word of a longer one ("no-sidebar") and the element, itself in no article, holds an
article or main. An element named by such a word alone and holding one goes if the page has
another. An article within an article goes if it is named a comment or reply. Inside an
``article`` or ``main`` a template branch is cut if it groups other elements (a list, a section, a
box with blocks in it); a sentence by itself that many pages share stays.

Pages with the same html count once in a host's entropies, so copies do not make their own
article look like a template. Style tree counts aggregate by (host, path, text) with partial
sums: no task holds a host.

Defined cases: null or empty html gives an empty text; unclosed, misnested and truncated markup
is read as far as it goes, in linear time; a ``<`` before a quote that never closes is text; a path of more than
LONG_PATH characters is known below by its hash; a null or odd url belongs to the host ""; repeated rows get equal
results; an empty table gives no rows; other columns are not read, clashing names give way.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, own_columns, read, small_enough

MIN_PAGES = 8         # a style tree node needs as many distinct pages to be judged
MIN_IMPORTANCE = 0.2  # below this share of the largest entropy a branch is cut
BROADCAST_HOSTS = 100_000

# Element names by role.
GROUPS = frozenset("center details dir div dl fieldset figure hgroup ol section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr "
    "ul".split())
CLOSES_P = BLOCK - frozenset("br body head html li td th tr dd dt caption tbody thead tfoot option optgroup title".split())
NOT_TEXT = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe input "
    "label link map math menu meta nav noframes noscript object optgroup option output progress script search "
    "select style svg template textarea title video".split())
CLOSED_BY = {  # an opening tag closes these when they are the innermost of their kind
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "thead": ("thead tbody tfoot tr td th", ("table",)), "tbody": ("thead tbody tfoot tr td th", ("table",)),
    "tfoot": ("thead tbody tfoot tr td th", ("table",)), "option": ("option", ("select",)),
    "body": ("head", ()),
}
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs captcha comment "
    "comments consent cookie cookies disclaimer disqus footer gdpr login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification pager pagination paywall popup promo promotion related "
    "replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored "
    "subscribe subscription toolbar topbar widget widgets".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_OPEN = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_PLAIN = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s+[\w-]+="[^"<>]*")*)>')  # most tags; passes no other <
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LONG_PATH = 1000  # a longer path is written as its hash in the paths below it
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)  # of the hashes of text sequences


class Node:
    """An element: tag, path of tags and classes, whether it is noise, children in order.

    ``named`` is 1 if only a part of a class or id makes it noise, 2 if a whole one does, else 0;
    ``article`` tells that it is an article or within one, ``tagged`` the same of the tag alone.
    ``stem`` is what the paths of its children begin with.
    """

    __slots__ = ("article", "children", "named", "noise", "path", "root", "stem", "tag", "tagged")

    def __init__(self, tag: str, path: str, noise: bool, root: bool = False, named: int = 0, article: bool = False,
                 tagged: bool = False):
        self.tag, self.path, self.noise, self.root, self.named, self.article = tag, path, noise, root, named, article
        self.tagged = tagged
        self.stem = path if len(path) <= LONG_PATH else "#" + xxhash.xxh128_hexdigest(path.encode("utf-8", "surrogatepass"))
        self.children: list[Node | str] = []


def _element(tag: str, attrs: str, parent: Node) -> Node:
    found: dict[str, str] = {}
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    kind = found.get("class", "").split()
    role = found.get("role", "").lower()
    root = tag in ("article", "main") or role in ("main", "article")
    named = 0
    noise = tag in NOT_TEXT or (tag == "header" and not parent.tagged)
    if not noise and found and tag not in ("html", "body"):
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or role in NOISE_ROLES \
                or _HIDDEN.search(found.get("style", "")):
            noise = True
        else:
            names = (*kind, found.get("id", ""))
            words = {w.lower() for x in names for w in _NAMES.findall(x)}
            if root:
                noise = parent.article and bool(words & COMMENT_WORDS)
            else:
                noise = bool(words & NOISE_WORDS) or ("header" in words and not parent.tagged)
                named = noise * (2 if {x.lower() for x in names} & (NOISE_WORDS | {"header"}) else 1)
    name = ".".join([tag, *sorted(kind)])
    article = parent.article or tag == "article" or role == "article"
    return Node(tag, f"{parent.stem}/{name}", noise, root, named, article, parent.tagged or tag == "article")


class _Next:
    """First match of a pattern at or after a place; text between is looked at once."""

    __slots__ = ("at", "found", "pattern", "text")

    def __init__(self, pattern: str, text: str):
        self.pattern, self.text, self.at, self.found = re.compile(pattern), text, 0, -1

    def __call__(self, at: int) -> int:
        if not self.at <= at <= self.found:
            m = self.pattern.search(self.text, at)
            self.at, self.found = at, m.start() if m else len(self.text)
        return self.found


class _Scanner:
    """Tokens of a page, each found in time linear in the text passed over.

    A quote without its closing one ends no tag: the ``<`` before it is text. Every such quote is
    remembered, so no later ``<`` walks the same way again; so is that no ``]]>`` follows.
    """

    def __init__(self, text: str):
        self.text = text
        self.name_end = _Next(r"[\s/>]", text)
        self.stop = _Next(r"[>\"']", text)
        self.lost: set[int] = set()  # quotes from which a tag does not end
        self.cdata = True            # whether a ]]> may follow

    def token(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, kind, tag or text, attributes) of the next token; kinds: open, close, text, skip."""
        text = self.text
        while (m := _OPEN.search(text, at)) is not None:
            start, at = m.start(), m.end()
            if text[at - 1] in "!?":
                return self._declaration(start)
            plain = _PLAIN.match(text, start)
            if plain:
                return start, plain.end(), "close" if plain[1] else "open", plain[2].lower(), plain[3]
            name = at - 1
            closing = text[name - 1] == "/"
            after = self.name_end(name)
            end = self._tag_end(after)
            if end >= 0:
                return (start, min(end + 1, len(text)), "close" if closing else "open",
                        text[name:after].lower(), "" if closing else text[after:end])
        return None

    def _declaration(self, start: int) -> tuple[int, int, str, str, str]:
        text = self.text
        if text.startswith("<!--", start):
            end = text.find("-->", start + 4)
            return start, len(text) if end < 0 else end + 3, "skip", "", ""
        if self.cdata and text.startswith("<![CDATA[", start):
            end = text.find("]]>", start + 9)
            if end >= 0:
                return start, end + 3, "text", text[start + 9:end], ""
            self.cdata = False
        end = text.find(">", start + 2)
        return start, len(text) if end < 0 else end + 1, "skip", "", ""

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag (the text's end if it is cut off), -1 if a quote stays open."""
        text, passed = self.text, []
        while True:
            at = self.stop(at)
            if at == len(text) or text[at] == ">":
                return at
            passed.append(at)
            end = -1 if at in self.lost else text.find(text[at], at + 1)
            if end < 0:
                self.lost.update(passed)
                return -1
            at = end + 1


class _Open:
    """The open elements, outermost first, with the places of each tag."""

    def __init__(self, top: Node):
        self.stack = [top]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, tags) -> int:
        """Place of the innermost element of these tags, 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags, within=()) -> None:
        """Close the innermost element of ``tags`` and all in it, unless one of ``within`` is nearer."""
        at = self.last(tags)
        if at and at > self.last(within):
            for node in reversed(self.stack[at:]):
                self.places[node.tag].pop()
            del self.stack[at:]


def parse(text: str) -> Node:
    """The element tree of a page, in linear time; tolerant of what browsers tolerate."""
    top = Node("", "", False)
    live = _Open(top)
    scan = _Scanner(text)
    at = 0
    while (found := scan.token(at)) is not None:
        start, end, kind, tag, attrs = found
        parent = live.stack[-1]
        if start > at:
            parent.children.append(entities.unescape(text[at:start]))
        at = end
        if kind == "text":
            parent.children.append(tag)
        elif kind == "close":
            if tag == "br":
                parent.children.append(Node("br", parent.stem + "/br", False))
            else:
                live.close((tag,))
        elif kind == "open":
            if tag in CLOSED_BY:
                live.close(CLOSED_BY[tag][0].split(), CLOSED_BY[tag][1])
            if tag in CLOSES_P:
                live.close(("p",), ("table", "button", "object", "td", "th", "caption"))
            parent = live.stack[-1]
            node = _element(tag, attrs, parent)
            parent.children.append(node)
            if tag in RAW:
                stop = re.compile(rf"</{tag}\s*>|\Z", re.I).search(text, at)
                if tag in ("title", "textarea"):
                    node.children.append(entities.unescape(text[at:stop.start()]))
                at = stop.end()
            elif tag not in VOID:
                live.push(node)
    if at < len(text):
        live.stack[-1].children.append(entities.unescape(text[at:]))
    _free(top)
    return top


def _free(top: Node) -> None:
    """Named elements that wrap an article or main are no noise (see the module)."""
    order: list[tuple[Node, int]] = [(top, -1)]  # parents first
    for k, (node, _) in enumerate(order):
        if not node.article and (node.named or not node.noise):
            order += [(c, k) for c in node.children if isinstance(c, Node)]
    holds = [x.root and not x.noise for x, _ in order]
    for k in range(len(order) - 1, 0, -1):
        holds[order[k][1]] |= holds[k]
    if not holds[0]:
        return
    live = [True] * len(order)  # whether no noise is above

    def settle() -> bool:
        for k, (x, up) in enumerate(order):
            live[k] = (up < 0 or live[up]) and not x.noise
        return any(a and x.root for a, (x, _) in zip(live, order, strict=True))

    for least in (1, 2):
        for (x, _), h in zip(order, holds, strict=True):
            if h and x.named == least:
                x.noise = False
        if settle():
            return


def _roots(top: Node) -> list[Node]:
    """Where the main text stands: outermost articles, else main elements, else the page."""
    for tags in ("article", "main"):
        found: list[Node] = []
        stack = [top]
        while stack:
            node = stack.pop()
            if node.noise:
                continue
            if node.tag == tags or (node.root and node.tag not in ("article", "main")):
                found.append(node)
            else:
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]
        if any(_has_text(x) for x in found):
            return found
    return [top]


def _has_text(node: Node) -> bool:
    stack: list[Node | str] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x and not x.isspace():
                return True
        elif not x.noise:
            stack += x.children
    return False


def _groups(node: Node) -> bool:
    """Whether an element groups others, so that entropy may cut it inside an article."""
    return node.tag in GROUPS and any(isinstance(c, Node) and c.tag in BLOCK - VOID for c in node.children)


def blocks(top: Node, cut: frozenset[str] = frozenset()) -> list[str]:
    """Texts of the blocks in page order, white space joined, empty ones left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            line = " ".join("".join(run).split())
            run.clear()
            if line:
                out.append(line)

    for root in _roots(top):
        flush()
        inside = root is not top
        stack: list[Node | str | None] = [root]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                run.append(x)
            elif x.noise or (x is not root and x.path in cut and (not inside or _groups(x))):
                if x.tag in BLOCK:
                    flush()
            elif x.tag in BLOCK:
                flush()
                stack.append(None)
                stack += reversed(x.children)
            else:
                stack += reversed(x.children)
    flush()
    return out


def style_nodes(top: Node) -> dict[str, tuple[int, int]]:
    """path -> (hash of the child sequences, hash of the texts) of a page's elements there.

    The texts of an element are a sequence, those of its children included; sequences are joined by
    their polynomial hashes when an element closes, so a text is read once however deep it stands.
    """
    shape: dict[str, list[str]] = {}
    words: dict[str, tuple[int, int]] = {}
    live: list[tuple[int, int]] = []  # of each open element: hash and power of the base
    stack: list[Node | str | tuple[str]] = list(reversed(top.children))

    def joined(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
        return (a[0] * b[1] + b[0]) % _PRIME, a[1] * b[1] % _PRIME

    while stack:
        x = stack.pop()
        if isinstance(x, str):
            data = " ".join(x.split()).encode("utf-8", "surrogatepass")
            if data and live:
                live[-1] = joined(live[-1], (xxhash.xxh64_intdigest(data) % _PRIME, _BASE))
        elif isinstance(x, tuple):
            value = live.pop()
            words[x[0]] = joined(words[x[0]], value) if x[0] in words else value
            if live:
                live[-1] = joined(live[-1], value)
        elif not x.noise:  # noise is cut anyway
            shape.setdefault(x.path, []).append(",".join(c.tag for c in x.children if isinstance(c, Node)))
            live.append((0, 1))
            stack.append((x.path,))
            stack += reversed(x.children)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return {p: (signed(xxhash.xxh64_intdigest("|".join(s))), words[p][0]) for p, s in shape.items()}


def host_of(url) -> F.Column:
    """Host of an address: lower case, without user, port and a leading www."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(rest), r"^www\.", "")


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, pages, presentation, content): the merged tree with its two entropies.

    Entropies are shares of log2(pages); a node on one page has both at 1.
    """
    schema = "host string, page long, path string, shape long, words long"

    def nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for host, page, text in zip(f["host"], f["page"], f["html"], strict=True):
                rows += [(host, page, p, s, w) for p, (s, w) in style_nodes(parse(text or "")).items()]
            yield pd.DataFrame(rows, columns=["host", "page", "path", "shape", "words"])

    source = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(F.col(html)).alias("page"),
                          F.col(html).cast("string").alias("html"))
    found = source.mapInPandas(nodes, schema).distinct()  # the same page counts once

    def entropy(column: str) -> DataFrame:
        per = found.groupBy("host", "path", column).agg(F.count("*").alias("n"))
        total = per.groupBy("host", "path").agg(
            F.sum("n").alias("pages"), F.sum(F.col("n") * F.log2("n")).alias("s"))
        bits = F.log2("pages") - F.col("s") / F.col("pages")
        share = F.when(F.col("pages") > 1, bits / F.log2("pages")).otherwise(F.lit(1.0))
        return total.select("host", "path", "pages", share.alias(column))

    shape, words = entropy("shape"), entropy("words")
    return shape.join(words.drop("pages"), ["host", "path"]).select(
        "host", "path", "pages", F.col("shape").alias("presentation"), F.col("words").alias("content"))


def cut_paths(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
              min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """(__cut_host, __paths): for each host the paths of low importance (template parts only)."""
    tree = style_tree(pages, url, html)
    low = tree.filter((F.col("pages") >= min_pages) & (F.greatest("presentation", "content") < min_importance)
                      & ~F.col("path").rlike(r"^/html[^/]*(/body[^/]*)?$"))
    return low.groupBy(F.col("host").alias("__cut_host")).agg(F.sort_array(F.collect_list("path")).alias("__paths"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", **limits) -> DataFrame:
    """``pages`` without its html, with ``text`` (blocks joined by a newline) and ``n_chars``."""

    @F.pandas_udf("string")
    def main_text(page: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(blocks(parse(t), frozenset(p) if p is not None else frozenset()))
                          if t else "" for t, p in zip(page, paths, strict=True)], dtype=object)

    cuts = checkpointed(cut_paths(pages, url, html, **limits))
    side = F.broadcast(cuts) if small_enough(cuts, BROADCAST_HOSTS) else cuts
    own = own_columns(pages, (html, "text", "n_chars"))
    placed = pages.select(*own, F.col(html).cast("string").alias("__html")).withColumn("__host", host_of(F.col(url)))
    joined = placed.join(side, F.col("__host") == F.col("__cut_host"), "left")
    return joined.withColumn("text", main_text("__html", "__paths")).select(
        *own, "text", F.length("text").cast("long").alias("n_chars"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
