"""Main text of web pages by site template removal.

Pages are parsed into element trees. Every block element outside running text
(lists, navigation, boxes, sections, tables) is hashed as a subtree: its name,
the words in it and its children. Spark counts, per host, how many pages with
different articles hold the same subtree; a subtree that recurs on a share of them
belongs to the site, not to the page, and is deleted. Copies of one page count
once, so that a page's own text isn't taken for a template because it was
published twice. Lists and tables inside an article are its text, whatever they share with
others, and are never counted. On hosts with few pages, where nothing can recur, the names and
classes of elements tell what isn't part of the article; inside it, only those of boxes do.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

#: A subtree is a template if it is on this share of a host's pages (with different articles), and on so many at least.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.2, 5

# Names of HTML elements, and words of class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
NOISE = frozenset("head nav footer aside form script style noscript template iframe button select textarea option"
                  " object svg canvas audio video dialog menu title".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption"
                   " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section"
                   " summary table tbody td tfoot th thead tr ul caption".split())
#: Elements of running text: never counted, so that a sentence that many articles share stays.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt td th figcaption caption article main body html".split())
#: Text of an article too, where they stand inside one.
LISTS = frozenset("ul ol li dl menu table thead tbody tfoot tr".split())
#: Elements that a class or id can tell to be noise inside an article: boxes, by a whole word of theirs.
BOXES = frozenset("div aside nav ul ol dl table iframe figure header footer".split())
#: An opening tag of these ends an open paragraph; the closing tag of a block ends whatever is open in it.
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption html body summary figcaption".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
                        " banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar"
                        " toolbar cookie cookies consent gdpr notice notices notification popup modal newsletter"
                        " subscribe signup login comment comments disqus respond replies reply share sharing social"
                        " related recommended pagination pager skip hidden".split())
#: Page headers; a header inside the article holds its title and stays.
PAGE_HEADERS = frozenset(("header",))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
                  re.S)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_UNSEEN = re.compile(r"""(?<![\w-])style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_WORD = re.compile(r"[a-zA-Z]+")
_PAGE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search"))
#: A class such as no-sidebar tells of what isn't there, or of the layout.
_NOT = frozenset(("no", "has", "with", "without", "is", "not"))


class Node:
    __slots__ = ("name", "noise", "inside", "children")

    def __init__(self, name: str, noise: bool = False):
        self.name, self.noise, self.inside, self.children = name, noise, False, []


def _is_noise(name: str, attributes: str, inside: bool = False) -> bool:
    """Whether an element's name, class, id or role tells that it isn't text of the page; ``inside`` an article, words of
    paragraphs, headings and sections are names of their subject (an id such as related-work) and tell nothing."""
    if name in NOISE:
        return True
    if not attributes or name in ("html", "body", "main", "article"):
        return False
    for m in _NAMES.finditer(attributes):
        value = (m[1] or m[2] or m[3] or "").lower()
        if value in _PAGE_ROLES:
            return True
        for token in value.split():
            if inside:
                if name in BOXES and token in NOISE_WORDS:
                    return True
                continue
            names = _WORD.findall(token)
            if names and names[0] not in _NOT and not NOISE_WORDS.isdisjoint(names):
                return True
    return bool(_HIDDEN.search(_QUOTED.sub("", attributes)) or _UNSEEN.search(attributes))


def parse(source: str) -> Node:
    """The element tree; text nodes are strings with character references decoded.

    Lenient, as browsers are: a block ends an open paragraph, a closing tag ends all that is open inside
    its element and is ignored where there is none, and what is left open ends with the page."""
    root = Node("#root")
    stack, at = [root], 0
    size = len(source)
    while at < size:
        m = _TAG.search(source, at)
        cut = m.start() if m else size
        if cut > at:
            stack[-1].children.append(html.unescape(source[at:cut]))
        if not m:
            break
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].name in ("article", "main", "body", "table") and name not in BLOCKS:
                    break
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    del stack[k:]
                    break
                if stack[k].name in BLOCKS:
                    break
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(name, (name,))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in same:
                    del stack[k:]
                    break
                if stack[k].name in ("ul", "ol", "dl", "table", "select", "menu", "div", "article", "body"):
                    break
        node = Node(name, _is_noise(name, m[3], stack[-1].inside))
        node.inside = stack[-1].inside or name in ("article", "main")
        stack[-1].children.append(node)
        if name in VOID or m[3].endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(source, at)
            node.children.append(source[at:end.start() if end else size])
            at = end.end() if end else size
        else:
            stack.append(node)
    return root


def _content(root: Node) -> tuple[list[Node], bool]:
    """The outermost articles outside noise, else the outermost main elements, else the page; and whether
    there is such an element."""
    for name in ("article", "main"):
        found: list[Node] = []
        queue = [root]
        while queue:
            node = queue.pop()
            if node.name == name:
                found.append(node)
            elif not node.noise:
                queue.extend(reversed([c for c in node.children if isinstance(c, Node)]))
        if found:
            return found, True
    return [root], False


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def subtrees(root: Node) -> dict[int, int]:
    """Hash of each countable subtree, by the identity of its node."""
    out: dict[int, int] = {}
    # children before parents, without recursion: pages nest as deep as they like
    order, queue = [], [root]
    while queue:
        node = queue.pop()
        order.append(node)
        queue.extend(c for c in node.children if isinstance(c, Node))
    signs: dict[int, str] = {}
    for node in reversed(order):
        parts = [node.name]
        for c in node.children:
            parts.append(signs.pop(id(c)) if isinstance(c, Node) else " ".join(c.split()))
        sign = "\x01".join(parts)
        h = _digest(sign)
        signs[id(node)] = f"\x02{h}"
        if node.name in BLOCKS and node.name not in PROSE and not (node.inside and node.name in LISTS):
            out[id(node)] = h
    return out


Piece = tuple[str, list[int]] | None


def pieces(root: Node, hashes: dict[int, int]) -> list[Piece]:
    """Texts of the content in page order, each with the countable subtrees it is in; None is a block's edge.
    What is noise by name is left out."""
    roots, within = _content(root)
    out: list[Piece] = []
    for top in roots:
        out.append(None)
        stack: list = [(top, iter(top.children), [])]
        while stack:
            node, rest, own = stack[-1]
            child = next(rest, None)
            if child is None:
                stack.pop()
                if node.name in BLOCKS:
                    out.append(None)
            elif isinstance(child, str):
                out.append((child, own))
            elif child.name == "br":
                out.append((" ", own))
            else:
                if child.name in BLOCKS:
                    out.append(None)
                if not child.noise and (within or child.name not in PAGE_HEADERS):
                    h = hashes.get(id(child))
                    stack.append((child, iter(child.children), own if h is None else [*own, h]))
    return out


def assemble(parts: list[Piece], templates: set[int]) -> str:
    """Blocks joined by line breaks, without the texts that are in a template."""
    blocks: list[str] = []
    current: list[str] = []
    for part in [*parts, None]:
        if part is None:
            text = " ".join("".join(current).split())
            if text:
                blocks.append(text)
            current = []
        elif not templates or templates.isdisjoint(part[1]):
            current.append(part[0])
    return "\n".join(blocks)


COUNTED = "host string, key long, article long, subtree long"
PARSED = "page_id long, url string, key long, parts binary"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees of each page (each once) with the hash of its article's text."""
    for batch in batches:
        hosts, keys, articles, found = [], [], [], []
        for host, key, source in zip(*(batch.column(c).to_pylist() for c in ("host", "key", "html"))):
            root = parse(source)
            hashes = subtrees(root)
            own = set(hashes.values())
            hosts += [host] * len(own)
            keys += [key] * len(own)
            articles += [_digest(assemble(pieces(root, hashes), set()))] * len(own)
            found += own
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (
            keys, articles, found))], names=["host", "key", "article", "subtree"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content of each page as compressed pieces, several times smaller than its source."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        out = []
        for source in batch.column("html").to_pylist():
            root = parse(source)
            out.append(pack(json.dumps(pieces(root, subtrees(root)), ensure_ascii=False).encode(errors="replace")))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "key")), pa.array(out, pa.binary())],
                                         names=["page_id", "url", "key", "parts"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = [assemble(json.loads(unpack(parts)), set(templates or ()))
                 for parts, templates in zip(batch.column("parts").to_pylist(), batch.column("templates").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def site_templates(counted: DataFrame, share: float = TEMPLATE_SHARE, least_pages: int = TEMPLATE_PAGES) -> DataFrame:
    """(host, subtree) of the subtrees that ``share`` of a host's different articles stand beside, and ``least_pages`` of
    them at least. What is kept of a page so doesn't depend on how many pages of the host there are."""
    articles = counted.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    often = (counted.select("host", "subtree", "article").distinct().groupBy("host", "subtree")
             .agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages))
    return often.join(articles, "host").where(F.col("pages") >= F.col("articles") * share).select("host", "subtree")


def extract_main_text(pages: DataFrame, share: float = TEMPLATE_SHARE, least_pages: int = TEMPLATE_PAGES) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html; other columns are ignored).

    Returns page_id, url, text (blocks of the article in page order, one a line, white space in a block
    made one space; empty if there is none) and n_chars. A null or empty html gives an empty text. Pages
    whose url is null or has no host share the empty host. Repeated rows are extracted each, but count
    once for the templates. An empty table gives an empty result.

    Pages are parsed twice: once to count subtrees, which is all that is aggregated (a host may have a
    third of all pages; counts are partial before the shuffle), and once to send the content, packed, to
    the page's own templates, a list no longer than the page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({
        "host": F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))),
        "key": F.xxhash64("url", "html")})
    counted = written(rows.select("host", "key", "html").mapInArrow(_count, COUNTED), "subtrees")
    templates = site_templates(counted, share, least_pages)
    lists = counted.join(templates, ["host", "subtree"]).groupBy("key").agg(F.collect_set("subtree").alias("templates"))
    parsed = rows.select("page_id", "url", "key", "html").mapInArrow(_parse, PARSED)
    return parsed.join(lists, "key", "left").select("page_id", "url", "parts", "templates").mapInArrow(
        _finish, "page_id long, url string, text string, n_chars long")
