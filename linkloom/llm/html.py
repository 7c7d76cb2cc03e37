"""Main text of web pages, by site template removal.

Every page is parsed into a tree; scripts, styles and other elements without running text are not part of it.  All subtrees of block
elements, whatever they are named, are hashed and counted per host in Spark; those found on at least MANY pages and SHARE of a host's
pages, or on at least ENOUGH pages
of a host of any size, are its templates and are deleted; for single cells and list items, which data
repeats too, only the share counts.  Pages of a host with the same main text count as one, for its copies are
content; headings, paragraphs and lists inside an article stay, and so does a subtree
that holds over HALF of its article's text, or over WHOLE of a page without article and main.

What a page doesn't share with others can't recur: forms, and elements that HTML itself names as navigation, header, footer or aside, or whose
role, class or id consists of words for boilerplate alone (adverts and reader comments differ from page to page), are deleted too.  A longer name
that merely holds such a word (`related-work`) is no mark, and inside an article paragraphs, headings and lists go for adverts and comments only.

What is left of the articles (else of main, else of the body) is cut into
blocks: character references decoded, white space inside a block one space, blocks joined by an empty line.

The templates are broadcast if all hosts' together have at most BROADCAST entries. Otherwise the hashes of each page are joined to them, with
the pages of a host dealt to SALTS parts, and a page meets those of its own that are templates.

Edge cases: null or empty html gives an empty text; unclosed and crossing tags, comments and truncated pages are
read as far as they go; nesting of any depth is read without recursion, in time linear in the page; pages without a host have no
templates; repeated rows are pages of their own; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import batches_of, checkpoint, values, written

MANY, SHARE, BROADCAST, SALTS = 4, 0.3, 500_000, 64
HALF, WHOLE = 0.5, 0.8
#: Distinct pages that make a template on a host of any size.
ENOUGH = 50

# Element names by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
NO_TEXT = frozenset("head template svg math button select option object canvas audio video dialog menu label input".split())
STRUCTURE = frozenset("nav footer aside".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption html option summary tbody td tfoot th thead tr".split())
PARTS = frozenset("li dt dd td th tr caption figcaption".split())
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption caption article main body html".split())
FRAME = ("article", "main", "body", "html")
#: Elements that end an open one of their kind, and those that such an end doesn't reach through.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = ("ul", "ol", "dl", "table", "div", "article", "main")

# Words of class, id and role that mark boilerplate, those that do so inside an article's paragraphs too, and words that may stand beside them.
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets contentinfo complementary search masthead".split())
SURE = frozenset("ad ads adv advert adverts advertisement advertising comment comments sponsored".split())
BESIDE = frozenset("area articles bar block body bottom box button buttons container content form global header icons inner item items left link links list main media message mobile outer overlay page panel post posts primary reply right secondary section signup site slot text thread top unit user wrap wrapper zone".split())

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|[^<]+|<""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>/=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"'>]*display\s*:\s*none)""", re.I)
_PARTS = re.compile(r"[a-z]+")
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: How an element goes: not by its name; as boilerplate that HTML or its marks name; as a form, unless it holds the page.
STAYS, MARKED, FORM = 0, 1, 2


class Node:
    __slots__ = ("tag", "marks", "children", "inside", "digest", "size", "goes")

    def __init__(self, tag: str, marks: str = "", inside: bool = False, goes: int = STAYS):
        self.tag, self.marks, self.inside, self.goes = tag, marks, inside, goes
        self.children: list = []
        self.digest = 0
        self.size = 0


def names_boilerplate(mark: str, words: frozenset[str] = BOILERPLATE) -> bool:
    """Whether a class, id or role is made of boilerplate words and those that stand beside them only."""
    parts = _PARTS.findall(_CASE.sub(" ", mark).lower())
    return not words.isdisjoint(parts) and all(x in BOILERPLATE or x in BESIDE for x in parts)


def _read_marks(tag: str, raw: str, inside: bool) -> tuple[str, int]:
    """An element's marks, and how it goes. inside: an article or main."""
    if "=" not in raw and "hidden" not in raw:
        marks: list[str] = []
    else:
        marks = [m for _, a, b, c in _MARK.findall(raw) for m in (a or b or c).split()]
    every = " ".join(marks).lower()
    if tag in NO_TEXT or tag in STRUCTURE or tag == "header" and not inside:
        return every, MARKED
    if tag == "form":
        return every, FORM
    if tag in FRAME:
        return every, MARKED if tag == "article" and any(names_boilerplate(m, SURE) for m in marks) else STAYS
    words = SURE if inside and tag in CONTENT else BOILERPLATE
    return every, MARKED if any(names_boilerplate(m, words) for m in marks) or _HIDDEN.search(raw) else STAYS


class _Open:
    """The open elements, with the places of each tag, so that none is searched for."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def last(self, *tags: str) -> int:
        return max((x[-1] for t in tags if (x := self.at.get(t))), default=-1)

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Ends the element at the place and all inside it."""
        while len(self.nodes) > place:
            tag = self.nodes.pop().tag
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()


def parse(text: str) -> Node:
    """The tree of a page; texts are children of type str."""
    root = Node("")
    open_ = _Open(root)
    at, size = 0, len(text)
    while at < size:
        m = _TOKEN.match(text, at)
        token, at = m[0], m.end()
        if token[0] != "<" or len(token) == 1:
            open_.nodes[-1].children.append(token)
            continue
        name = _NAME.match(token)
        if not name:
            continue
        tag = name[1].lower()
        if token[1] == "/":
            place = open_.last(tag)
            if place > 0 and (tag in (*FRAME, "table", "tr", "td") or place > open_.last("article", "main", "td", "body")):
                open_.close(place)
            continue
        closed = tag in VOID or token.endswith("/>") and tag not in BLOCK and tag not in RAW
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(text, at)
            at = text.find(">", end.end()) + 1 if end else size
            at = at or size
            continue
        if tag in FRAME[:3] and (place := open_.last("head")) > 0:
            open_.close(place)  # an unclosed head
        if tag in CLOSES_P and open_.blocks and open_.nodes[open_.blocks[-1]].tag == "p":
            open_.close(open_.blocks[-1])
        if tag in SAME and (place := open_.last(*SAME[tag])) > open_.last(*HOLDS):
            open_.close(place)
        inside = open_.nodes[-1].inside or tag in ("article", "main")
        marks, goes = _read_marks(tag, token, inside)
        node = Node(tag, marks, inside, goes)
        open_.nodes[-1].children.append(node)
        if not closed:
            open_.push(node)
    return root


def _ordered(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, front = [], [root]
    while front:
        node = front.pop()
        out.append(node)
        front += [c for c in reversed(node.children) if type(c) is not str]
    return out


def hashes(root: Node) -> dict[int, bool]:
    """Sets each node's digest and characters, and returns those of the subtrees that a template may delete, and whether each is a cell or list item."""
    out = {}
    for node in reversed(_ordered(root)):
        own = xxhash.xxh64(f"{node.tag} {node.marks}")
        full = False
        node.size = 0
        for c in node.children:
            if type(c) is str:
                if own_text := " ".join(c.split()):
                    own.update("\0" + own_text)
                    full = True
                    node.size += len(own_text)
            else:
                node.size += c.size
                own.update(c.digest.to_bytes(8, "little", signed=True))
                full = True
        node.digest = own.intdigest() - (1 << 63)
        if full and node.tag in BLOCK and not (node.tag in FRAME or node.inside and node.tag in CONTENT):
            out[node.digest] = node.tag in PARTS
    return out


def _tops(root: Node) -> list[Node]:
    """The outermost articles, else main elements, else the body, else the page."""
    for name in ("article", "main", "body"):
        found: list[Node] = []
        front = [root]
        while front:
            node = front.pop()
            if node.tag == name and node.goes == STAYS:
                found.append(node)
            elif node.goes != MARKED:
                front += [c for c in reversed(node.children) if type(c) is not str]
        if found:
            return found
    return [root]


def blocks(root: Node, templates: frozenset[int] = frozenset()) -> list[str]:
    """The texts of the blocks left, in page order; hashes(root) must have been called."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        if now:
            text = " ".join(entities.unescape("".join(now)).split())
            if text:
                out.append(text)
            now.clear()

    for top in _tops(root):
        spared = top.size * (HALF if top.tag in ("article", "main") else WHOLE)
        front: list = [top]
        while front:
            x = front.pop()
            if type(x) is str:
                now.append(x)
            elif x is None:
                flush()
            elif x.tag == "br":
                now.append(" ")
            elif x.goes == MARKED or x.goes == FORM and x.size <= spared:
                if x.tag in BLOCK:
                    flush()
            elif x.digest in templates and x.tag in BLOCK and x is not top and not (x.inside and x.tag in CONTENT) and x.size <= spared:
                flush()
            elif x.tag in BLOCK:
                flush()
                front.append(None)
                front += reversed(x.children)
            else:
                front += reversed(x.children)
        flush()
    return out


def text_of(page: str | None, templates: frozenset[int] = frozenset()) -> str:
    root = parse(page or "")
    hashes(root)
    return "\n\n".join(blocks(root, templates))


def host_of(url) -> F.Column:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def templates(df: DataFrame) -> DataFrame:
    """host, h: the hashes of each host's template subtrees, a row for each."""
    rows = df.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in batches:
                for host, page in zip(values(b.column(0)), values(b.column(1))):
                    root = parse(page or "")
                    found = hashes(root)
                    own = xxhash.xxh64("\n\n".join(blocks(root))).intdigest() - (1 << 63)
                    yield host, own, None, False  # the page itself
                    for h, part in found.items():
                        yield host, own, h, part

        yield from batches_of(out(), pa.schema([("host", pa.string()), ("page", pa.int64()), ("h", pa.int64()), ("part", pa.bool_())]), 65536)

    found = rows.mapInArrow(run, "host string, page long, h long, part boolean").distinct().groupBy("host", "h", "part").agg(F.count("*").alias("n")).where("h IS NULL OR n >= %d" % MANY)
    found = checkpoint(found)
    pages = found.where("h IS NULL").select("host", F.col("n").alias("pages"))
    times = found.where("h IS NOT NULL")
    return times.join(pages, "host").where((F.col("n") >= SHARE * F.col("pages")) | ~F.col("part") & (F.col("n") >= ENOUGH)).select("host", "h").distinct()


def _found(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows (written, with rid) with found, the template hashes among a page's own: no list grows with a host."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in batches:
                for rid, host, page in zip(*(values(c) for c in b.columns)):
                    for h in hashes(parse(page or "")):
                        yield rid, host, h

        yield from batches_of(out(), pa.schema([("rid", pa.int64()), ("host", pa.string()), ("h", pa.int64())]), 65536)

    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = rows.where("host IS NOT NULL").select("rid", "host", "html").mapInArrow(own, "rid long, host string, h long").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    hits = each.join(salted, ["host", "h", "salt"]).groupBy("rid").agg(F.collect_list("h").alias("found"))
    return rows.join(hits, "rid", "left")


def extract(df: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of page_id, url, html."""
    known = checkpoint(templates(df))
    rows = df.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    sent = None
    if known.count() <= BROADCAST:
        by: dict[str, list[int]] = {}
        for r in known.toLocalIterator():
            by.setdefault(r["host"], []).append(r["h"])
        sent = df.sparkSession.sparkContext.broadcast({host: frozenset(own) for host, own in by.items()})  # at most BROADCAST hashes
        rows = rows.select("page_id", "url", "html", "host")
    else:
        rows = _found(written(rows.withColumn("rid", F.monotonically_increasing_id())), known).select("page_id", "url", "html", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in batches:
                for page_id, url, page, found in zip(*(values(c) for c in b.columns)):
                    text = text_of(page, sent.value.get(found, frozenset()) if sent else frozenset(found or ()))
                    yield page_id, url, text, len(text)

        yield from batches_of(out(), pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]))

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
