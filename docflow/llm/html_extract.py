"""HTML extraction by consensus host paths.

Pass 1 parses every page, scores its containers (characters of text outside links, less what lies in links; a container's
own blocks count in full, those of nested containers in part) and gives the best container's generalised tag-class
path (tag names with all their classes, digits generalised, without positions). Spark sums the votes per host and path, combining before
the shuffle, and each host keeps its best-voted paths (`paths`, three by default); with the votes of all hosts together the same is
done once more for pages whose host's paths do not occur in them. Pass 2 parses every page again and takes the containers on the
winning paths: the host's first path that occurs in the page, else the overall one, else the page's own best.

Within a container menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and comments are left
out: elements that mean these, roles that mean these, and boxes (div, section, lists, tables) whose class has a word for these or whose id is
such a landmark. Words that articles use as well (related, social, search, legal) only take out boxes with more text in links than outside.
Headings and paragraphs never go by their class or id. Block elements are blocks; character references are decoded in each piece of text between
tags; white space inside a block becomes one space; blocks are joined by one line feed.

Parsing is linear in the page: open elements are counted, so that end tags without a start are not looked for, and paths are numbers that
extend their parent's. The winners (a host and its paths) are broadcast only if their measured size is below `max_broadcast_bytes`; beyond
it they are joined by host, with hosts dealt over as many parts as the largest one's pages need.

Defined results: a null or empty html has an empty text; a null url counts as the empty host; repeated rows are extracted
alike; extra columns are ignored; ties of votes go to the path first in order; broken markup is read as far as it goes: unclosed elements end with
their parents, an attribute whose quote never closes ends with its tag at the next `>`.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, materialise, table

PATHS, PART_PAGES = 3, 2_000
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = frozenset("article section main div td body blockquote center #root".split())
#: Elements that never belong to the main text.
_SKIP_TAG = frozenset("nav header footer aside form button select option script style noscript iframe template svg canvas object audio video head title menu dialog textarea input label fieldset".split())
_SKIP_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
#: Elements that a class or an id can take out.
_BOX = frozenset("div section ul ol dl table center span".split())
_SKIP_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|navbar|navigation|menus?|breadcrumbs?|masthead|footer|sidebar\w*|comments?|disqus|respond|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w*|signup|pagination|pager)(?=$|[\s_-])",
    re.I,
)
#: These take out only boxes with more text in links than outside.
_WEAK_WORD = re.compile(r"(?:^|[\s_-])(?:nav|header|foot|side|aside|related|recommend\w*|share|sharing|social|repl(?:y|ies)|login|search|form|skip|toolbar|copyright|legal|disclaimer|tags?|widgets?|links?)(?=$|[\s_-])", re.I)
_SKIP_ID = frozenset("nav navbar navigation menu main-menu header site-header masthead footer site-footer sidebar comments comment-list disqus_thread respond cookie-banner cookie-notice cookies newsletter ad ads banner breadcrumbs pagination".split())
#: What an opening tag closes if it is still open.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SPACES = re.compile(r"\s+")


#: End tags that reach beyond the enclosing article, table or body.
_REACH = frozenset("article table body html div section main".split())
_SCOPE = frozenset("article table body".split())


class Node:
    """An element: `path` numbers its generalised path, `block` is the nearest block element.

    `open` counts the block elements that are open inside the nearest scope, `inline` the others inside the nearest block.
    """

    __slots__ = ("block", "children", "inline", "open", "parent", "path", "skip", "tag", "weak")

    def __init__(self, tag: str, parent: Node | None, path: int, skip: bool, weak: bool):
        self.tag, self.parent, self.path, self.skip, self.weak = tag, parent, path, skip, weak
        self.children: list[Node | str] = []
        self.block = self if tag in _BLOCK else parent.block if parent else None
        self.open: dict[str, int] = {} if parent is None or tag in _SCOPE else parent.open
        self.inline: dict[str, int] = {} if parent is None or tag in _BLOCK else parent.inline

    def counts(self, tag: str) -> dict[str, int]:
        """Where an element with this tag is counted if it opens here."""
        return self.open if tag in _BLOCK else self.inline


class Page:
    """The element tree of a page, and its generalised paths: number of the parent's path and own step -> number."""

    def __init__(self, root: Node, paths: dict[tuple[int, str], int]):
        self.root, self.paths = root, paths

    def path_of(self, node: Node) -> str:
        """Tag names with classes from the body down, digits generalised; positions do not count."""
        steps = {number: key for key, number in self.paths.items()}
        out, at = [], node.path
        while at:
            at, step = steps[at]
            out.append(step)
        return "/".join(reversed(out)) or "body"

    def number_of(self, path: str) -> int | None:
        """The number of a path of another page; None if it does not occur here."""
        at: int | None = 0
        for step in path.split("/") if path != "body" else ():
            at = self.paths.get((at, step))
            if at is None:
                return None
        return at


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


@lru_cache(maxsize=4096)
def _step(tag: str, classes: str) -> str:
    names = sorted({re.sub(r"\d+", "0", c.lower()).replace("/", "_") for c in classes.split()})
    return ".".join([tag.replace("/", "_"), *names])


@lru_cache(maxsize=4096)
def _unwanted(classes: str) -> tuple[bool, bool]:
    return bool(_SKIP_WORD.search(classes)), bool(_WEAK_WORD.search(classes))


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}[^>]*+>", re.I)


def parse(html: str) -> Page:
    """The element tree; text stays as it is written, without character references decoded."""
    root = at = Node("#root", None, 0, False, False)
    paths: dict[tuple[int, str], int] = {}
    total: dict[str, int] = {}
    pos, size = 0, len(html)

    def leave(to: Node) -> Node:
        """Closes all open elements up to and with `to`."""
        x = at
        while True:
            total[x.tag] -= 1
            x.parent.counts(x.tag)[x.tag] -= 1
            if x is to:
                return x.parent
            x = x.parent

    for m in iter(lambda: _TOKEN.search(html, pos), None):
        if m.start() > pos:
            at.children.append(html[pos : m.start()])
        pos = m.end()
        if m[1]:
            tag = m[1].lower()
            # An inline end tag does not close a block, and a block's does not reach beyond its scope.
            if (total if tag in _REACH else at.counts(tag)).get(tag, 0):
                up = at
                while up.tag != tag:
                    up = up.parent
                at = leave(up)
        elif m[2]:
            tag, own = m[2].lower(), _attributes(m[3])
            if tag in _BLOCK:
                closes = _CLOSES.get(tag, ())
                while at.block is not None and (at.block.tag == "p" or at.block.tag in closes):
                    at = leave(at.block)
            classes, name = own.get("class", ""), own.get("id", "")
            skip = tag in _SKIP_TAG or own.get("role", "").lower() in _SKIP_ROLE or "hidden" in own or own.get("aria-hidden") == "true"
            weak = False
            if tag in _BOX and not skip and (classes or name):
                skip, weak = _unwanted(classes)
                skip = skip or name.lower() in _SKIP_ID
            if tag in ("html", "body"):
                path = 0
            else:
                key = (at.path, _step(tag, classes))
                path = paths.setdefault(key, len(paths) + 1)
            node = Node(tag, at, path, skip, weak)
            at.children.append(node)
            if tag in _RAW:
                end = _end_of(tag).search(html, pos)
                if tag not in ("script", "style"):
                    node.children.append(html[pos : end.start() if end else size])
                pos = end.end() if end else size
            elif tag not in _VOID and not m[0].endswith("/>"):
                total[tag] = total.get(tag, 0) + 1
                own_counts = at.counts(tag)
                own_counts[tag] = own_counts.get(tag, 0) + 1
                at = node
    if pos < size:
        at.children.append(html[pos:])
    _settle(root)
    return Page(root, paths)


def _order(node: Node) -> list[Node]:
    """The node and all below it that is not left out, parents first."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if not isinstance(c, str) and not c.skip]
    return order


def _settle(root: Node) -> None:
    """Leaves out the boxes with a weak word that have more text in links than outside."""
    order = _order(root)
    if not any(n.weak for n in order):
        return
    plain: dict[int, int] = {}
    linked: dict[int, int] = {}
    for n in reversed(order):
        a = sum(len(c.strip()) for c in n.children if isinstance(c, str))
        b = 0
        for c in n.children:
            if not isinstance(c, str) and not c.skip:
                a, b = a + plain[id(c)], b + linked[id(c)]
        if n.tag == "a":
            a, b = 0, a + b
        n.skip = n.weak and b > a
        plain[id(n)], linked[id(n)] = a, b


def _scores(root: Node) -> list[tuple[float, Node]]:
    """(score, container) of all containers."""
    plain: dict[int, float] = {}
    linked: dict[int, float] = {}
    out = []
    for n in reversed(_order(root)):
        a = b = 0.0
        for c in n.children:
            if isinstance(c, str):
                a += len(c) if not c.isspace() else 0
            elif not c.skip:
                # Text that another container holds counts a little less than own blocks.
                a += (0.9 if c.tag in _CONTAINER else 1.0) * plain[id(c)]
                b += linked[id(c)]
        if n.tag == "a":
            a, b = 0.0, a + b
        plain[id(n)], linked[id(n)] = a, b
        if n.tag in _CONTAINER:
            out.append(({"article": 1.5, "main": 1.2, "body": 0.6, "#root": 0.6}.get(n.tag, 1.0) * (a - b), n))
    return out


def best_container(page: Page) -> Node | None:
    """Of equal scores the one that stands first in the page."""
    found = max(reversed(_scores(page.root)), key=lambda x: x[0], default=None)
    return found[1] if found and found[0] > 0 else None


def text_of(containers: list[Node]) -> str:
    """The blocks of the containers in page order."""
    blocks: list[str] = []
    own: list[str] = []

    def close():
        text = _SPACES.sub(" ", "".join(own)).strip()
        own.clear()
        if text:
            blocks.append(text)

    for top in containers:
        close()
        todo: list[Node | str | None] = [top]
        while todo:
            n = todo.pop()
            if n is None:
                close()
            elif isinstance(n, str):
                # A reference ends with its piece of text; it does not go on behind a tag.
                own.append(unescape(n) if "&" in n else n)
            elif n.tag in ("br", "wbr"):
                own.append(" " if n.tag == "br" else "")
            elif not n.skip or n is top:
                if n.tag in _BLOCK:
                    close()
                    todo.append(None)
                todo.extend(reversed(n.children))
        close()
    return "\n".join(blocks)


def _on_path(page: Page, path: str) -> list[Node]:
    """The outermost containers on a generalised path, in page order."""
    number = page.number_of(path)
    if number is None:
        return []
    out, todo = [], [page.root]
    while todo:
        n = todo.pop()
        if n.tag in _CONTAINER and n.path == number:
            out.append(n)
        else:
            todo.extend(reversed([c for c in n.children if not isinstance(c, str) and not c.skip]))
    return out


def extract(html: str | None, paths: list[str]) -> str:
    """The main text: of the first path that occurs with text in it, else of the page's own best container."""
    if not html:
        return ""
    page = parse(html)
    for path in paths:
        text = text_of(_on_path(page, path))
        if text:
            return text
    return text_of([best_container(page) or page.root])


def _host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[^/?#]*://([^/?#]*)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): each page's best container votes for its path; page columns host and html."""

    def run(batches):
        for b in chunks(batches, "html"):
            seen: dict[tuple[str, str], int] = {}
            for host, html in zip(col(b, "host").to_pylist(), col(b, "html").to_pylist(), strict=True):
                page = parse(html) if html else None
                found = best_container(page) if page else None
                if found:
                    key = (host, page.path_of(found))
                    seen[key] = seen.get(key, 0) + 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())], ["host", "path", "n"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, n long").groupBy("host", "path").agg(F.sum("n").alias("n"))


def winners(counted: DataFrame, paths: int = PATHS) -> DataFrame:
    """(host, paths): the best-voted paths of each host."""
    best = Window.partitionBy("host").orderBy(F.desc("n"), "path")
    ranked = counted.withColumn("r", F.row_number().over(best)).where(F.col("r") <= paths)
    return ranked.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "path"))), lambda x: x["path"]).alias("paths"))


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", paths: int = PATHS, max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Per row: id, url, text, n_chars. `paths`: how many a host keeps."""
    frame = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")).withColumn("host", _host())
    counted = materialise(votes(frame), "html-votes")
    overall = [r["path"] for r in counted.groupBy("path").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "path").limit(paths).collect()]
    best = materialise(winners(counted, paths), "html-winners")
    size = best.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + F.lit(64)), F.lit(0)).alias("n")).first()["n"]
    if size <= max_broadcast_bytes:
        joined = frame.join(F.broadcast(best), "host", "left")
    else:
        most = counted.groupBy("host").agg(F.sum("n").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        salt = max(1, min(65_536, -(-most // PART_PAGES)))
        salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        joined = frame.withColumn("salt", F.pmod(F.xxhash64("id", "url", F.length("html")), F.lit(salt)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches):
        for b in chunks(batches, "html"):
            text = [extract(h, [*(p or []), *overall]) for h, p in zip(col(b, "html").to_pylist(), col(b, "paths").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([col(b, "id"), col(b, "url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), *T.StructType.fromDDL("url string, text string, n_chars long")])
    return joined.select("id", "url", "html", "paths").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))
