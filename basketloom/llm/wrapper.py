"""Main text of pages by wrapper induction.

A host's wrapper is fitted on up to ``REFERENCES`` of its pages (distinct titles, shortest first; a
documented, bounded sample). Their DOM trees are aligned by simple tree matching: nodes that are the
same in every reference are template, slots that vary hold content. The wrapper keeps the path of
the container that holds the varying text, and the digests of template nodes inside it. Every page
is then cut by its host's wrapper. Slots of menus, adverts and the like vary as well, so elements
that say what they are (by tag, class, id or role) never count as content.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import top_per_key
from .shared import documents, written

REFERENCES = 5
# Share of the varying text that a container must hold to be descended into.
DOMINANT = 0.7

# Element names of the HTML standard, by the part they play here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = set("html body div main article section center table tbody tr td".split())
BLOCKS = CONTAINERS | set(
    "address blockquote caption dd details dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr li nav ol p pre summary tfoot th thead title ul aside br".split()
)
# ``br`` is white space inside its block.
BLOCKS.discard("br")
SKIPPED = set(
    "head title script style noscript template iframe object svg nav header footer aside form button"
    " select input textarea menu dialog".split()
)
SKIPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
SKIPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|comment-?list|cookies?|consent|"
    r"disqus|disclaimer|footer|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|"
    r"pagination|popup|promo\w*|related|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|"
    r"toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
# A start tag of the key closes open elements of the value, up to the nearest container.
CLOSES = {
    **{t: {"p"} for t in BLOCKS},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
BARRIERS = CONTAINERS | {"ul", "ol", "dl", "nav", "header", "footer", "aside", "form", "blockquote"}


class Node:
    __slots__ = ("tag", "name", "skipped", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag = tag
        label = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".strip()
        self.name = f"{tag}.{(attrs.get('class') or '').split()[0]}" if (attrs.get("class") or "").split() else tag
        self.skipped = (
            tag in SKIPPED
            or (attrs.get("role") or "").lower() in SKIPPED_ROLES
            or "hidden" in attrs
            or (tag not in ("html", "body", "article", "main") and bool(SKIPPED_NAMES.search(label)))
        )
        self.children: list[Node | str] = []


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes = CLOSES.get(tag, ())
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in closes:
                del self.open[i:]
                break
            if self.open[i].tag in BARRIERS:
                break
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break
            # The end of an inline element does not close the blocks around it.
            if tag not in BLOCKS and self.open[i].tag in BLOCKS:
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    """DOM tree of a page; broken markup is repaired as far as the elements allow."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def blocks(node: Node, template: set[str] | frozenset = frozenset()) -> list[str]:
    """Texts of the blocks under a node in page order, without skipped and template elements."""
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    # An explicit stack, since pages may nest deeper than Python calls.
    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif item.skipped and item is not node:
            if item.tag in BLOCKS:
                end()
        elif template and item is not node and digest(item) in template:
            end()
        else:
            block = item.tag in BLOCKS
            if block:
                end()
                stack.append(None)
            stack.extend(reversed(item.children))
    end()
    return out


def digest(node: Node) -> str:
    """Digest of an element's name and text."""
    body = "\n".join(blocks(node))
    return hashlib.md5(f"{node.name}\n{body}".encode()).hexdigest()


def elements(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and not c.skipped]


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: size of the largest common top-down tree, and its matched nodes.

    Children are aligned in order by dynamic programming over the sizes of their own matchings.
    """
    if a.name != b.name:
        return 0, []
    x, y = elements(a), elements(b)
    sub = [[match(c, d) if c.name == d.name else (0, []) for d in y] for c in x]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + sub[i][j][0])
    pairs = [(a, b)]
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += sub[i - 1][j - 1][1]
            i, j = i - 1, j - 1
    return best[len(x)][len(y)] + 1, pairs


def induce(pages: list[str]) -> tuple[str, list[str]]:
    """(path of the content's container, digests of template nodes inside it) of one host."""
    trees = [parse(p) for p in pages]
    first = trees[0]
    constant: dict[int, int] = {}
    for other in trees[1:]:
        for a, b in match(first, other)[1]:
            if digest(a) == digest(b):
                constant[id(a)] = constant.get(id(a), 0) + 1
    # Two references may share a passage by chance; what three and more share is template.
    fixed = {k for k, n in constant.items() if n == len(trees) - 1} if len(trees) > 2 else set()

    def varying(node: Node) -> int:
        if id(node) in fixed and node is not first:
            return 0
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        return own + sum(varying(c) for c in elements(node))

    path, node, total = [], first, varying(first)
    while total:
        inner = [c for c in elements(node) if c.tag in CONTAINERS]
        best = max(inner, key=varying, default=None)
        if best is None or varying(best) < DOMINANT * total:
            break
        path.append(best.name)
        node = best
    template = []
    stack = elements(node)
    while stack:
        item = stack.pop()
        if id(item) in fixed and blocks(item):
            template.append(digest(item))
        else:
            stack += elements(item)
    return "/".join(path), sorted(set(template))


def locate(root: Node, path: str) -> Node:
    """The container at ``path``; the article, main or body element of a page that has it not."""
    node = root
    for name in path.split("/") if path else []:
        found = [c for c in elements(node) if c.name == name]
        if not found:
            break
        node = max(found, key=lambda c: len(" ".join(blocks(c)))) if len(found) > 1 else found[0]
    else:
        if path:
            return node
    for tag in ("article", "main", "body"):
        stack, found = [root], []
        while stack:
            item = stack.pop()
            found += [c for c in elements(item) if c.tag == tag]
            stack += elements(item)
        if found:
            return max(found, key=lambda c: len(" ".join(blocks(c))))
    return root


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _fit(pages: pd.DataFrame) -> pd.DataFrame:
    pages = pages.sort_values(["size", "page_id"])
    path, template = induce(pages["html"].to_list())
    return pd.DataFrame({"host": [pages["host"].iloc[0]], "path": [path], "template": [template]})


def wrappers(pages: DataFrame, references: int = REFERENCES) -> DataFrame:
    """(host, path, template) fitted on at most ``references`` pages of every host."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title", 1)
    known = pages.where("html is not null and page_id is not null").select(
        "host", title.alias("title"), F.struct(F.length("html").alias("size"), "page_id").alias("page")
    )
    shortest = known.groupBy("host", "title").agg(F.min("page").alias("page"))
    chosen = top_per_key(shortest, ["host"], [F.col("page"), F.col("title")], references).select(
        F.col("page.page_id").alias("page_id"), "page.size"
    )
    return (
        pages.join(written(chosen, "references"), "page_id")
        .where(F.length("html") == F.col("size"))
        .dropDuplicates(["host", "page_id"])
        .select("host", "page_id", "size", "html")
        .groupBy("host")
        .applyInPandas(_fit, "host string, path string, template array<string>")
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 100):
            part = batch.slice(low, 100)
            texts = []
            for html, path, template in zip(
                *(part.column(c).to_pylist() for c in ("html", "path", "template"))
            ):
                node = locate(parse(html), path or "")
                texts.append(" ".join(blocks(node, frozenset(template or ()))))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )


def extract(pages: DataFrame, references: int = REFERENCES) -> DataFrame:
    """Per page: page_id, url, text.

    Blocks of the content's container in page order, joined by one blank; white space inside a block
    is one blank, character references are decoded. A null or empty page has an empty text; a null
    url belongs to the host ''; pages of a host without a wrapper are cut at their article, main or
    body element; rows that repeat a page come out once each; other columns are ignored.
    """
    keyed = pages.select("page_id", "url", "html", _host().alias("host"))
    fitted = written(wrappers(keyed, references), "wrappers")
    return keyed.join(fitted, "host", "left").select(
        "page_id", "url", "html", "path", "template"
    ).mapInArrow(_apply, "page_id long, url string, text string")


def op7_wrapper(spark, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


# No SQL states tree matching; tests cut planted pages whose main text is known.
QUERIES = {"op7_wrapper": op7_wrapper}
ORACLES: dict[str, str] = {}
