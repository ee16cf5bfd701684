"""Selectors over parsed pages: tag, class, id and attribute tests, descendants and children.

A page is parsed once into a small tree, and all selectors of its source run over that. Selectors
are compiled once a worker.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache
from html import escape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .python import small_batches

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Opening one of these closes an open one of the same group, as their end tags may be left out.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_HOLDS = frozenset(("ul", "ol", "dl", "table", "select", "div", "article", "section", "body", "html"))


class Node:
    """An element: its tag, attributes, parent, and children (elements and texts) in order."""

    __slots__ = ("tag", "attrs", "classes", "parent", "children", "begin", "end")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = frozenset(attrs.get("class", "").split())
        self.children: list[Node | str] = []
        #: Where its content stands in the page; an element without an end tag ends with what closes it.
        self.begin = self.end = 0

    def elements(self):  # noqa: ANN201
        """All elements below, in document order."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def texts(self, dropped: frozenset[int] = frozenset()):  # noqa: ANN201
        stack: list[Node | str] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif id(x) not in dropped:
                stack.extend(reversed(x.children))

    def html(self, dropped: frozenset[int] = frozenset()) -> str:
        out: list[str] = []
        stack: list[Node | str | tuple[str]] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                out.append(x[0])
            elif isinstance(x, str):
                out.append(escape(x, quote=False))
            elif id(x) not in dropped:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in x.attrs.items())
                out.append(f"<{x.tag}{attrs}>")
                if x.tag not in VOID:
                    stack.append((f"</{x.tag}>",))
                    stack.extend(reversed(x.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.at = self.root
        self._lines = [0, *(m.end() for m in re.finditer("\n", html))]
        self._length = len(html)
        self.feed(html)
        self.close()
        self._up_to(self.root, self._length)
        self.root.end = self._length

    def _here(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _up_to(self, node: Node, end: int) -> None:
        """Close what is open below ``node``; its content ends here."""
        while self.at is not node:
            self.at.end = end
            self.at = self.at.parent

    def _close(self, tags: tuple[str, ...]) -> None:
        """Close the nearest open element of ``tags``, unless something that holds one is nearer."""
        node = self.at
        while node.parent is not None and node.tag not in tags:
            if node.tag in _HOLDS:
                return
            node = node.parent
        if node.parent is not None:
            self._up_to(node.parent, self._here())

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _ENDS_P:
            self._close(("p",))
        for _ in range(2 if tag == "tr" else 1):
            if tag in _CLOSES:
                self._close(_CLOSES[tag])
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        node.begin = node.end = self._here() + len(self.get_starttag_text() or "")
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self._up_to(node.parent, self._here())

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page under a root without a tag; what isn't closed ends with its parent."""
    return _Builder(html or "").root


@dataclass(frozen=True)
class Compound:
    """Tests that one element must meet, and how it stands to the compound before."""

    child: bool = False
    tag: str | None = None
    ids: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    attributes: tuple[tuple[str, str, str], ...] = field(default=())

    def fits(self, node: Node) -> bool:
        if self.tag is not None and node.tag != self.tag or not node.classes.issuperset(self.classes):
            return False
        return all(node.attrs.get("id") == i for i in self.ids) and all(_attribute(node, *a) for a in self.attributes)


def _attribute(node: Node, name: str, operator: str, value: str) -> bool:
    have = node.attrs.get(name)
    if have is None:
        return False
    match operator:
        case "":
            return True
        case "=":
            return have == value
        case "^=":
            return bool(value) and have.startswith(value)
        case "$=":
            return bool(value) and have.endswith(value)
        case "*=":
            return bool(value) and value in have
        case "~=":
            return value in have.split()
        case _:
            return have == value or have.startswith(f"{value}-")


_NAME = r"-?[A-Za-z_][\w-]*"
_TOKEN = re.compile(
    rf"""(?P<comma>\s*,\s*)|(?P<child>\s*>\s*)|(?P<space>\s+)|(?P<any>\*)|(?P<tag>{_NAME})|\#(?P<id>[\w-]+)|\.(?P<class>{_NAME})"""
    rf"""|\[\s*(?P<attr>{_NAME})\s*(?:(?P<op>[\^$*~|]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]"""
)


@lru_cache(maxsize=4096)
def compiled(selector: str) -> tuple[tuple[Compound, ...], ...]:
    """The alternatives of a selector, each as compounds from the outermost to the one selected.

    A selector that isn't understood is an error, so that a wrong one isn't taken for no match.
    """
    alternatives: list[tuple[Compound, ...]] = []
    chain: list[Compound] = []
    now: dict | None = None
    child = False
    at, text = 0, selector.strip()

    def end() -> None:
        nonlocal now, child
        if now is None:
            raise ValueError(f"selector {selector!r}: nothing before position {at}")
        chain.append(Compound(child, now["tag"], tuple(now["ids"]), tuple(now["classes"]), tuple(now["attributes"])))
        now, child = None, False

    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"selector {selector!r}: not understood at {text[at:]!r}")
        kind = m.lastgroup if m["attr"] is None else "attr"
        if kind in ("comma", "child", "space"):
            end()
            if kind == "comma":
                alternatives.append(tuple(chain))
                chain = []
            child = kind == "child"
        else:
            if now is not None and kind in ("tag", "any"):
                raise ValueError(f"selector {selector!r}: not understood at {text[at:]!r}")
            now = now or {"tag": None, "ids": [], "classes": [], "attributes": []}
            if kind == "tag":
                now["tag"] = m["tag"].lower()
            elif kind == "id":
                now["ids"].append(m["id"])
            elif kind == "class":
                now["classes"].append(m["class"])
            elif kind == "attr":
                value = next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), "")
                now["attributes"].append((m["attr"].lower(), m["op"] or "", value))
        at = m.end()
    end()
    return (*alternatives, tuple(chain))


def matches(node: Node, chain: tuple[Compound, ...]) -> bool:
    """Whether an element is selected; ancestors are tried from the nearest outwards."""
    if not chain[-1].fits(node):
        return False
    if len(chain) == 1:
        return True
    above = node.parent
    while above is not None and above.tag:
        if matches(above, chain[:-1]):
            return True
        if chain[-1].child:
            return False
        above = above.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    """The elements that a selector picks, in document order, each once."""
    chains = compiled(selector)
    return [n for n in root.elements() if any(matches(n, c) for c in chains)]


def select_one(root: Node, selector: str) -> Node | None:
    chains = compiled(selector)
    return next((n for n in root.elements() if any(matches(n, c) for c in chains)), None)


def clean(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).split())


def fields(html: str | None, url: str | None, wanted: list[tuple[str, str, str, str | None]]) -> list[tuple[str, str | None, list[str] | None]]:
    """(field, value, values) for each (field, kind, selector, without) over one parse of a page.

    Kinds: ``text`` and ``html`` of the first element picked ('' if none), and ``source``, its
    content as it stands in the page, with all references undecoded; ``links`` (absolute
    href of all picked), ``texts`` (of all, none empty); ``date`` (the datetime attribute, else
    the text; null if nothing is picked); ``attr:name`` of the first. ``without`` selects what is
    left out of an element's text and markup.
    """
    root = parse(html)
    out: list[tuple[str, str | None, list[str] | None]] = []
    for name, kind, selector, without in wanted:
        if kind in ("links", "texts"):
            found = select(root, selector)
            values = [urljoin(url or "", n.attrs["href"]) for n in found if n.attrs.get("href")] if kind == "links" else [t for t in (clean(" ".join(n.texts())) for n in found) if t]
            out.append((name, None, values))
            continue
        node = select_one(root, selector)
        dropped = frozenset(id(n) for n in select(node, without)) if node is not None and without else frozenset()
        if kind == "text":
            value = clean(" ".join(node.texts(dropped))) if node is not None else ""
        elif kind == "html":
            value = node.html(dropped) if node is not None else ""
        elif kind == "source":
            if without:
                raise ValueError("nothing can be left out of a source")
            value = (html or "")[node.begin : node.end] if node is not None else ""
        elif kind == "date":
            value = (node.attrs.get("datetime") or clean("".join(node.texts()))) if node is not None else None
        elif kind.startswith("attr:"):
            value = node.attrs.get(kind[5:]) if node is not None else None
        else:
            raise ValueError(f"unknown kind {kind!r}")
        out.append((name, value, None))
    return out


_S = T.StringType()
_FIELDS = T.ArrayType(T.StructType([T.StructField("field", _S), T.StructField("value", _S), T.StructField("values", T.ArrayType(_S))]))
WANTED = "array<struct<field:string,kind:string,selector:string,without:string>>"


@F.pandas_udf(_FIELDS)
def page_fields(html: pd.Series, url: pd.Series, wanted: pd.Series) -> pd.Series:
    def one(h: str | None, u: str | None, w) -> list[dict]:  # noqa: ANN001
        rows = [] if w is None else [(x["field"], x["kind"], x["selector"], x["without"]) for x in w]
        return [{"field": f, "value": v, "values": vs} for f, v, vs in fields(h, u, rows)]

    return pd.Series([one(*row) for row in zip(html, url, wanted, strict=True)])


def by_field(found: str, column: str) -> Column:
    """What ``page_fields`` found as a map from field to one of its columns, where that has a value."""
    some = F.filter(found, lambda x: x[column].isNotNull())
    return F.map_from_entries(F.transform(some, lambda x: F.struct(x["field"], x[column])))


def extract(pages: DataFrame, selectors: DataFrame) -> DataFrame:
    """``pages`` (source_name, url, html, ...) without html, with the maps ``values`` (field to text,
    markup or date) and ``lists`` (field to links or texts).

    ``selectors`` has a row for each (source_name, field): kind, selector, without. A page whose
    source has none gets empty maps. A source's selectors, a handful, travel with its pages.
    """
    small_batches(pages.sparkSession)
    wanted = selectors.groupBy("source_name").agg(F.array_sort(F.collect_list(F.struct("field", "kind", "selector", F.col("without").cast("string").alias("without")))).alias("_w"))
    found = pages.join(wanted, "source_name", "left").withColumn("_f", page_fields("html", "url", F.coalesce("_w", F.array().cast(WANTED))))

    return found.withColumns({"values": by_field("_f", "value"), "lists": by_field("_f", "values")}).drop("html", "_w", "_f")
