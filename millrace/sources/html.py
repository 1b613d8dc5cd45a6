"""Rows from stored HTML pages: table grids, a table after a label, and cards.

Spark spreads the pages over tasks; a task parses many pages per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Elements without an end tag, and elements that end where the next of their kind starts.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDED_BY = {"li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}


class _Element:
    __slots__ = ("tag", "classes", "attrs", "parent", "children")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []
        self.classes = set((self.attrs.get("class") or "").split())

    def walk(self):
        """Descendant elements in page order."""
        stack = [c for c in reversed(self.children) if isinstance(c, _Element)]
        while stack:
            found = stack.pop()
            yield found
            stack.extend(c for c in reversed(found.children) if isinstance(c, _Element))

    def text(self):
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(parts).strip()

    def matches(self, step):
        tag, *classes = step.split(".")
        return (not tag or tag == self.tag) and self.classes.issuperset(classes)

    def select(self, selector):
        """Descendants for ``tag.class tag.class`` selectors (any depth between steps)."""
        *outer, last = selector.split()
        for found in self.walk():
            if not found.matches(last):
                continue
            steps, above = list(outer), found.parent
            while steps and above is not None and above is not self:
                if above.matches(steps[-1]):
                    steps.pop()
                above = above.parent
            if not steps:
                yield found


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = _Element("", [], None)

    def handle_starttag(self, tag, attrs):
        above = self.here
        while above is not self.root and above.tag not in _SCOPE.get(tag, ()):
            if tag in _ENDED_BY.get(above.tag, ()):
                self.here = above.parent
            above = above.parent
        child = _Element(tag, attrs, self.here)
        self.here.children.append(child)
        if tag not in _VOID:
            self.here = child

    def handle_endtag(self, tag):
        above = self.here
        while above is not self.root and above.tag != tag:
            above = above.parent
        if above is not self.root:
            self.here = above.parent

    def handle_data(self, data):
        self.here.children.append(data)


def _parse(html: str) -> _Element:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page.root


def _table(root: _Element, label: str | None, table: str) -> _Element | None:
    """First matching table of the page, or the first one after the span with the given text."""
    waiting = label is not None
    for found in root.walk():
        if waiting:
            waiting = not (found.tag == "span" and found.text() == label)
        elif found.matches(table):
            return found
    return None


def _table_rows(root: _Element, label: str | None, data_cells_only: bool, table: str) -> Iterator[tuple]:
    found = _table(root, label, table)
    if found is None:
        return
    kinds = {"td"} if data_cells_only else {"td", "th"}
    for number, row in enumerate(r for r in found.walk() if r.tag == "tr"):
        yield number, [c.text() for c in row.children if isinstance(c, _Element) and c.tag in kinds]


def _cards(root: _Element, card: str, fields: Mapping[str, str]) -> Iterator[tuple]:
    for number, found in enumerate(root.select(card)):
        values, missing = {}, None
        for name, selector in fields.items():
            texts = [hit.text() for hit in found.select(selector.removesuffix("[]"))]
            if selector.endswith("[]"):
                values[name] = " | ".join(texts)
            elif texts:
                values[name] = texts[0]
            else:
                missing = missing or f"no {name}"
        yield number, values, missing


#: Rows that are handed back at a time, a page's last rows on top.
_HANDED_BACK = 4096


def _per_page(pages: DataFrame, html: str, added: T.StructType, rows_of: Callable[[_Element], Iterator[tuple]]) -> DataFrame:
    """Each page's rows beside its other columns. A page is parsed once; many pages come and go in one Arrow batch."""
    keep = [c for c in pages.columns if c != html]
    new = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, beside = batch.column(len(keep)), batch.select(range(len(keep)))
            of_page, found = [], []

            def handed_back() -> pa.RecordBatch:
                values = zip(*found, strict=True)
                columns = [pa.array(v, f.type) for v, f in zip(values, new, strict=True)]
                return pa.RecordBatch.from_arrays([*beside.take(pa.array(of_page)).columns, *columns], names=[*beside.schema.names, *new.names])

            for n, text in enumerate(texts):
                rows = list(rows_of(_parse(text.as_py())))
                found += rows
                of_page += [n] * len(rows)
                if len(found) >= _HANDED_BACK:
                    yield handed_back()
                    of_page, found = [], []
            if found:
                yield handed_back()

    schema = T.StructType([*pages.select(*keep).schema.fields, *added.fields])
    return pages.select(*keep, html).mapInArrow(run, schema)


def table_rows(pages: DataFrame, html: str, label: str | None = None, data_cells_only: bool = True, table: str = "table") -> DataFrame:
    """Each page's table rows (``row_no``, ``cells``) beside the page's other columns; with a label, the table that follows it.

    Cells are stripped; header cells count only if ``data_cells_only`` is off. ``table`` may name a class too, such as
    ``table.wide``. Parsing costs far more than moving a page: repartition pages that lie in fewer splits than there are
    cores.
    """
    added = T.StructType.fromDDL("row_no int, cells array<string>")
    return _per_page(pages, html, added, lambda root: _table_rows(root, label, data_cells_only, table))


def grid_rows(pages: DataFrame, html: str, names: list[str], first: int = 1, table: str = "table") -> DataFrame:
    """Data rows of each page's first table: all but the header row that have every wanted cell."""
    cells = table_rows(pages, html, table=table).where(F.col("row_no") > 0).where(F.size("cells") >= first + len(names))
    keep = [c for c in pages.columns if c != html]
    return cells.select(*keep, *[F.col("cells")[first + i].alias(name) for i, name in enumerate(names)])


def cards(pages: DataFrame, html: str, card: str, fields: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good cards as columns, and broken cards with the reason.

    ``fields`` maps names to selectors; one that ends in ``[]`` joins all matches with `` | ``. A field that is not there
    makes the card a broken one.
    """
    values = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    added = T.StructType([T.StructField("card_no", T.IntegerType()), T.StructField("fields", values), T.StructField("error", T.StringType())])
    selectors = dict(fields)
    found = _per_page(pages, html, added, lambda root: _cards(root, card, selectors))
    keep = [c for c in pages.columns if c != html]
    good = found.where("error is null").select(*keep, "card_no", *[F.col("fields")[n].alias(n) for n in fields])
    return good, found.where("error is not null").select(*keep, "card_no", "error")
