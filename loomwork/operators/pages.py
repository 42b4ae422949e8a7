"""Result pages to documents and documents to text."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.scalars import month, safe_name, valid_name
from loomwork.operators.relational import first_wins
from loomwork.plans.rules import extract
from loomwork.session import ship

# Marks of the registry's pages.
DOCUMENT = r'<hr size="1" width="100%"><b>(\d+)\.</b>'
PAGES = r'<hr size="1"><br> Страницы \(всего\s*(\d+)\s*\)'
NUMBER = r"(?is)Номер\s+заключения\s+и\s+дата[^<]*</td>\s*<td>\s*<b>\s*([^<]+?)\s*</b>"
_MARK = re.compile(DOCUMENT)


def jobs(terms: DataFrame, first: str, last: str) -> DataFrame:
    """One row per term and month (MM.yyyy, both ends included), with the term's folder name."""
    span = F.sequence(month(F.lit(first)), month(F.lit(last)), F.expr("interval 1 month"))
    return terms.select("term", safe_name(F.col("term")).alias("folder"), F.explode(span).alias("month"))


def page_count(page: Column) -> Column:
    """Pages that a result has; one where it doesn't say or says nonsense."""
    n = extract(page, PAGES).try_cast("int")
    return F.when(n > 0, n).otherwise(1)


def expected_documents(pages: Column, first: Column, last: Column) -> Column:
    """Documents of a result whose first page and last page hold so many."""
    return (pages - 1) * first + last


def fragments(page: str | None) -> list[tuple[int, str]]:
    """Parts of a page from the table row that holds a document's mark to the row of the next mark or the table's end."""
    page = page or ""
    marks = list(_MARK.finditer(page))
    low = page.lower()
    out = []
    for k, m in enumerate(marks):
        start = low.rfind("<tr", 0, m.start())
        start = m.start() if start < 0 else start
        if k + 1 < len(marks):
            stop = low.rfind("<tr", 0, marks[k + 1].start())
            stop = marks[k + 1].start() if stop <= start else stop
        else:
            stop = low.find("</table>", m.start())
            stop = len(page) if stop < 0 else stop
        out.append((int(m[1]), page[start:stop]))
    return out


def split_documents(pages: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_name, html) of pages (html, and the columns of order), each name once, the first in order; and the
    fragments without a valid name."""

    ship(pages.sparkSession)

    @F.pandas_udf("array<struct<mark:int,fragment:string>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"mark": n, "fragment": f} for n, f in fragments(p)] for p in batch])

    parts = pages.select(*order, F.explode(cut("html")).alias("f")).select(*order, "f.*")
    name = F.trim(F.regexp_replace(_decode(extract(F.col("fragment"), NUMBER)), r'[\\/:*?"<>|\r\n\t]+', " "))
    named = parts.withColumn("doc_name", name)
    whole = F.concat(F.lit("<html><body><table>"), "fragment", F.lit("</table></body></html>"))
    good = first_wins(named.filter(valid_name(F.col("doc_name"))), ["doc_name"], [*order, "mark"]).select("doc_name", whole.alias("html"))
    return good, named.filter(~valid_name(F.col("doc_name"))).select("mark", "doc_name")


def _decode(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else entities.unescape(t))

    return run(text)


class _Cells(HTMLParser):
    """Texts of the cells of the last table: of every p and b in them, else of the cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[str]] = []
        self.depth = 0
        self.cell: list[str] | None = None
        self.nodes: list[tuple[str, list[str]]] = []
        self.found: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "td" and self.tables:
            self._close()
            self.cell, self.nodes, self.found = [], [], []
        elif tag in ("p", "b") and self.cell is not None:
            node: list[str] = []
            self.found.append(node)
            self.nodes.append((tag, node))
        elif tag == "br":
            self.handle_data("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "table", "tr"):
            self._close()
        for k in range(len(self.nodes) - 1, -1, -1):
            if self.nodes[k][0] == tag:
                del self.nodes[k:]
                break

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)
            for _, node in self.nodes:
                node.append(data)

    def _close(self) -> None:
        if self.cell is not None and self.tables:
            lines = ["".join(n) for n in self.found] if self.found else ["".join(self.cell)]
            self.tables[-1] += [x for k, x in enumerate(lines) if not k or x != lines[k - 1]]
        self.cell = None


def table_text(page: str | None) -> str:
    """Text of the last table, a line per node, without a text that repeats the one before it in its cell; no-break spaces
    and control dashes are spaces."""
    parser = _Cells()
    parser.feed(page or "")
    parser.close()
    parser._close()
    lines = parser.tables[-1] if parser.tables else []
    return "\n".join(lines).replace("\x97", " ").replace("\xa0", " ")


def document_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(table_text)

    return run(html)


def texts(documents: DataFrame) -> DataFrame:
    """(doc_name, year, month, text) of documents with valid names."""
    ship(documents.sparkSession)
    name = F.trim("doc_name")
    good = documents.filter(valid_name(F.col("doc_name")))
    return good.select(name.alias("doc_name"), F.substring(name, -4, 4).cast("int").alias("year"), F.substring(name, -7, 2).cast("int").alias("month"), document_text(F.col("html")).alias("text"))
