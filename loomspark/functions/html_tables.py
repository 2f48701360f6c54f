"""HTML tables as markdown tables.

A table's cells are laid out on a grid: a cell that spans rows or columns is in each of its places, rows that are too short are
filled up. A row or a cell that isn't ended ends where the next one begins; a table in a cell is text of that cell, and so are
line breaks a space. Spans end with the table. The first row is the header; a table without cells becomes its text. Captions,
scripts and styles are left out. Spans that are no number count as one, at most 1000 columns.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from loomspark.sources.tables import small_batches

_ENDS = re.compile(r"<(/?)table\b[^>]*>", re.I)
_ANY = re.compile(r"<[^>]+>")
_SKIPPED = frozenset(("script", "style", "template"))
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def _span(attrs: list, name: str, most: int) -> int:
    value = next((v for k, v in attrs if k == name), None) or "1"
    return min(int(value), most) if value.strip().isascii() and value.strip().isdigit() else 1


class _Cells(HTMLParser):
    """The rows of the outermost table: cells of text, rows and columns."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, int, int]]] = []
        self.cell: list[str] | None = None
        self.spans, self.depth, self.skipped, self.open_row = (1, 1), 0, 0, False

    def _end_cell(self) -> None:
        if self.cell is not None:
            self.rows[-1].append((" ".join("".join(self.cell).split()), *self.spans))
            self.cell = None

    def _end_row(self) -> None:
        self._end_cell()
        self.open_row = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SKIPPED:
            self.skipped += 1
        elif tag == "table":
            self.depth += 1
            self._space()
        elif self.depth > 1:
            self._space()
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()
            if tag == "tr":
                self.rows.append([])
                self.open_row = True
        elif tag in ("td", "th"):
            self._end_cell()
            if not self.open_row:
                self.rows.append([])
                self.open_row = True
            self.cell, self.spans = [], (_span(attrs, "rowspan", MOST_ROWS), max(1, _span(attrs, "colspan", MOST_COLUMNS)))
        elif tag in ("br", "p", "div", "li", "tr", "hr"):
            self._space()

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag == "table":
            self.depth -= 1
            self._space()
        elif self.depth > 1 or tag in ("p", "div", "li"):
            self._space()
        elif tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()

    def _space(self) -> None:
        if self.cell is not None:
            self.cell.append(" ")

    def handle_data(self, data: str) -> None:
        if self.cell is not None and not self.skipped:
            self.cell.append(data)

    def close(self) -> None:
        super().close()
        self._end_row()


def table_grid(table: str) -> list[list[str]]:
    """The texts of a table by row and column, all rows of the same width."""
    parser = _Cells()
    parser.feed(table)
    parser.close()
    rows: list[list[str]] = []
    above: dict[int, tuple[str, int]] = {}  # by column: a text from above and how many rows more it spans
    for cells in parser.rows:
        if not cells and not above:
            continue
        row: dict[int, str] = {c: text for c, (text, _) in above.items()}
        left = {c: (text, n - 1) for c, (text, n) in above.items() if n > 1}
        at = 0
        for text, down, across in cells:
            while at in row:
                at += 1
            for c in range(at, at + across):
                row.setdefault(c, text)
                if down != 1:
                    left.setdefault(c, (text, down - 1 if down else MOST_ROWS))
            at += across
        above = left
        rows.append([row.get(c, "") for c in range(max(row) + 1)])
    width = max(map(len, rows), default=0)
    return [r + [""] * (width - len(r)) for r in rows]


def table_markdown(table: str, escape: bool = True) -> str:
    """A table as lines of cells; ``escape`` puts a backslash before bars in cells."""
    rows = table_grid(table)
    if not rows:
        return _ANY.sub(" ", table)
    line = lambda cells: "| " + " | ".join(c.replace("|", r"\|") if escape else c for c in cells) + " |"
    return "\n".join([line(rows[0]), "|" + "---|" * len(rows[0]), *map(line, rows[1:])])


def with_tables(text: str, escape: bool = True) -> str:
    """The text with its outermost whole tables as markdown; what is never ended stays as it is."""
    out, at = [], 0
    begun: list[int] = []
    whole: list[tuple[int, int]] = []
    for m in _ENDS.finditer(text):
        if not m[1]:
            begun.append(m.start())
        elif begun:
            start = begun.pop()
            while whole and whole[-1][0] > start:
                whole.pop()
            whole.append((start, m.end()))
    for start, end in whole:
        out += text[at:start], "\n\n", table_markdown(text[start:end], escape), "\n\n"
        at = end
    return "".join(out) + text[at:]


def render_tables(text: Column, escape: bool = True) -> Column:
    """The text with its tables as markdown; only texts that have one leave the JVM, few at once."""
    small_batches(SparkSession.active())

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else with_tables(x, escape))

    has = text.rlike(r"(?i)</table\b")
    return F.when(has, run(F.when(has, text))).otherwise(text)
