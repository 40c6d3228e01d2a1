"""Tables inside texts: HTML pages and CSV sheets, each read by a table function that is applied laterally.

A row of the input gives its table's rows with their position in it, so order
holds across pages without a sort, and a text is parsed where it lies.
"""

import csv
import io
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pricewave.functions import scalars

# Heading of a report, first cells of a sheet's header, the most rows that a sheet gives.
REPORT_HEADING = "Catalogue Half-Price Report"
SHEET_HEADER = ("Retailer", "Name", "Category")
SHEET_ROWS = 5000

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """(category, cells) of the body rows of a page's data tables, each under the last heading before its table."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple] = []
        self.category = scalars.UNCATEGORISED
        self.pieces: list[str] | None = None  # text of the open heading or cell
        self.cells: list[str] | None = None
        self.open, self.data, self.body = "", False, False

    def _close(self, *tags: str) -> None:
        if self.pieces is not None and self.open in tags:
            found = " ".join(self.pieces)
            if self.open == "h5" and REPORT_HEADING not in found:
                self.category = found or scalars.UNCATEGORISED
            elif self.open == "td" and self.cells is not None:
                self.cells.append(found)
            self.pieces, self.open = None, ""

    def _close_row(self) -> None:
        self._close("td", "th")
        if self.cells is not None:
            self.rows.append((self.category, self.cells))
        self.cells = None

    def handle_starttag(self, tag, attrs):
        if tag == "h5":
            self._close("h5", "td", "th")
            self.pieces, self.open = [], tag
        elif tag == "table":
            self._close_row()
            self.data, self.body = "data" in (dict(attrs).get("class") or "").split(), False
        elif tag in ("tbody", "thead", "tfoot"):
            self._close_row()
            self.body = tag == "tbody"
        elif tag == "tr":
            self._close_row()
            self.cells = [] if self.data and self.body else None
        elif tag in ("td", "th"):
            self._close("td", "th")
            self.pieces, self.open = [], tag

    def handle_data(self, data):
        if self.pieces is not None and data.strip():
            self.pieces.append(data.strip())

    def handle_endtag(self, tag):
        if tag in ("h5", "td", "th"):
            self._close(tag)
        elif tag in ("tr", "tbody", "thead", "tfoot"):
            self._close_row()
            self.body = self.body and tag == "tr"
        elif tag == "table":
            self._close_row()
            self.data = False

    def close(self):
        super().close()
        self._close("h5")
        self._close_row()


class _HtmlRows:
    def eval(self, html: str):
        page = _Page()
        page.feed(html or "")
        page.close()
        for pos, (category, cells) in enumerate(page.rows):
            yield pos, category, cells


class _CsvRows:
    def eval(self, body: str):
        for line, cells in enumerate(csv.reader(io.StringIO(body or ""))):
            yield line, cells


html_rows = F.udtf(_HtmlRows, returnType="pos int, category string, cells array<string>", useArrow=True)
csv_rows = F.udtf(_CsvRows, returnType="line int, cells array<string>", useArrow=True)


def table_rows(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """(keys, pos, category, cells): rows of the bodies of tables of class data, in the page's order.

    The category is the last h5 heading before the table, the report's own
    heading not being one. Tables within tables are read as tables that follow.
    """
    given = pages.select(*keys, F.col(html).alias("_html"))
    return given.lateralJoin(html_rows(F.col("_html").outer())).drop("_html")


def _strict_cents(cell: Column) -> Column:
    """A whole cell as dollars: "$1,234.50" to 123450; null for anything else in it."""
    bare = F.trim(F.regexp_replace(cell, "[$,]", ""))
    return F.rint(F.when(bare.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), bare.try_cast("double")) * 100).try_cast("bigint")


def _specials(rows: DataFrame, keys: list[str], regular: Column, sale: Column, pct: Column, retailer: Column, last: Column) -> DataFrame:
    hint = scalars.hint("last_raw")
    made = rows.withColumns({"regular_cents": regular, "sale_cents": sale, "discount_pct": pct, "retailer": retailer, "last_raw": last})
    return made.select(
        *keys, "retailer", "name", "category", "regular_cents", "sale_cents", "discount_pct", (F.col("discount_pct") >= 50).alias("is_half_price"),
        "last_raw", hint["weeks"].alias("last_weeks"), hint["retailer"].alias("last_retailer"),
    ).where("retailer IS NOT NULL AND regular_cents IS NOT NULL AND sale_cents IS NOT NULL AND discount_pct IS NOT NULL")


def table_specials(pages: DataFrame, html: str = "html", page: str = "page") -> DataFrame:
    """Specials of a report's pages: page, pos, retailer, name, category, prices in cents, discount, half-price flag, last half-price.

    Cells are retailer, name, regular price, (unit), sale price, percent and, where
    there is a seventh, when the item was last at half price. Rows of fewer than
    six cells, without a known retailer or with a price or percentage that is
    none are left out. Of rows that repeat retailer, name and sale price the first by page and position stays.
    """
    cell = lambda k: F.get("cells", F.lit(k))
    rows = table_rows(pages, html, (page,)).where(F.size("cells") >= 6).withColumn("name", cell(1))
    whole = F.trim(F.rtrim(F.trim(cell(5)), F.lit("%")))
    pct = F.when(whole.rlike(r"^[+-]?\d+$"), whole.try_cast("int"))
    found = _specials(rows, [page, "pos"], _strict_cents(cell(2)), _strict_cents(cell(4)), pct, scalars.retailer_cell(cell(0)), F.coalesce(cell(6), F.lit("")))
    first = F.row_number().over(Window.partitionBy("retailer", "name", "sale_cents").orderBy(page, "pos"))
    return found.withColumn("_first", first).where("_first = 1").drop("_first")


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """(file, body) of the CSV files at path; a sheet is one text, as its rows may hold line breaks."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def sheet_lines(sheets: DataFrame, file: str = "file", body: str = "body") -> DataFrame:
    """(file, line, cells, lines, header_ok): a sheet's rows, each with how many the sheet has and whether its header is as it should be."""
    rows = sheets.select(F.col(file).alias("file"), F.col(body).alias("_body")).lateralJoin(csv_rows(F.col("_body").outer())).drop("_body")
    by = Window.partitionBy("file")
    head = F.transform(F.slice("cells", 1, len(SHEET_HEADER)), lambda c: scalars.strip(c))
    ok = F.max(F.when(F.col("line") == 1, head == F.array(*map(F.lit, SHEET_HEADER)))).over(by)
    return rows.withColumns({"lines": F.count("*").over(by), "header_ok": F.coalesce(ok, F.lit(False))})


def sheet_specials(lines: DataFrame, limit: int = SHEET_ROWS) -> DataFrame:
    """Specials of sheet_lines: file, line, and the columns of table_specials.

    A sheet is a banner, a header and rows of nine cells or more: retailer, name,
    category, regular price, (unit), sale price, percent, (unit), last half-price.
    Sheets of fewer than three rows or with another header give none; neither do
    rows without a known retailer, a name, both prices and a percentage, or whose sale price is no lower than
    the regular one. The first rows of a sheet up to limit count, as its format has it.
    """
    cell = lambda k: F.get("cells", F.lit(k))
    name, category = scalars.strip(cell(1)), F.coalesce(F.nullif(scalars.strip(cell(2)), F.lit("")), F.lit(scalars.UNCATEGORISED))
    rows = lines.where("header_ok AND lines >= 3 AND line > 1 AND size(cells) >= 9").withColumns(
        {"name": name, "category": category, "_regular": cell(3), "_sale": cell(5), "_pct": cell(6)}
    )
    shop = scalars.retailer_cell(cell(0), exact=True)
    found = _specials(rows.where("name <> ''"), ["file", "line"], scalars.dollars_to_cents("_regular"), scalars.dollars_to_cents("_sale"), scalars.percent("_pct"), shop, cell(8))
    nth = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    return found.where("sale_cents < regular_cents").withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")


def sheet_runs(lines: DataFrame, specials: DataFrame) -> DataFrame:
    """(file, status, items): success, no_data (fewer than three rows, or none usable) or failed (another header). A file without any row has no run."""
    sheets = lines.groupBy("file").agg(F.max("lines").alias("lines"), F.max("header_ok").alias("ok"))
    got = specials.groupBy("file").agg(F.count("*").alias("items"))
    n = F.coalesce("items", F.lit(0))
    status = F.when(F.col("lines") < 3, "no_data").when(~F.col("ok"), "failed").when(n == 0, "no_data").otherwise("success")
    return sheets.join(got, "file", "left").select("file", status.alias("status"), n.alias("items"))
