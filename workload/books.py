"""Input files made from tables by Spark, for the scan queries."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgate.functions.cells import column_letter
from gridgate.session import scratch_path

_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook(sheets: dict[str, list[list]], active: int = 0, styles: str | None = None) -> bytes:
    """A minimal workbook: numbers and booleans typed, other values as inline text."""
    def cell(row, at, value):
        address = f'r="{column_letter(at)}{row}"'
        if isinstance(value, str) and value.startswith("<c"):
            return value.replace("<c", f"<c {address}", 1)
        if isinstance(value, bool):
            return f'<c {address} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {address}><v>{value!r}</v></c>"
        return f'<c {address} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    names = list(sheets)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><bookViews><workbookView '
                                         f'activeTab="{active}"/></bookViews><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">' + "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        if styles:
            book.writestr("xl/styles.xml", styles)
        for i, name in enumerate(names, 1):
            rows = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>"
                           for r, row in enumerate(sheets[name], 1))
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{rows}</sheetData></worksheet>')
    return buffer.getvalue()


def workbooks_of(df: DataFrame, chunk: str, columns: list[str], order: str) -> DataFrame:
    """``path, content``: one workbook per chunk of rows, header in the second row."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(order)
        body = [[v.item() if hasattr(v, "item") else v for v in row] for row in ordered[columns].itertuples(index=False)]
        content = workbook({"notes": [["nothing here"]], "sales": [["made by hand"], columns, *body]}, active=1)
        return pd.DataFrame({"path": [f"book{rows[chunk].iloc[0]}.xlsx"], "content": [content]})

    return df.select(chunk, *columns).groupBy(chunk).applyInPandas(build, "path string, content binary")


def text_files(df: DataFrame, chunk: Column, lead: list[str], line: Column, order: str) -> str:
    """Folder with one text file per chunk of rows: lead lines, then the rows in order."""
    path = scratch_path(df.sparkSession, "texts")
    rows = df.select(chunk.alias("chunk"), F.struct(F.col(order).alias("o"), line.alias("l")).alias("x"))
    body = rows.groupBy("chunk").agg(F.array_join(F.sort_array(F.collect_list("x"))["l"], "\n").alias("_body"))
    body.select("chunk", F.concat_ws("\n", *[F.lit(x) for x in lead], "_body").alias("value")).write.partitionBy("chunk").text(path)
    return path
