"""Folders of ``.xlsx``/``.xlsm`` workbooks.

A workbook is a zip of XML parts that only its own reader understands, so each
file is decoded in Python, one file per input row, while Spark spreads the files.
Everything after the decoded sheet rows is native.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.errors import HeaderError, SourceError
from gridgate.functions.text import WHITESPACE
from gridgate.session import staged
from gridgate.sources.delimited import Scan
from gridgate.sources.positions import FILE, ORDINAL

SHEET_ROWS = ("_file string, sheet string, active boolean, row_idx bigint, "
              "cells array<struct<kind: string, text: string>>, problem string")
_ARROW = pa.schema([
    ("_file", pa.string()), ("sheet", pa.string()), ("active", pa.bool_()), ("row_idx", pa.int64()),
    ("cells", pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))), ("problem", pa.string())])
_BATCH = 2_000
# Built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_NOT_FORMAT = re.compile(r'"[^"]*"|\[(?!h+\]|m+\]|s+\])[^\]]*\]|\\.|_.|\*.')
_EPOCHS = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def read_sheets(files: DataFrame) -> DataFrame:
    """Sheet rows of a frame with ``path`` and ``content``; ``row_idx`` is 1-based.

    A file that cannot be decoded gives one row with ``problem`` set.
    """
    return files.select("path", "content").mapInArrow(_decode, SHEET_ROWS)


def read_workbooks(spark: SparkSession, paths) -> DataFrame:
    return read_sheets(spark.read.format("binaryFile").load(paths))


def _decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            held = []
            try:
                for row in _rows(content.as_py()):
                    held.append({"_file": path, **row})
                    if len(held) == _BATCH:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held = []
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError) as error:
                held.append({"_file": path, "problem": f"cannot open file: {error}"})
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _rows(content: bytes) -> Iterator[dict]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parts = set(book.namelist())
        root = ElementTree.fromstring(book.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        nodes = list(root.iter())
        view = next((n for n in nodes if _tag(n) == "workbookView"), None)
        active = int(view.get("activeTab", 0)) if view is not None else 0
        by_1904 = any(_tag(n) == "workbookPr" and n.get("date1904") in ("1", "true") for n in nodes)
        shared = _shared_strings(book) if "xl/sharedStrings.xml" in parts else []
        dated = _date_styles(book) if "xl/styles.xml" in parts else []
        for at, sheet in enumerate(n for n in nodes if _tag(n) == "sheet"):
            link = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            target = links[link].lstrip("/")
            part = target if target in parts else f"xl/{target}"
            with book.open(part) as stream:
                yield from _sheet_rows(stream, sheet.get("name"), at == active, shared, dated, _EPOCHS[by_1904])


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_rich_text(item) for item in root]


def _rich_text(item) -> str:
    runs = (t for child in item for t in ([child] if _tag(child) == "t" else child if _tag(child) == "r" else []))
    return "".join(t.text or "" for t in runs if _tag(t) == "t")


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iter() if _tag(n) == "numFmt"}
    styles = next((n for n in root.iter() if _tag(n) == "cellXfs"), [])

    def dated(style) -> bool:
        code = int(style.get("numFmtId", 0))
        if code in custom:
            return bool(re.search("[dmyhs]", _NOT_FORMAT.sub("", custom[code]).lower()))
        return code in _DATE_FORMATS

    return [dated(style) for style in styles]


def _sheet_rows(stream, name, active, shared, dated, epoch) -> Iterator[dict]:
    row_idx, cells = 0, []
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        tag = _tag(element)
        if event == "start":
            if tag == "row":
                row_idx, cells = int(element.get("r", row_idx + 1)), []
        elif tag == "c":
            address = element.get("r")
            at = _column(address) if address else len(cells)
            cells += [None] * (at + 1 - len(cells))
            cells[at] = _cell(element, shared, dated, epoch)
        elif tag == "row":
            yield {"sheet": name, "active": active, "row_idx": row_idx, "cells": cells}
            element.clear()


def _column(address: str) -> int:
    at = 0
    for char in address:
        if not char.isalpha():
            break
        at = at * 26 + ord(char.upper()) - 64
    return at - 1


def _cell(element, shared, dated, epoch) -> dict | None:
    kind = element.get("t", "n")
    value = next((c.text for c in element if _tag(c) == "v"), None)
    if kind == "inlineStr":
        inline = next((c for c in element if _tag(c) == "is"), None)
        return None if inline is None else {"kind": "str", "text": _rich_text(inline)}
    if value is None:
        return None
    if kind == "s":
        return {"kind": "str", "text": shared[int(value)]}
    if kind == "b":
        return {"kind": "bool", "text": "True" if value == "1" else "False"}
    if kind == "d":
        return {"kind": "datetime", "text": value.replace("T", " ")}
    if kind != "n":
        return {"kind": "str", "text": value}
    style = int(element.get("s", 0))
    if style < len(dated) and dated[style]:
        return _moment(float(value), epoch)
    if re.fullmatch(r"-?\d+", value):
        return {"kind": "int", "text": value}
    return {"kind": "float", "text": repr(float(value))}


def _moment(serial: float, epoch: datetime) -> dict:
    days, part = divmod(serial, 1)
    rest = timedelta(milliseconds=round(part * 86_400_000))
    if 0 <= serial < 1 and not rest.days:
        return {"kind": "time", "text": str((datetime.min + rest).time())}
    if 0 < serial < 60 and epoch == _EPOCHS[False]:
        days += 1
    return {"kind": "datetime", "text": str(epoch + timedelta(days=days) + rest)}


# ------------------------------------------------------------- native part

def sheet(rows: DataFrame, name: str | None = None) -> DataFrame:
    """Rows of the named sheet, or of each file's active one."""
    wanted = F.col("active") if name is None else F.col("sheet") == name
    return rows.filter(F.col("problem").isNull() & wanted)


def missing_sheets(rows: DataFrame, name: str | None = None) -> DataFrame:
    """Files that cannot be decoded or lack the sheet, with the sheets they have."""
    wanted = F.col("active") if name is None else F.col("sheet") == name
    per_file = rows.groupBy(FILE).agg(
        F.max("problem").alias("_problem"), F.bool_or(wanted).alias("_found"),
        F.sort_array(F.collect_set("sheet")).alias("_sheets"))
    reason = F.coalesce("_problem", F.concat(
        F.lit(f"sheet {name!r} not found; available: "), F.array_join("_sheets", ", ")))
    return per_file.filter(F.col("_problem").isNotNull() | ~F.coalesce("_found", F.lit(False))).select(
        FILE, reason.alias("reason"))


def cell_text(index: int) -> Column:
    return F.get("cells", F.lit(index))["text"]


def scan_workbooks(spark: SparkSession, files: DataFrame, sheet_name: str | None = None, skip_rows: int = 0,
                   skip_cols: int = 0, max_row: int | None = None, check_header: bool = True,
                   columns: list[str] | None = None, decoded: DataFrame | None = None) -> Scan:
    """Text cells of one sheet of every workbook; ``files`` has ``path`` and ``content``.

    Rows keep their true place in the sheet. ``columns`` saves looking the
    header up; without it the header of the first file is used. Files with
    another header are listed in ``rejected``. Decoding runs once: its rows are
    staged and every later step reads only the columns it needs. ``decoded`` may
    bring staged rows along.
    """
    decoded = staged(read_sheets(files), "sheets") if decoded is None else decoded
    mine = sheet(decoded, sheet_name)
    heads = mine.filter(F.col("row_idx") == skip_rows + 1).select(FILE, _names(skip_cols).alias("names"))
    if columns is None:
        lead = heads.orderBy(FILE).select("names").first()
        if lead is None:
            raise SourceError(f"no sheet has a header row at skip_rows={skip_rows}")
        columns = list(lead.names)
    if check_header:
        bad = [c for c in columns if not re.fullmatch(r"[a-z0-9_]+", c)]
        if not columns or bad or len(set(columns)) != len(columns):
            raise HeaderError(f"header {columns} needs unique names of latin letters, digits and underscores")
    same = F.col("names") == F.array([F.lit(c) for c in columns])
    cells = [cell_text(i + skip_cols).alias(c) for i, c in enumerate(columns)]
    data = mine.filter(F.col("row_idx") > skip_rows + 1)
    if max_row is not None:
        data = data.filter(F.col("row_idx") <= skip_rows + 1 + max_row)
    rows = (data.join(heads.filter(same).select(FILE), FILE, "left_semi")
            .select(FILE, (F.col("row_idx") - 1).alias(ORDINAL), *cells))
    rejected = missing_sheets(decoded, sheet_name).union(
        heads.filter(~same).select(FILE, F.lit("header differs from the first file")))
    return Scan(rows, columns, rejected, skip_cols)


def _names(skip_cols: int) -> Column:
    """Lower-case names of a header row, without empty cells at its end."""
    texts = F.transform(F.slice("cells", skip_cols + 1, F.greatest(F.size("cells"), F.lit(1))), lambda c: c["text"])
    filled = F.transform(texts, lambda t, i: F.when(t.isNotNull(), i + 1).otherwise(0))
    return F.transform(F.slice(texts, F.lit(1), F.coalesce(F.array_max(filled), F.lit(0))),
                       lambda t: F.btrim(F.lower(F.coalesce(t, F.lit("none"))), F.lit(WHITESPACE)))
