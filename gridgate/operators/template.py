"""Template workbooks: a ``data`` sheet described by a ``klad_config`` sheet.

Works on decoded sheet rows of any number of workbooks at once, see
:func:`gridgate.sources.workbook.read_sheets`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgate.errors import TemplateError
from gridgate.functions.cells import address_index, address_row
from gridgate.functions.text import WHITESPACE, stripped
from gridgate.operators.contract import ColumnSpec, Contract
from gridgate.sources.positions import FILE

# Names and marks of the template format.
DATA_SHEET, CONFIG_SHEET = "data", "klad_config"
END_MARK = "<< конец описания шаблона пустая строка в таблице"
FROM_ROWS = "table"
_ADDRESS = r"^[A-Z]+\d+$"


def templates(sheets: DataFrame) -> DataFrame:
    """Per file: does it have both sheets of a template."""
    flags = sheets.groupBy(FILE).agg(
        F.bool_or(F.col("sheet") == DATA_SHEET).alias("_d"), F.bool_or(F.col("sheet") == CONFIG_SHEET).alias("_c"))
    return flags.select(FILE, F.coalesce(F.col("_d") & F.col("_c"), F.lit(False)).alias("is_template"))


def _text(index: int) -> Column:
    return F.get("cells", F.lit(index))["text"]


def start_rows(sheets: DataFrame) -> DataFrame:
    """Per file the rows to skip before the header, from the address in B1."""
    address = F.upper(stripped(_text(1)))
    row = address_row(address)
    problem = (F.when(~F.coalesce(address.rlike(_ADDRESS), F.lit(False)), "B1 must be an address like A3")
               .when(row < 2, "data cannot start before row 2"))
    return sheets.filter((F.col("sheet") == CONFIG_SHEET) & (F.col("row_idx") == 1)).select(
        FILE, problem.alias("problem"), F.when(problem.isNull(), row - 2).alias("skip_rows"))


def template_contract(sheets: DataFrame) -> DataFrame:
    """Contract rows of every template.

    Result: ``_file, ordinal, display, source, is_key, col_name, type_text,
    fixed_value, problem``. Definitions run from row 3 to the first empty row or
    the end mark; the window that finds it spans one configuration sheet. Fixed
    values come from a join on (file, row), so only referenced data rows move.
    """
    first = [_text(i) for i in range(6)]
    marked = F.exists(F.slice("cells", F.lit(1), F.lit(6)),
                      lambda c: F.coalesce(F.contains(c["text"], F.lit(END_MARK)), F.lit(False)))
    config = sheets.filter((F.col("sheet") == CONFIG_SHEET) & (F.col("row_idx") >= 3)).select(
        FILE, "row_idx", *[c.alias(f"c{i}") for i, c in enumerate(first)],
        (F.coalesce(*first).isNull() | marked).alias("_stop"))
    in_file = Window.partitionBy(FILE)
    stop = F.min(F.when(F.col("_stop"), F.col("row_idx"))).over(in_file)
    gap = F.col("row_idx") - F.row_number().over(in_file.orderBy("row_idx"))
    body = (config.withColumn("_end", stop).withColumn("_gap", gap)
            .filter((F.col("_end").isNull() | (F.col("row_idx") < F.col("_end"))) & (F.col("_gap") == 2)))
    source = F.upper(stripped(F.col("c1")))
    fixed = F.lower(source) != FROM_ROWS
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    problem = (F.when(blank("c3"), "technical name is empty").when(blank("c4"), "data type is empty")
               .when(blank("c1"), "source is empty")
               .when(fixed & ~source.rlike(_ADDRESS), "source is neither 'table' nor an address"))
    specs = body.select(
        FILE, (F.col("row_idx") - 2).cast("int").alias("ordinal"),
        F.coalesce(stripped(F.col("c0")), F.lit("")).alias("display"), source.alias("source"),
        (F.lower(stripped(F.coalesce("c2", F.lit("")))) == "true").alias("is_key"),
        F.lower(stripped(F.col("c3"))).alias("col_name"), F.lower(stripped(F.col("c4"))).alias("type_text"),
        problem.alias("problem"),
        F.when(fixed & problem.isNull(), address_row(source)).alias("_row"),
        F.when(fixed & problem.isNull(), address_index(source)).alias("_col"))
    wanted = specs.filter("_row is not null").select(FILE, "_row", "_col").distinct()
    data = sheets.filter(F.col("sheet") == DATA_SHEET).select(FILE, F.col("row_idx").alias("_row"), "cells")
    values = data.join(wanted, [FILE, "_row"]).select(
        FILE, "_row", "_col", F.get("cells", F.col("_col"))["text"].alias("_value"))
    return specs.join(values, [FILE, "_row", "_col"], "left").select(
        FILE, "ordinal", "display", F.when(F.col("_row").isNull(), F.lower("source")).otherwise(F.col("source"))
        .alias("source"), "is_key", "col_name", "type_text",
        F.when(F.col("_row").isNotNull(), F.coalesce("_value", F.lit(""))).alias("fixed_value"), "problem")


def data_headers(sheets: DataFrame) -> DataFrame:
    """Filled header cells of the data sheets in order: ``_file, pos, name``."""
    starts = start_rows(sheets).filter("problem is null").select(FILE, (F.col("skip_rows") + 1).alias("row_idx"))
    names = F.filter(F.transform("cells", lambda c: F.btrim(c["text"], F.lit(WHITESPACE))), lambda t: t.isNotNull())
    rows = sheets.filter(F.col("sheet") == DATA_SHEET).join(starts, [FILE, "row_idx"])
    return rows.select(FILE, F.posexplode(names).alias("pos", "name"))


def expected_headers(contract: DataFrame) -> DataFrame:
    """Display names that must head the data sheet: those without a fixed value."""
    place = F.row_number().over(Window.partitionBy(FILE).orderBy("ordinal")) - 1
    return contract.filter("fixed_value is null and problem is null").select(
        FILE, place.alias("pos"), F.col("display").alias("name"))


def fixed_by_file(contract: DataFrame, names: list[str]) -> DataFrame:
    """One row per file with its fixed values in columns."""
    return contract.groupBy(FILE).agg(*[
        F.max(F.when(F.col("col_name") == n, F.col("fixed_value"))).alias(n) for n in names])


def unlike(sheets: DataFrame, contract: DataFrame, lead: str) -> DataFrame:
    """Files whose definitions, fixed values aside, differ from those of ``lead``."""
    row = F.struct("ordinal", "display", "is_key", "col_name", "type_text",
                   F.col("fixed_value").isNull().alias("from_rows"), "problem")
    shapes = contract.groupBy(FILE).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    known = templates(sheets).join(start_rows(sheets), FILE, "left").join(shapes, FILE, "left").select(
        FILE, F.to_json(F.struct("is_template", "skip_rows", "_rows")).alias("_shape"))
    expected = known.filter(F.col(FILE) == lead).first()._shape
    return known.filter(F.col("_shape") != expected).select(
        FILE, F.lit("template differs from the first file").alias("reason"))


def collect_template(contract: DataFrame, dialect: str = "gp") -> Contract:
    """Contract of one template file."""
    rows = contract.orderBy("ordinal").collect()
    if not rows:
        raise TemplateError("the configuration sheet defines no columns")
    problems = [f"row {r.ordinal + 2}: {r.problem}" for r in rows if r.problem]
    if problems:
        raise TemplateError("; ".join(problems))
    return Contract(tuple(ColumnSpec(r.col_name, r.type_text, r.is_key, r.display, r.fixed_value) for r in rows),
                    dialect)
