"""Reports over violations: counts, row ranges, samples, verdicts, text.

Every step is a hash aggregation with map-side combine, a bounded top-k, or a
window over one run of rows, so a column that is wrong in every row of the
largest file still spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgate.functions.text import py_repr
from gridgate.operators.numbering import number_by

GROUP = ["severity", "col_idx", "col_letter", "col_name", "expected_type"]
RANGES_SHOWN, SAMPLES_SHOWN = 10, 3


def summary(violations: DataFrame, lineage: list[str]) -> DataFrame:
    """Cells per file and column."""
    return violations.groupBy(*lineage, *GROUP).agg(F.count("*").alias("cells"))


def label() -> Column:
    """``name (C)``, or the letter alone for a column without a name."""
    bare = F.coalesce(F.col("col_name"), F.lit("")).isin("") | (F.col("col_name") == F.col("col_letter"))
    return F.when(bare, F.col("col_letter")).otherwise(F.format_string("%s (%s)", "col_name", "col_letter"))


#: Rows of one bitmap word, and words whose neighbours are found in one task.
WORD, RUN = 64, 4096


def row_words(violations: DataFrame, keys: list[str], row: str = "row", values: bool = False) -> DataFrame:
    """Rows per group as bitmaps: ``keys, _w, _bits, _cells``, one row per group and 64 rows of the file.

    Bits combine on the map side, so what is shuffled follows the words that hold findings, not the findings. ``values`` adds the
    first findings of each word as ``_first``.
    """
    place = F.col(row).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))
    first = F.slice(F.array_sort(F.collect_list(F.struct(place.alias("row"), F.col("col_idx"), F.col("value"), F.col("cell")))), 1, SAMPLES_SHOWN)
    return violations.groupBy(*keys, F.floor(place / WORD).alias("_w")).agg(
        F.bit_or(bit).alias("_bits"), F.count("*").alias("_cells"), *([first.alias("_first")] if values else []))


def _with_edges(words: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Words with ``_opens`` and ``_closes``: the bits where a range begins and ends, neighbouring words seen.

    Neighbours are found per run of words, with the words at a run's edge copied across.
    """
    w = F.col("_w")
    run = F.floor(w / size)
    copies = F.array(run, F.when(w % size == 0, run - 1), F.when(w % size == size - 1, run + 1))
    order = Window.partitionBy(*keys, "_run").orderBy("_w")
    one = F.lit(1).cast("long")
    near = (words.withColumn("_run", F.explode(copies)).filter("_run is not null")
            .withColumn("_before", F.lag(F.struct("_w", "_bits")).over(order)).withColumn("_after", F.lead(F.struct("_w", "_bits")).over(order))
            .filter(F.col("_run") == run))
    top = F.when(F.col("_before._w") == w - 1, F.shiftrightunsigned("_before._bits", WORD - 1)).otherwise(F.lit(0).cast("long"))
    low = F.when(F.col("_after._w") == w + 1, F.col("_after._bits").bitwiseAND(one)).otherwise(F.lit(0).cast("long"))
    bits = F.col("_bits")
    opens = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1).bitwiseOR(F.coalesce(top, F.lit(0)))))
    closes = bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1).bitwiseOR(F.shiftleft(F.coalesce(low, F.lit(0)), WORD - 1))))
    return near.withColumn("_opens", opens).withColumn("_closes", closes).drop("_run", "_before", "_after")


def sections(violations: DataFrame, keys: list[str], row: str = "row", shown: int = RANGES_SHOWN, dash: str = "–",
             values: bool = False, run: int = RUN) -> DataFrame:
    """Per group: ``cells, n_rows, n_ranges, ranges, hidden_rows`` and, with ``values``, its first findings as ``samples``.

    One aggregation reads the findings; all else works on its words. Ranges do not overlap, so the first ``shown`` of them lie in
    the first ``2 * shown`` words that open or close one; these come from a top-k that is cut in every task before the shuffle.
    """
    words = _with_edges(row_words(violations, keys, row, values), keys, run)
    totals = words.groupBy(*keys).agg(
        F.sum("_cells").alias("cells"), F.sum(F.bit_count("_bits")).alias("n_rows"), F.sum(F.bit_count("_opens")).alias("n_ranges"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_w"))
    marked = words.filter("_opens != 0 or _closes != 0").withColumn("_place", place).filter(F.col("_place") <= 2 * shown)
    set_in = lambda bits: F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(bits, i) == 1)
    spot = lambda bits: F.transform(set_in(F.col(bits)), lambda i: F.col("_w") * WORD + i)
    flat = lambda name: F.slice(F.array_sort(F.flatten(F.collect_list(name))), 1, shown)
    listed = marked.select(*keys, spot("_opens").alias("_a"), spot("_closes").alias("_z")).groupBy(*keys).agg(
        flat("_a").alias("_a"), flat("_z").alias("_z"))
    spans = F.slice(F.arrays_zip("_a", "_z"), 1, shown)
    text = lambda s: F.when(s["_a"] == s["_z"], s["_a"].cast("string")).otherwise(
        F.concat(s["_a"].cast("string"), F.lit(dash), s["_z"].cast("string")))
    size = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["_z"] - s["_a"] + 1)
    listed = listed.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           F.array_join(F.transform(spans, text), ", ").alias("ranges"), size.alias("_shown"))
    found = _beside(totals, listed, keys).withColumn("hidden_rows", F.col("n_rows") - F.col("_shown")).drop("_shown")
    if values:
        order = Window.partitionBy(*keys).orderBy("_w")
        lead = words.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= SAMPLES_SHOWN)
        firsts = lead.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("_first"))), 1, SAMPLES_SHOWN).alias("samples"))
        found = _beside(found, firsts, keys)
    return found


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined by the keys, NULL ones too; the right side holds them as ``_k0``, ``_k1`` and so on."""
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    return left.join(right, condition).drop(*[f"_k{i}" for i in range(len(keys))])


def row_ranges(violations: DataFrame, keys: list[str], row: str = "row", shown: int = RANGES_SHOWN,
               dash: str = "–", width: int = RUN * WORD) -> DataFrame:
    """Consecutive rows per group as text such as ``1–3, 5–6, 8``.

    Result: ``keys, n_rows, n_ranges, ranges, hidden_rows``; ``ranges`` lists
    the first ``shown`` ones, ``hidden_rows`` counts the rows of the others.
    Neighbours are found per run of ``width`` rows.
    """
    return sections(violations, keys, row, shown, dash, run=max(1, width // WORD)).drop("cells")


def ranges_text() -> Column:
    """Ranges with the count of hidden rows, as a report shows them."""
    return F.when(F.col("hidden_rows") > 0, F.concat(
        F.col("ranges"), F.format_string(" … and %d more rows", F.col("hidden_rows")))).otherwise(F.col("ranges"))


def samples(violations: DataFrame, keys: list[str], shown: int = SAMPLES_SHOWN, values: bool = False) -> DataFrame:
    """First findings of every group in row order; cell values only on request."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("row", "col_idx"))
    head = violations.withColumn("sample", place).filter(F.col("sample") <= shown)
    return head if values else head.drop("value")


def by_message(violations: DataFrame) -> DataFrame:
    """Findings numbered by message in sorted order, for a report per message."""
    return number_by(violations, "message", "message_no")


def verdicts(violations: DataFrame, lineage: list[str], files: DataFrame | None = None) -> DataFrame:
    """Errors, warnings, affected columns and the verdict of each file.

    ``files`` lists all files, so that clean ones get their line too.
    """
    error, warning = F.col("severity") == "error", F.col("severity") == "warning"
    per_column = violations.groupBy(*lineage, "col_idx").agg(
        F.count_if(error).alias("_e"), F.count_if(warning).alias("_w"))
    found = per_column.groupBy(*lineage).agg(
        F.sum("_e").alias("errors"), F.sum("_w").alias("warnings"),
        F.count_if(F.col("_e") > 0).alias("error_columns"), F.count_if(F.col("_w") > 0).alias("warning_columns"))
    if files is not None:
        found = files.select(*lineage).distinct().join(found, lineage, "left").fillna(0)
    return found.withColumn("is_valid", F.col("errors") == 0)


def load_metrics(rows: DataFrame, lineage: list[str], blank: Column | None = None) -> DataFrame:
    """Rows written and blank rows skipped per file."""
    blank = F.lit(False) if blank is None else blank
    return rows.groupBy(*lineage).agg(
        F.count_if(~blank).alias("rows_written"), F.count_if(blank).alias("rows_skipped"))


def key_null_flags(rows: DataFrame, keys: list[str], lineage: list[str]) -> DataFrame:
    """Per key column: does any row lack it. Long form, one row per column."""
    flags = rows.groupBy(*lineage).agg(*[F.bool_or(F.col(f"`{k}`").isNull()).alias(k) for k in keys])
    return flags.unpivot(lineage, keys, "key_column", "has_null")


def summary_lines(violations: DataFrame, lineage: list[str], dash: str = "–") -> DataFrame:
    """One log line per file and column: type, column, cells, rows."""
    return sections(violations, [*lineage, *GROUP], dash=dash).select(*lineage, "severity", "col_idx", F.format_string(
        "[%s] column %s — %d cell(s), rows: %s", "expected_type", label(), F.col("cells"), ranges_text()
    ).alias("line"))


def report_text(violations: DataFrame, lineage: list[str], title: Column, generated: str | Column,
                values: bool = False, files: DataFrame | None = None, dash: str = "–") -> DataFrame:
    """Full report per file. A report has one section per affected column.

    Verdicts, counts, ranges and samples all come from the sections, so the findings are read once.
    """
    parts = sections(violations, [*lineage, *GROUP], dash=dash, values=values)
    error = F.col("severity") == "error"
    noun = F.when(error, "error").otherwise("warning")
    lines = [F.format_string("[%s]  column %s  (%d %s(s))", "expected_type", label(), F.col("cells"), noun),
             F.concat(F.lit("  Rows: "), ranges_text())]
    if values:
        shown = F.transform("samples", lambda s: F.concat(F.lit('"'), py_repr(s["value"]), F.lit('" ('), s["cell"], F.lit(")")))
        lines.append(F.when(error, F.concat(F.lit("  Sample values: "), F.array_join(shown, ",  "))))
    body = parts.select(*lineage, "severity", "col_idx", "cells", F.concat_ws("\n", *lines, F.lit("")).alias("_section"))
    ordered = lambda kind: F.array_join(F.sort_array(F.collect_list(F.when(
        F.col("severity") == kind, F.struct("col_idx", "_section"))))["_section"], "\n")
    count = lambda kind: F.sum(F.when(F.col("severity") == kind, F.col("cells")).otherwise(0))
    columns = lambda kind: F.count_distinct(F.when(F.col("severity") == kind, F.col("col_idx")))
    texts = body.groupBy(*lineage).agg(
        ordered("error").alias("_errors"), ordered("warning").alias("_warnings"), count("error").alias("errors"),
        count("warning").alias("warnings"), columns("error").alias("error_columns"), columns("warning").alias("warning_columns"))
    counts = ["errors", "warnings", "error_columns", "warning_columns"]
    if files is not None:
        texts = files.select(*lineage).distinct().join(texts, lineage, "left").fillna(0, counts)
    reports = texts.withColumn("is_valid", F.col("errors") == 0)
    stamp = F.lit(generated) if isinstance(generated, str) else generated
    verdict = F.when(F.col("is_valid"), F.lit("Result: OK — no errors found.")).otherwise(F.format_string(
        "Result: FAILED — %d error(s) in %d column(s)", F.col("errors"), F.col("error_columns")))
    warned = F.when(F.col("warnings") > 0, F.format_string(
        "Warnings: %d warning(s) in %d column(s)", F.col("warnings"), F.col("warning_columns")))
    found = (F.col("errors") > 0) | (F.col("warnings") > 0)
    return reports.select(*lineage, "is_valid", F.concat_ws(
        "\n", F.concat(F.lit("=== Validation Report: "), title, F.lit(" ===")),
        F.concat(F.lit("Generated: "), stamp), F.lit(""), verdict, warned, F.when(found, F.lit("")),
        F.when(F.col("errors") > 0, F.col("_errors")),
        F.when(F.col("warnings") > 0, F.concat(F.lit("--- Warnings ---\n\n"), F.col("_warnings"))),
    ).alias("report"))
