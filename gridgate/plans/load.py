"""One intake run: scan, contract, check, gate, publish, report."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.config import FILE_EXPORTS, PLACEHOLDER_TABLE, IntakeConfig
from gridgate.errors import ConfigurationError, DataValidationError, SourceError
from gridgate.operators import reports
from gridgate.operators.contract import (
    CH_LATTICE, GP_LATTICE, Contract, contract_from_ddl, contract_of_table, infer_contract)
from gridgate.operators.project import add_lineage, clean_cells, insert_fixed, is_blank_row
from gridgate.operators.template import (
    DATA_SHEET, collect_template, data_headers, expected_headers, fixed_by_file, start_rows, template_contract,
    templates, unlike)
from gridgate.operators.headers import alignment
from gridgate.operators.validate import FAULTS, apply_contract, violations
from gridgate.plans import publish as tables
from gridgate.plans.sinks import in_order, split_statements, write_csv, write_dump, write_reports
from gridgate.session import prepare, scratch_path, staged
from gridgate.sources.delimited import Scan, open_delimited
from gridgate.sources.insert_dump import first_table, open_insert_dump
from gridgate.sources.positions import FILE, KINDS, ORDINAL, SPLIT, TICK, Placed, Reading, settle
from gridgate.sources.routing import source_format, table_or_dump_name
from gridgate.sources.workbook import read_sheets, scan_workbooks

BLANK = "_blank"


@dataclass(frozen=True)
class Template:
    """Definitions shared by the template workbooks of a run, and what differs by file."""

    contract: Contract
    skip_rows: int
    fixed: DataFrame | None
    rejected: DataFrame


@dataclass(frozen=True)
class Outcome:
    """Frames of a finished run; all of them are lazy and read staged rows."""

    contract: Contract | None
    metrics: DataFrame
    violations: DataFrame | None
    verdicts: DataFrame | None
    rejected: DataFrame
    output: str | None = None
    table: str | None = None


def run_load(spark: SparkSession, config: IntakeConfig) -> Outcome:
    """Read ``config.source``, check it and publish it.

    The rows are read once and written to the scratch folder once, checked or as
    they are. Row numbers, findings, metrics, the gate and the sink all read that
    copy, each only the columns it needs; nothing is published before the gate.
    Only findings meet row numbers. ``verify`` never publishes and keeps the
    findings alone.
    """
    prepare(spark)
    reading, template, table = _open(spark, config)
    _refuse(reading.rejected)
    contract = _contract(spark, config, reading, template, table)
    checking = config.error_mode != "ignore"
    if checking and config.policy == "none" and contract is None:
        checking = False
    if checking and contract is None:
        raise ConfigurationError("a checked error mode needs a contract")
    columns, kinds = reading.columns, KINDS if reading.typed else None

    def cleaned(rows: DataFrame) -> DataFrame:
        return clean_cells(rows.withColumn(BLANK, is_blank_row(columns)), columns, config.strip, config.blank_to_null)

    def checked(rows: DataFrame) -> DataFrame:
        judged = apply_contract(cleaned(rows), contract, columns, config.rule_options, kinds)
        return judged.drop(*columns, KINDS) if config.error_mode == "verify" else judged

    placed = settle(reading, checked if checking else cleaned, "checked" if checking else "rows")
    _refuse(placed.rejected)
    if not checking:
        return _finish(spark, config, reading, placed, contract, template, table)
    rows = placed.rows
    faulty = placed.numbered(rows.filter(~F.col(BLANK) & F.col(FAULTS).isNotNull()))
    found = staged(violations(faulty, contract, columns, [FILE], reading.row, reading.skip_cols), "violations")
    files = rows.select(FILE).distinct()
    outcome = Outcome(contract, _metrics(rows), found, reports.verdicts(found, [FILE], files), placed.rejected)
    broken = found.filter("severity = 'error'").limit(1).collect()
    if config.report_dir and broken:
        title = F.element_at(F.split(FILE, "/"), -1)
        write_reports(reports.report_text(found, [FILE], title, F.date_format(
            F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), config.report_values), config.report_dir)
    if broken and config.error_mode in ("raise", "verify"):
        raise DataValidationError("the data breaks its contract", outcome)
    if config.error_mode == "verify":
        return outcome
    return _finish(spark, config, reading, placed, contract, template, table, outcome)


def _refuse(rejected: DataFrame) -> None:
    lost = rejected.limit(1).collect() if rejected is not None else []
    if lost:
        raise SourceError(f"{lost[0][FILE]}: {lost[0].reason}")


def _metrics(rows: DataFrame) -> DataFrame:
    return reports.load_metrics(rows, [FILE], F.col(BLANK))


def _open(spark: SparkSession, config: IntakeConfig) -> tuple[Reading, Template | None, str]:
    kind = source_format(spark, config.source)
    common = dict(skip_rows=config.skip_rows, skip_cols=config.skip_cols, max_row=config.max_row)
    if kind == "delimited":
        reading = open_delimited(spark, config.source, None if config.delimiter == "," else config.delimiter,
                                 config.encoding_input, quoted_newlines=config.quoted_newlines, **common)
        return reading, None, config.table_name
    if kind == "dump":
        wanted = None
        if config.table_name == PLACEHOLDER_TABLE:
            wanted = first_table(spark, config.source, config.dialect, config.encoding_input,
                                 config.dump_separator, config.whole_files)
        reading = open_insert_dump(spark, config.source, wanted or config.table_name, config.dialect,
                                   config.encoding_input, config.dump_separator, config.whole_files)
        return reading, None, table_or_dump_name(config.table_name, wanted or config.table_name)
    files = spark.read.format("binaryFile").load(config.source)
    sheets = staged(read_sheets(files), "sheets")
    template = _template(sheets, config.dialect)
    if template is None:
        scan = scan_workbooks(spark, files, config.sheet_name, decoded=sheets, **common)
        return _numbered_reading(scan, scan.columns, scan.rejected), None, config.table_name
    contract = template.contract
    names = [c.name for c in contract.columns if c.fixed is None]
    displays = [c.display.lower() for c in contract.columns if c.fixed is None]
    scan = scan_workbooks(spark, files, DATA_SHEET, template.skip_rows, config.skip_cols, config.max_row,
                          check_header=False, columns=displays, decoded=sheets)
    return _numbered_reading(scan, names, scan.rejected.union(template.rejected)), template, config.table_name


def _numbered_reading(scan: Scan, names: list[str], rejected: DataFrame) -> Reading:
    """Sheets know the numbers of their rows."""
    rows = scan.rows.toDF(FILE, TICK, *names).withColumn(SPLIT, F.lit(0).cast("bigint"))
    return Reading(rows, names, skip_cols=scan.skip_cols, row_base=scan.row_base, rejected=rejected, exact=True)


def _template(sheets: DataFrame, dialect: str) -> Template | None:
    """What the template workbooks among the sheets agree on; None without any."""
    lead = templates(sheets).filter("is_template").orderBy(FILE).first()
    if lead is None:
        return None
    starts, rows = start_rows(sheets), staged(template_contract(sheets), "template")
    start, mine = starts.filter(F.col(FILE) == lead[FILE]).first(), rows.filter(F.col(FILE) == lead[FILE])
    if start is None or start.problem:
        raise SourceError(f"{lead[FILE]}: {start.problem if start else 'no start address'}")
    contract = collect_template(mine, dialect)
    gaps = alignment(data_headers(sheets), expected_headers(rows), [FILE]).orderBy(FILE, "pos").limit(5).collect()
    if gaps:
        raise SourceError("header mismatch between data and configuration sheet: " + "; ".join(
            f"{g[FILE]} {g.pos}: {g.found_name!r} vs {g.expected_name!r}" for g in gaps))
    fixed = [c.name for c in contract.columns if c.fixed is not None]
    return Template(contract, start.skip_rows, fixed_by_file(rows, fixed) if fixed else None,
                    unlike(sheets, rows, lead[FILE]))


def _inferred(reading: Reading, config: IntakeConfig) -> Contract:
    """Types by the kinds of the cells. Cells without kinds are text, which no pass over the rows would change."""
    if not reading.typed:
        return Contract.of(dict.fromkeys(reading.columns, GP_LATTICE[0] if config.dialect == "gp" else CH_LATTICE[0]), config.dialect)
    rows = reading.rows
    if config.infer_rows is not None:
        rows = settle(reading).numbered(rows)
    return infer_contract(rows, reading.columns, config.dialect, ordinal=ORDINAL, sample=config.infer_rows, kinds=KINDS)


def _contract(spark: SparkSession, config: IntakeConfig, reading: Reading, template: Template | None,
              table: str) -> Contract | None:
    """Contract by policy: given types, table or template with inference behind them, DDL."""
    inferred = lambda: _inferred(reading, config)
    if config.dtypes:
        contract = Contract.of(config.dtypes, config.dialect)
    elif config.policy == "bd":
        contract = contract_of_table(spark, f"{config.scheme_name}.{table}", config.dialect) or inferred()
    elif config.policy == "ods_template":
        contract = template.contract if template else inferred()
    elif config.policy == "user_string":
        contract = contract_from_ddl(spark, config.ddl, config.dialect)
    else:
        contract = template.contract if template else None
    if contract is None:
        return None
    return contract.with_keys({c.name for c in template.contract.columns if c.is_key} if template else config.key_columns)


PLACE = (FILE, SPLIT, TICK)


def _finish(spark: SparkSession, config: IntakeConfig, reading: Reading, placed: Placed, contract: Contract | None,
            template: Template | None, table: str, outcome: Outcome | None = None) -> Outcome:
    """Fixed columns, lineage columns, sink."""
    rows = placed.rows.drop(FAULTS)
    metrics = outcome.metrics if outcome else _metrics(rows)
    live = rows.filter(~F.col(BLANK)).drop(BLANK)
    if template is not None:
        live = insert_fixed(live, template.contract, PLACE, template.fixed)
    aside = (*PLACE, KINDS)
    columns = [c for c in live.columns if c not in aside]
    stamp = F.lit(spark.sql("select current_timestamp() t").first().t)
    named = F.element_at(F.split(FILE, "/"), -1) if config.source_name_column else None
    ready = add_lineage(live, columns, config.timestamp_column, stamp, named)
    columns = [c for c in ready.columns if c not in aside]
    path, target = None, f"{config.scheme_name}.{table}"
    if config.export in FILE_EXPORTS:
        path = scratch_path(spark, "output") if config.output_dir is None else f"{config.output_dir}/{_run_name(spark, config.source)}"
        _write_files(ready, columns, path, target, config, _open_kinds(reading, contract if outcome else None))
        target = None
    else:
        tables.publish(ready.select(*columns), target, config.export, contract)
    return Outcome(contract, metrics, outcome and outcome.violations, outcome and outcome.verdicts,
                   placed.rejected, path, target)


def _open_kinds(reading: Reading, checked_by: Contract | None) -> dict[str, Column]:
    """Kinds of the typed cells that no declared type has replaced."""
    declared = checked_by.types() if checked_by else {}
    return {c: F.get(KINDS, F.lit(i)) for i, c in enumerate(reading.columns) if c not in declared} if reading.typed else {}


def _write_files(ready: DataFrame, columns: list[str], path: str, target: str, config: IntakeConfig,
                 kinds: dict[str, Column]) -> None:
    if config.export == "csv":
        write_csv(in_order(ready, list(PLACE)).select(*columns), path, config.delimiter, config.encoding_output)
        return
    statements = split_statements(ready, columns, target, config.dialect, config.batch_size, list(PLACE), config.quote_all, kinds)
    write_dump(statements, path, encoding=config.encoding_output)


def _run_name(spark: SparkSession, source: str) -> str:
    """``<stem of the source>_<ddmmyy_HHMMSS>_<token>``: two runs in one second do not meet."""
    base = source.rstrip("/").rsplit("/", 1)[-1]
    stem = re.sub(r"[^\w-]+", "", base.rsplit(".", 1)[0]) or "run"
    stamp = spark.sql("select date_format(current_timestamp(), 'ddMMyy_HHmmss') t").first().t
    return f"{stem}_{stamp}_{uuid.uuid4().hex[:6]}"
