"""Apply a contract: one pass over the rows, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate.functions.cells import column_letter
from gridgate.functions.rules import FAULT_TYPE, Slots, Verdict, finding, rule_for
from gridgate.functions.text import sql_name, sql_text
from gridgate.operators.contract import Contract

FAULTS = "_faults"
KEY_NULL = "'key column is NULL'"


def _by_kind(rule, name: str, kind: str, at: int) -> tuple[list[tuple[str, str]], Verdict, dict[str, str]]:
    """Numbers and booleans of a typed source are judged as such, everything else as text.

    Result: columns to add first, one verdict out of one per kind, and what each
    kind parses. Fractions are doubles, so a decimal rounds them before it counts
    digits; integers read the same as text. Dates and times know only text.
    """
    cell = sql_name(name)
    forms = {"": (cell, T.StringType())}
    if not getattr(rule, "temporal", False):
        forms |= {"float": (f"_float_{at}", T.DoubleType()), "bool": (f"_bool_{at}", T.BooleanType())}
    cast = {"float": "double", "bool": "boolean"}
    natives = [(f"_{k}_{at}", f"case when {kind} = '{k}' then try_cast({cell} as {cast[k]}) end") for k in forms if k]
    verdicts = {k: rule(c, source, Slots(f"_parsed_{at}{k}", f"_kept_{at}")) for k, (c, source) in forms.items()}
    text = verdicts.pop("")
    choose = lambda part: "case " + " ".join(
        f"when {kind} = '{k}' then {part(v)}" for k, v in verdicts.items()) + f" else {part(text)} end" if verdicts else part(text)
    parsed = {f"_parsed_{at}{k}": v.parsed for k, v in [("", text), *verdicts.items()] if v.parsed}
    return natives, Verdict(choose(lambda v: v.value), choose(lambda v: v.fault)), parsed


def apply_contract(df: DataFrame, contract: Contract, columns: list[str] | None = None,
                   options: dict | None = None, kinds: str | None = None) -> DataFrame:
    """Accepted values in place of the raw ones, plus ``_faults``.

    A rejected cell becomes NULL. ``_faults`` is NULL for rows without findings,
    so clean rows build no array; else it has one slot per checked column.
    Columns without a declared type pass as they are. A NULL in a key column is
    a warning; other NULLs are never checked. ``kinds`` names an array column
    with the kind of every text cell, in the order of ``columns``: numbers in it
    are judged like native ones.

    Four projections keep every expression in the plan once: parse, accept,
    judge, gather. Spark runs them as one stage.
    """
    columns = columns or [c.name for c in contract.columns if c.name in df.columns]
    native, parsed, accepted, judged, values, faults = [], [], [], [], {}, []
    for i, name in enumerate(columns):
        spec, cell, fault = contract.spec(name), sql_name(name), f"_fault_{i}"
        slots = Slots(f"_parsed_{i}", f"_kept_{i}")
        if spec is None:
            continue
        key_null = f"when {cell} is null then {finding(cell, 'warning', 'key_null', KEY_NULL)}"
        if spec.type_text is None:
            if spec.is_key:
                judged.append(F.expr(f"case {key_null} end").alias(fault))
                faults.append((i, fault))
            continue
        rule, source = rule_for(spec.type_text, contract.dialect, options), df.schema[name].dataType
        if kinds and isinstance(source, T.StringType):
            natives, verdict, needed = _by_kind(rule, name, f"get({sql_name(kinds)}, {i})", i)
            native += [F.expr(sql).alias(n) for n, sql in natives]
            parsed += [F.expr(sql).alias(n) for n, sql in needed.items()]
        else:
            verdict = rule(cell, source, slots)
            if verdict.parsed:
                parsed.append(F.expr(verdict.parsed).alias(slots.parsed))
        accepted.append(F.expr(verdict.value).alias(slots.kept))
        values[name] = F.col(slots.kept).alias(name)
        sql = f"case {key_null} else {verdict.fault} end" if spec.is_key else verdict.fault
        if "named_struct" in sql:
            judged.append(F.expr(sql).alias(fault))
            faults.append((i, fault))
    found = (f"case when coalesce({', '.join(f for _, f in faults)}) is not null "
             f"then array({', '.join(f for _, f in faults)}) end" if faults
             else f"cast(null as array<{FAULT_TYPE}>)")
    rows = df
    for step in (native, parsed, accepted, judged):
        rows = rows.select("*", *step) if step else rows
    return rows.select(
        *[values.get(n, F.col(sql_name(n))) for n in df.columns], F.expr(found).alias(FAULTS))


def checked_columns(contract: Contract, columns: list[str]) -> list[int]:
    """Column index behind every slot of ``_faults``."""
    def judged(name):
        spec = contract.spec(name)
        if spec is None:
            return False
        rule = spec.type_text and rule_for(spec.type_text, contract.dialect)("c", T.StringType(), Slots("p", "k"))
        return spec.is_key or bool(rule and "named_struct" in rule.fault)

    return [i for i, name in enumerate(columns) if judged(name)]


def violations(checked: DataFrame, contract: Contract, columns: list[str], lineage: list[str],
               row: str, skip_cols: int = 0) -> DataFrame:
    """Long form: one row per finding.

    ``row`` is SQL for the 1-based sheet row. Names, letters and types come from
    the contract on the driver. The outer form of explode keeps Spark from
    inferring a filter below it that would evaluate every rule a second time.
    """
    order = checked_columns(contract, columns)
    pick = lambda items: f"element_at(array({', '.join(items)}), _at + 1)"
    letters = pick([sql_text(column_letter(i + skip_cols)) for i in order] or ["''"])
    types = pick([sql_text(contract.spec(columns[i]).type_text or "unknown") for i in order] or ["''"])
    found = (checked.select(*lineage, F.expr(row).alias("row"), F.posexplode_outer(FAULTS).alias("_at", "f"))
             .filter("f is not null"))
    return found.select(
        *lineage, "row", F.expr(pick([str(i) for i in order] or ["0"])).alias("col_idx"),
        F.expr(letters).alias("col_letter"),
        F.expr(pick([sql_text(columns[i]) for i in order] or ["''"])).alias("col_name"),
        F.expr(f"concat({letters}, row)").alias("cell"), F.expr(types).alias("expected_type"),
        "f.severity", "f.code", "f.message", "f.value")
