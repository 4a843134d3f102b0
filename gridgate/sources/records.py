"""Records of delimited files whose quoted cells hold line ends, put together from lines of any split.

Whether a line starts inside a quoted cell depends on all lines before it. Each line is a map from that state to the next one: most
keep it, some fix it, some turn it round. Maps compose, so the state before a line of a split follows from the split's first state,
the last line that fixed it and the number of turns since; the first state of a split follows the same way from the maps of the
earlier splits, one row each. A record begins at every line that starts outside quotes; lines at the start of a split that continue
a record go to the split where it began.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgate.session import staged
from gridgate.sources.positions import FILE, SPLIT, TICK, TORN


def closed(text: Column, delimiter: str) -> Column:
    """True where the text, read from the start of a cell, ends outside quotes."""
    other = f"[^{re.escape(delimiter)}]*+"
    cell = rf'(?:"(?:[^"]++|"")*+"{other}|(?!"){other})'
    return text.rlike(rf"(?s)^{cell}(?:{re.escape(delimiter)}{cell})*+$")


def torn(text: Column, delimiter: str) -> Column:
    """True where a line that starts outside quotes ends inside them."""
    return F.contains(text, F.lit('"')) & ~closed(text, delimiter)


def _turned(state: Column, turns: Column) -> Column:
    return state != (turns % 2 == 1)


def _state(first: Column, fixed: Column, turns: Column) -> Column:
    """State after some lines: ``fixed`` is the last one that set it, with the turns up to it, NULL without any."""
    return F.when(fixed.isNull(), _turned(first, turns)).otherwise(_turned(fixed["to"], turns - fixed["turns"]))


def assemble(lines: DataFrame, delimiter: str) -> DataFrame:
    """Lines with file, split and running id to records: ``_file, _split, _tick, value, _torn``.

    Running ids of a split's records are consecutive from its first line on. A line end inside a record is a line feed, or what
    stood there where lines were cut at line feeds. In a file that ends inside quotes the lines stay apart and are all ``_torn``.

    The source is read once. Its lines are written with the number of records begun so far for either first state of their split, so
    that the few columns which settle that state are read back alone, and lines meet one row per split before they are grouped.
    """
    value = F.col("value")
    held = lines.select(FILE, SPLIT, TICK, "value", torn(value, delimiter).alias("_out"), torn(F.concat(F.lit('"'), value), delimiter).alias("_in"))
    order = Window.partitionBy(FILE, SPLIT).orderBy(TICK)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("_out") & ~F.col("_in")).cast("int")
    held = held.withColumn("_turns", F.sum(turn).over(so_far)).withColumn("_fix", F.when(
        F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("to"), F.col("_turns").alias("turns"))))
    held = held.withColumn("_fixed", F.last("_fix", ignorenulls=True).over(earlier)).withColumn("_past", F.col("_turns") - turn)
    begun = lambda first: F.sum((~_state(F.lit(first), F.col("_fixed"), F.col("_past"))).cast("int")).over(so_far)
    held = staged(held.select(FILE, SPLIT, TICK, "value", "_turns", F.coalesce("_fix", "_fixed").alias("_fixed"),
                              begun(False).alias("_from_out"), begun(True).alias("_from_in")), "lines")
    splits = Window.partitionBy(FILE).orderBy(SPLIT)
    before = splits.rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy(FILE, SPLIT).agg(F.min(TICK).alias("_first"), F.max(F.struct(
        TICK, "_turns", "_fixed", "_from_out", "_from_in")).alias("_end")).select(FILE, SPLIT, "_first", "_end.*")
    fixes = F.col("_fixed").isNotNull()
    ends = ends.withColumn("_own", F.when(fixes, 0).otherwise(F.col("_turns") % 2)).withColumn("_sum", F.sum("_own").over(splits)).withColumn(
        "_set", F.when(fixes, F.struct(_state(F.lit(False), F.col("_fixed"), F.col("_turns")).alias("to"), F.col("_sum").alias("turns"))))
    ends = ends.withColumn("_inside", _state(F.lit(False), F.last("_set", ignorenulls=True).over(before), F.col("_sum") - F.col("_own")))
    ends = ends.withColumn("_open", F.max_by(_state(F.col("_inside"), F.col("_fixed"), F.col("_turns")), SPLIT).over(Window.partitionBy(FILE)))
    last = F.col("_first") + F.when(F.col("_inside"), F.col("_from_in")).otherwise(F.col("_from_out")) - 1
    owner = F.last(F.when(last >= F.col("_first"), F.struct(F.col(SPLIT).alias("split"), last.alias("tick"))), ignorenulls=True).over(before)
    ends = staged(ends.select(FILE, SPLIT, "_first", "_inside", "_open", owner.alias("_owner")), "states")
    number = F.when(F.col("_inside"), F.col("_from_in")).otherwise(F.col("_from_out"))
    tick = F.when(F.col("_open"), F.col(TICK)).when(number == 0, F.col("_owner.tick")).otherwise(F.col("_first") + number - 1)
    split = F.when(~F.col("_open") & (number == 0), F.col("_owner.split")).otherwise(F.col(SPLIT))
    record = held.join(ends, [FILE, SPLIT]).select(
        FILE, split.alias("_at"), tick.alias("_no"), F.struct(SPLIT, TICK, "value").alias("_line"), "_open")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("_line")), lambda line: line["value"]), "\n")
    return record.groupBy(FILE, F.col("_at").alias(SPLIT), F.col("_no").alias(TICK)).agg(
        F.regexp_replace(joined, r"\r$", "").alias("value"), F.bool_or("_open").alias(TORN))
