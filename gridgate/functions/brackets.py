"""Balanced parentheses by running depth: expressions over token arrays, nested as deep as the text is.

A token is a run of text that ends in a mark - a parenthesis or a comma - outside quotes. One pass over the tokens keeps the depth;
what ends at depth 0 is cut off. Texts that nest up to ``SHALLOW`` levels are cut by a pattern instead, which gives the same parts faster.
The pattern is fixed, so that a task compiles it once; its possessive loops recurse by level of nesting only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Levels that patterns read.
SHALLOW = 64


def shallow_group(quoted: str | None = None, levels: int = SHALLOW) -> tuple[str, str]:
    """Patterns of plain text and of balanced parentheses up to some levels."""
    plain = rf"[^()']++|{quoted}" if quoted else r"[^()]++"
    group = rf"\((?:{plain})*+\)"
    for _ in range(levels - 1):
        group = rf"\((?:{plain}|{group})*+\)"
    return plain, group


def tokens(text: Column, marks: str, quoted: str | None = None) -> Column:
    """Runs that end in one of ``marks``; what follows the last mark is left out."""
    quote = "'" if quoted else ""
    run = rf"(?:[^{quote}{marks}]++{'|' + quoted if quoted else ''})*+[{marks}]"
    return F.regexp_extract_all(text, F.lit(f"(?s){run}"), F.lit(0))


def deepest(text: Column, quoted: str | None = None) -> Column:
    """The largest depth that parentheses reach."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))

    def step(acc: Column, token: Column) -> Column:
        depth = acc["depth"] + F.when(F.endswith(token, F.lit("(")), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), F.greatest(acc["most"], depth).alias("most"))

    return F.aggregate(tokens(text, "()", quoted), start, step, lambda acc: acc["most"])


def parts(text: Column, quoted: str | None = None) -> Column:
    """The text cut at the commas of depth 0."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, token: Column) -> Column:
        held, mark = F.concat(acc["held"], token), F.right(token, F.lit(1))
        cut = (mark == ",") & (acc["depth"] == 0)
        return F.struct((acc["depth"] + F.when(mark == "(", 1).when(mark == ")", -1).otherwise(0)).alias("depth"),
                        F.when(cut, "").otherwise(held).alias("held"),
                        F.when(cut, F.array_append(acc["out"], F.substring(held, F.lit(1), F.length(held) - 1))).otherwise(acc["out"]).alias("out"))

    plain, group = shallow_group(quoted)
    between = rf"[^(),']++|{quoted}" if quoted else "[^(),]++"
    shallow = text.rlike(f"(?s)^(?:{plain}|{group})*+$")
    return F.when(shallow, F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(f"(?s)((?:{between}|{group})*+),"), F.lit(1))).otherwise(
        F.aggregate(tokens(F.concat(text, F.lit(",")), "(),", quoted), start, step, lambda acc: acc["out"]))


def leading_group(text: Column) -> Column:
    """The balanced group that opens the text; empty where the text opens otherwise or the group never closes."""
    start, closed = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("read")), -1

    def step(acc: Column, token: Column) -> Column:
        depth, over = acc["depth"] + F.when(F.endswith(token, F.lit("(")), 1).otherwise(-1), acc["depth"] == closed
        return F.struct(F.when(over | (depth == 0), closed).otherwise(depth).alias("depth"),
                        (acc["read"] + F.when(over, 0).otherwise(F.length(token))).alias("read"))

    size = F.aggregate(tokens(text, "()"), start, step, lambda acc: F.when(acc["depth"] == closed, acc["read"]).otherwise(0))
    lead = F.get(F.regexp_extract_all(text, F.lit(f"(?s)^{shallow_group()[1]}"), F.lit(0)), F.lit(0))
    return F.coalesce(lead, F.when(F.startswith(text, F.lit("(")), F.substring(text, F.lit(1), size)).otherwise(""))


def groups(text: Column, quoted: str, between: str) -> Column:
    """``struct<groups, tail>``: the balanced groups at the start of the text, with what matches ``between`` before each, and the
    text from the first thing on that is neither."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), F.array().cast("array<string>").alias("out"), F.lit(0).alias("read"),
                     F.lit(False).alias("stop"))
    joint = rf"(?is)^{between}\($"

    def step(acc: Column, token: Column) -> Column:
        opens = F.endswith(token, F.lit("("))
        fresh = acc["depth"] == 0
        stop = acc["stop"] | (fresh & ~(opens & token.rlike(joint)))
        depth = acc["depth"] + F.when(opens, 1).otherwise(-1)
        held = F.when(fresh, "(").otherwise(F.concat(acc["held"], token))
        done = ~stop & (depth == 0)
        return F.struct(F.when(stop, acc["depth"]).otherwise(depth).alias("depth"), F.when(stop, acc["held"]).otherwise(held).alias("held"),
                        F.when(done, F.array_append(acc["out"], held)).otherwise(acc["out"]).alias("out"),
                        (acc["read"] + F.when(stop, 0).otherwise(F.length(token))).alias("read"), stop.alias("stop"))

    def finish(acc: Column) -> Column:
        # An open group counts as unread from its start.
        open_part = F.when(acc["depth"] > 0, F.length(acc["held"])).otherwise(0)
        return F.struct(acc["out"].alias("groups"), F.substring(text, acc["read"] - open_part + 1, F.length(text)).alias("tail"))

    return F.aggregate(tokens(text, "()", quoted), start, step, finish)
