"""Rows that fail to parse: typed records on one side, rejected lines with reasons on the other.

A line is cut at its tabs, the cells are exploded to (line, column, value), joined with a table of rules,
judged cell by cell, and the verdicts are gathered per line; rules that compare cells of one line follow on
the gathered row. Clean lines are those that an anti-join with the rejected ones leaves.

Defined cases: a null or empty line fails with ``empty line``; a wrong number of fields fails with
``field count`` and its cells are not judged; a line delivered more than once counts once, in its latest
version; a line without line_id is rejected as ``no line id``, each by itself; one carriage return at the end is
dropped, a second one is content. Numbers of any length are compared digit by digit; in typed records a number beyond
the column's type is null, and ``beyond`` names its column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = r"^[0-9]+\z"
DECIMAL = r"^[0-9]+(\.[0-9]+)?\z"

#: The judgements a rule table may name; each takes the unquoted cell.
CHECKS: dict[str, Callable[[Column], Column]] = {
    "whole": lambda v: v.rlike(WHOLE),
    "whole from 1": lambda v: v.rlike(r"^0*[1-9][0-9]*\z"),
    "decimal": lambda v: v.rlike(DECIMAL),
    "decimal above 0": lambda v: v.rlike(DECIMAL) & v.rlike("[1-9]"),
    "decimal to 100": lambda v: v.rlike(r"^0*([0-9]{1,2}(\.[0-9]+)?|100(\.0+)?)\z"),
    "decimal to 1": lambda v: v.rlike(r"^(0+(\.[0-9]+)?|0*1(\.0+)?)\z"),
    "text": lambda v: v.rlike(r"(?U)\S"),
    "three parts": lambda v: v.rlike(r"(?U)^[^/\s]+/[^/\s]+/[^/\s]+\z"),
    "whole list": lambda v: v.rlike(r"^[0-9]+(,[0-9]+)*\z"),
    "bases": lambda v: v.rlike(r"^[ACGTNacgtn]+\z"),
    "regions": lambda v: v.rlike(
        r"^ *[A-Za-z0-9_.]+:0*[1-9][0-9]*-0*[1-9][0-9]* *([;,] *[A-Za-z0-9_.]+:0*[1-9][0-9]*-0*[1-9][0-9]* *)*\z"
    ),
}


@dataclass(frozen=True)
class Layout:
    """Columns of a line as (name, type, check), and row rules as reason -> condition that must hold."""

    name: str
    columns: tuple[tuple[str, str, str], ...]
    row_rules: dict[str, Callable[[dict[str, Column]], Column]] = field(default_factory=dict)


def digits(v: Column) -> Column:
    """Orders strings of digits by value, whatever their length."""
    bare = F.regexp_replace(v, "^0+", "")
    return F.struct(F.length(bare).alias("n"), bare.alias("d"))


def _rising(v: Column) -> Column:
    items = F.transform(F.split(v, ","), digits)
    return (items == F.array_sort(items)) & (F.size(F.array_distinct(items)) == F.size(items))


TANDEM = Layout(
    "tandem_raw",
    (
        ("readName", "string", "three parts"), ("repN", "string", "text"), ("copyNum", "double", "decimal above 0"),
        ("readLen", "bigint", "whole"), ("start", "bigint", "whole from 1"), ("end", "bigint", "whole"),
        ("consLen", "bigint", "whole"), ("aveMatch", "double", "decimal to 100"), ("fullLen", "bigint", "whole"),
        ("subPos", "string", "whole list"), ("consSeq", "string", "bases"),
    ),
    {
        "start after end": lambda c: digits(c["start"]) <= digits(c["end"]),
        "end after readLen": lambda c: digits(c["end"]) <= digits(c["readLen"]),
        "subPos not rising": lambda c: _rising(c["subPos"]),
        "subPos not from start": lambda c: digits(F.split(c["subPos"], ",")[0]) == digits(c["start"]),
        "subPos after end": lambda c: digits(F.element_at(F.split(c["subPos"], ","), -1)) <= digits(c["end"]),
        "consLen is not the length": lambda c: digits(c["consLen"]) == digits(F.length(c["consSeq"]).cast("string")),
    },
)

OVERVIEW = Layout(
    "overview_raw",
    (
        ("regions", "string", "regions"), ("circle_length", "bigint", "whole from 1"), ("segment_count", "int", "whole"),
        ("num_split_reads", "int", "whole"), ("prob_present", "double", "decimal to 1"),
        ("prob_artifact", "double", "decimal to 1"), ("af_nanopore", "double", "decimal to 1"),
    ),
    {
        "segment_count is not the number of regions": lambda c: digits(c["segment_count"])
        == digits(F.size(F.split(c["regions"], "[;,]")).cast("string")),
    },
)


def latest_lines(lines: DataFrame) -> DataFrame:
    """One row (line_id, raw) for each line_id, the one loaded last."""
    return lines.where("line_id is not null").groupBy("line_id").agg(F.max_by("raw", F.struct("loaded_at", F.coalesce("raw", F.lit("")))).alias("raw"))


def judge(lines: DataFrame, layout: Layout) -> DataFrame:
    """line_id, cells (struct of unquoted strings), errors (sorted reasons, empty for a clean line)."""
    spark, width = lines.sparkSession, len(layout.columns)
    rules = F.broadcast(  # as many rows as the layout has columns
        spark.createDataFrame([(i, n, c) for i, (n, _, c) in enumerate(layout.columns)], "col int, name string, check string")
    )
    cells = F.split(F.regexp_replace("raw", r"\r\z", ""), "\t", -1)
    cut = latest_lines(lines).select("line_id", F.coalesce(F.length("raw"), F.lit(0)).alias("chars"), cells.alias("cells"))
    shape = F.when((F.col("chars") == 0) | ((F.size("cells") == 1) & (F.col("cells")[0] == "")), "empty line").when(F.size("cells") != width, "field count")
    exploded = cut.select("line_id", shape.alias("shape"), F.posexplode_outer(F.when(shape.isNull(), F.col("cells"))).alias("col", "cell"))
    enclosed = F.col("cell").rlike(r'^"[^"]*"\z')
    values = exploded.withColumn("value", F.when(enclosed, F.expr("substring(cell, 2, length(cell) - 2)")).otherwise(F.col("cell")))
    value = F.col("value")
    passes = F.lit(False)
    for check in sorted({c for _, _, c in layout.columns}):
        passes = F.when(F.col("check") == check, CHECKS[check](value)).otherwise(passes)
    reason = (
        F.when(F.col("shape").isNotNull(), F.col("shape"))
        .when(value.contains('"'), F.concat(F.col("name"), F.lit(": quoting")))
        .when(~passes, F.concat_ws(": not ", "name", "check"))
    )
    judged = values.join(rules, "col", "left").withColumn("reason", reason)
    gathered = judged.groupBy("line_id").agg(
        F.collect_set("reason").alias("errors"),
        *(F.max(F.when(F.col("col") == i, value)).alias(f"c{i}") for i in range(width)),
    )
    by_name = {n: F.col(f"c{i}") for i, (n, _, _) in enumerate(layout.columns)}
    across = [F.when(~holds(by_name), F.lit(why)) for why, holds in layout.row_rules.items()]
    across = F.when(F.size("errors") == 0, F.array_compact(F.array(*across))).otherwise(F.array().cast("array<string>"))
    cells = F.struct(*(F.col(f"c{i}").alias(n) for i, (n, _, _) in enumerate(layout.columns))).alias("cells")
    nothing = F.struct(*(F.lit(None).cast("string").alias(n) for n, _, _ in layout.columns)).alias("cells")
    nameless = lines.where("line_id is null").select("line_id", nothing, F.array(F.lit("no line id")).alias("errors"))
    return gathered.select("line_id", cells, F.array_sort(F.concat("errors", across)).alias("errors")).unionByName(nameless)


def rejected(judged: DataFrame) -> DataFrame:
    """line_id, errors of the lines that fail."""
    return judged.where(F.size("errors") > 0).select("line_id", "errors")


def records(judged: DataFrame, layout: Layout) -> DataFrame:
    """The clean lines as typed records: an anti-join against the rejected ones."""
    clean = judged.where("line_id is not null").join(rejected(judged), "line_id", "left_anti")
    typed = {n: F.col(f"cells.{n}").try_cast(t) for n, t, _ in layout.columns}
    beyond = F.concat_ws(",", *(F.when(v.isNull(), n) for n, v in typed.items()))
    return clean.select("line_id", *(v.alias(n) for n, v in typed.items()), beyond.alias("beyond"))
