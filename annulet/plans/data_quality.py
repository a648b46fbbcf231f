"""Queries of the general training-data problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.operators import interval_sweep, packed_values, parse_errors
from annulet.session import table


def _judged(spark: SparkSession, d: str, layout: parse_errors.Layout) -> DataFrame:
    return parse_errors.judge(table(spark, d, layout.name), layout)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        parse_errors.rejected(_judged(spark, d, x)).select(F.lit(x.name).alias("src"), "line_id") for x in (parse_errors.TANDEM, parse_errors.OVERVIEW)
    ]
    return parts[0].unionByName(parts[1])


def p1_reasons(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        parse_errors.rejected(_judged(spark, d, x)).select(F.lit(x.name).alias("src"), F.explode("errors").alias("reason"))
        for x in (parse_errors.TANDEM, parse_errors.OVERVIEW)
    ]
    return parts[0].unionByName(parts[1]).groupBy("src", "reason").agg(F.count("*").alias("lines"))


def p1_tandem_records(spark: SparkSession, d: str) -> DataFrame:
    return parse_errors.records(_judged(spark, d, parse_errors.TANDEM), parse_errors.TANDEM)


def p1_overview_records(spark: SparkSession, d: str) -> DataFrame:
    return parse_errors.records(_judged(spark, d, parse_errors.OVERVIEW), parse_errors.OVERVIEW)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "inferred_simple").where(r"sample rlike '(?U)\\S'")
    return interval_sweep.sweep(df.select("sample", interval_sweep.chromosome(F.col("chr")).alias("chr"), "start0", "end0"), ["sample", "chr"], "start0", "end0")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    regions = packed_values.stack_fields(table(spark, d, "split_overview"), "rec_id", ["regions"], "loaded_at")
    lists = packed_values.stack_fields(table(spark, d, "ecc_core"), "rec_id", ["reads", "per_read_copy_number"], "loaded_at")
    return packed_values.unpack(regions.unionByName(lists))


QUERIES = {
    "p1_found": p1_found, "p1_reasons": p1_reasons, "p1_tandem_records": p1_tandem_records,
    "p1_overview_records": p1_overview_records, "p5_found": p5_found, "p6_found": p6_found,
}

_CELLS = r"""
SELECT line_id, [CASE WHEN regexp_full_match(x, '"[^"]*"') THEN substr(x, 2, length(x) - 2) ELSE x END
  FOR x IN string_split(regexp_replace(raw, '\r$', ''), chr(9))] AS f
FROM (SELECT line_id, arg_max(raw, loaded_at) AS raw FROM {t} GROUP BY line_id)
"""
_N = lambda x: f"TRY_CAST({x} AS HUGEINT)"
_TANDEM_OK = rf"""
len(f) = 11 AND regexp_full_match(f[1], '[^/\s\pZ"]+/[^/\s\pZ"]+/[^/\s\pZ"]+') AND regexp_matches(f[2], '[^\s\pZ]') AND NOT contains(f[2], '"')
AND regexp_full_match(f[3], '[0-9]+(\.[0-9]+)?') AND TRY_CAST(f[3] AS DOUBLE) > 0
AND regexp_full_match(f[4], '[0-9]+') AND regexp_full_match(f[5], '[0-9]+') AND regexp_full_match(f[6], '[0-9]+')
AND regexp_full_match(f[7], '[0-9]+') AND regexp_full_match(f[9], '[0-9]+')
AND 1 <= {_N('f[5]')} AND {_N('f[5]')} <= {_N('f[6]')} AND {_N('f[6]')} <= {_N('f[4]')}
AND regexp_full_match(f[8], '[0-9]+(\.[0-9]+)?') AND TRY_CAST(f[8] AS DOUBLE) <= 100
AND regexp_full_match(f[10], '[0-9]+(,[0-9]+)*')
AND [{_N('x')} FOR x IN string_split(f[10], ',')] = list_sort(list_distinct([{_N('x')} FOR x IN string_split(f[10], ',')]))
AND {_N("string_split(f[10], ',')[1]")} = {_N('f[5]')} AND {_N("string_split(f[10], ',')[-1]")} <= {_N('f[6]')}
AND regexp_full_match(f[11], '[ACGTNacgtn]+') AND {_N('f[7]')} = length(f[11])
"""
_REGION = r"[A-Za-z0-9_.]+:0*[1-9][0-9]*-0*[1-9][0-9]*"
_OVERVIEW_OK = rf"""
len(f) = 7 AND regexp_full_match(f[1], ' *{_REGION} *([;,] *{_REGION} *)*')
AND regexp_full_match(f[2], '[0-9]+') AND {_N('f[2]')} >= 1 AND regexp_full_match(f[3], '[0-9]+')
AND {_N('f[3]')} = len(regexp_extract_all(f[1], '[;,]')) + 1 AND regexp_full_match(f[4], '[0-9]+')
AND regexp_full_match(f[5], '[0-9]+(\.[0-9]+)?') AND TRY_CAST(f[5] AS DOUBLE) <= 1
AND regexp_full_match(f[6], '[0-9]+(\.[0-9]+)?') AND TRY_CAST(f[6] AS DOUBLE) <= 1
AND regexp_full_match(f[7], '[0-9]+(\.[0-9]+)?') AND TRY_CAST(f[7] AS DOUBLE) <= 1
"""


_TANDEM_RULES = {
    "start after end": f"{_N('f[5]')} <= {_N('f[6]')}", "end after readLen": f"{_N('f[6]')} <= {_N('f[4]')}",
    "subPos not rising": f"[{_N('x')} FOR x IN string_split(f[10], ',')] = list_sort(list_distinct([{_N('x')} FOR x IN string_split(f[10], ',')]))",
    "subPos not from start": f"""{_N("string_split(f[10], ',')[1]")} = {_N('f[5]')}""", "subPos after end": f"""{_N("string_split(f[10], ',')[-1]")} <= {_N('f[6]')}""",
    "consLen is not the length": f"{_N('f[7]')} = length(f[11])",
}
_OVERVIEW_RULES = {"segment_count is not the number of regions": f"{_N('f[3]')} = len(regexp_extract_all(f[1], '[;,]')) + 1"}


def _typed(layout: parse_errors.Layout, ok: str) -> str:
    columns = ", ".join(f'TRY_CAST(f[{i}] AS {"VARCHAR" if t == "string" else t}) AS "{n}"' for i, (n, t, _) in enumerate(layout.columns, 1))
    beyond = ", ".join(f"CASE WHEN TRY_CAST(f[{i}] AS {t}) IS NULL THEN '{n}' END" for i, (n, t, _) in enumerate(layout.columns, 1) if t != "string")
    return f"SELECT line_id, {columns}, concat_ws(',', {beyond}) AS beyond FROM ({_CELLS.format(t=layout.name)}) WHERE coalesce({ok}, FALSE)"


_CHECKED = {  # the checks of single cells, for a cell {v}
    "whole": "regexp_full_match({v}, '[0-9]+')", "whole from 1": "regexp_full_match({v}, '0*[1-9][0-9]*')", "decimal above 0": r"regexp_full_match({v}, '[0-9]+(\.[0-9]+)?') AND regexp_matches({v}, '[1-9]')",
    "decimal to 100": r"regexp_full_match({v}, '0*([0-9][0-9]?(\.[0-9]+)?|100(\.0+)?)')", "decimal to 1": r"regexp_full_match({v}, '0+(\.[0-9]+)?|0*1(\.0+)?')", "text": r"regexp_matches({v}, '[^\s\pZ]')",
    "three parts": r"regexp_full_match({v}, '[^/\s\pZ]+/[^/\s\pZ]+/[^/\s\pZ]+')", "whole list": "regexp_full_match({v}, '[0-9]+(,[0-9]+)*')", "bases": "regexp_full_match({v}, '[ACGTNacgtn]+')", "regions": "",
}


def _reasons(layout: parse_errors.Layout, across: dict[str, str]) -> str:
    checked = _CHECKED | {"regions": f"regexp_full_match({{v}}, ' *{_REGION} *([;,] *{_REGION} *)*')"}
    cells = ", ".join(f"CASE WHEN contains(f[{i}], '\"') THEN '{n}: quoting' WHEN NOT ({checked[c].replace('{v}', f'f[{i}]')}) THEN '{n}: not {c}' END" for i, (n, _, c) in enumerate(layout.columns, 1))
    rules = ", ".join(f"CASE WHEN NOT ({holds}) THEN '{why}' END" for why, holds in across.items())
    return f"""
SELECT '{layout.name}' AS src, unnest(CASE WHEN coalesce(len(f), 0) = 0 OR (len(f) = 1 AND f[1] = '') THEN ['empty line'] WHEN len(f) <> {len(layout.columns)} THEN ['field count'] WHEN len(c) > 0 THEN c ELSE [x FOR x IN [{rules}] IF x IS NOT NULL] END) AS reason
FROM (SELECT *, [x FOR x IN [{cells}] IF x IS NOT NULL] AS c FROM ({_CELLS.format(t=layout.name)}))"""


_CHR = r"'chr' || regexp_replace(upper(regexp_replace(chr, '^\s+|\s+$', '', 'g')), '^CHR\s*', '')"

SQL = {
    "p1_found": f"""
SELECT 'tandem_raw' AS src, line_id FROM ({_CELLS.format(t='tandem_raw')}) WHERE NOT coalesce({_TANDEM_OK}, FALSE)
UNION ALL
SELECT 'overview_raw', line_id FROM ({_CELLS.format(t='overview_raw')}) WHERE NOT coalesce({_OVERVIEW_OK}, FALSE)""",
    "p1_reasons": f"SELECT src, reason, count(*) AS lines FROM ({_reasons(parse_errors.TANDEM, _TANDEM_RULES)} UNION ALL {_reasons(parse_errors.OVERVIEW, _OVERVIEW_RULES)}) GROUP BY src, reason",
    "p1_tandem_records": _typed(parse_errors.TANDEM, _TANDEM_OK),
    "p1_overview_records": _typed(parse_errors.OVERVIEW, _OVERVIEW_OK),
    "p5_found": f"""
WITH iv AS (SELECT sample, {_CHR} AS chr, CAST(least(start0, end0) AS BIGINT) AS a, CAST(greatest(start0, end0) AS BIGINT) AS b
  FROM inferred_simple WHERE sample IS NOT NULL AND trim(sample) <> '' AND chr IS NOT NULL AND trim(chr) <> '' AND start0 <> end0),
marked AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY sample, chr ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM iv),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, chr ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM marked),
covered AS (SELECT sample, chr, k, min(a) AS s, max(b) AS e FROM numbered GROUP BY sample, chr, k),
gaps AS (SELECT sample, chr, e AS s, lead(s) OVER (PARTITION BY sample, chr ORDER BY s) AS e FROM covered)
SELECT sample, chr, 'covered' AS kind, s AS start0, e AS end0 FROM covered
UNION ALL SELECT sample, chr, 'gap', s, e FROM gaps WHERE e IS NOT NULL""",
    "p6_found": r"""
WITH packed AS (
  SELECT 'regions' AS field, rec_id, arg_max(regions, loaded_at) AS v FROM split_overview GROUP BY rec_id
  UNION ALL SELECT 'reads', rec_id, arg_max(reads, loaded_at) FROM ecc_core GROUP BY rec_id
  UNION ALL SELECT 'per_read_copy_number', rec_id, arg_max(per_read_copy_number, loaded_at) FROM ecc_core GROUP BY rec_id),
parts AS (SELECT field, rec_id, regexp_extract_all(trim(v, ' ' || chr(9)), '"(?:[^"]|"")*"|[ \t]*[;,|][ \t]*|[ \t]+|[^;,| \t"]+') AS x FROM packed WHERE v IS NOT NULL),
items AS (SELECT field, rec_id, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM parts),
placed AS (SELECT field, rec_id, w, regexp_full_match(w, '[ \t]*[;,|][ \t]*|[ \t]+') AS sep,
  1 + coalesce(sum(CASE WHEN regexp_full_match(w, '[ \t]*[;,|][ \t]*|[ \t]+') THEN 1 ELSE 0 END) OVER (PARTITION BY field, rec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM items)
SELECT field, rec_id, CAST(pos AS INTEGER) AS pos, CASE WHEN w LIKE '"%' THEN replace(substr(w, 2, length(w) - 2), '""', '"') ELSE w END AS val
FROM placed WHERE NOT sep AND w <> '""'""",
}
