import random

from annulet.operators import parse_errors as P

GOOD = ["m1/2/ccs", "rep0", "2.5", "100", "5", "90", "4", "99.5", "0", "5,20,60", "ACGn"]
SEEN = "line_id bigint, raw string, loaded_at timestamp, errors string, name string, cells string"


def verdicts(spark, lines, layout):
    df = spark.createDataFrame([(i, x, None, "e", "n", "c") for i, x in enumerate(lines)], SEEN)
    judged = P.judge(df, layout)
    bad = {r["line_id"]: list(r["errors"]) for r in P.rejected(judged).collect()}
    clean = {r["line_id"]: r for r in P.records(judged, layout).collect()}
    assert not bad.keys() & clean.keys() and len(bad) + len(clean) == len(lines)
    return bad, clean


def line(**changed):
    names = [n for n, _, _ in P.TANDEM.columns]
    return "\t".join(changed.get(n, v) for n, v in zip(names, GOOD))


def test_tandem_lines(spark):
    cases = [
        (line(), None), (line() + "\r", None), (line(readName='"m1/2/ccs"', consSeq='"acgt"'), None), (line(repN=" r "), None), (line(aveMatch="100.000"), None), (line(start="05", subPos="005,20"), None),
        (line(copyNum="0" * 400 + "1"), None), (None, "empty line"), ("", "empty line"), ("\r", "empty line"), ("\t" * 10, "readName: not three parts"), (line() + "\t", "field count"), ("x", "field count"),
        (line() + "\r\r", "consSeq: not bases"), (line(readName="m1/ /ccs"), "readName: not three parts"), (line(readName="m1//ccs"), "readName: not three parts"), (line(readName="m1/\u00a02/ccs"), "readName: not three parts"), (line(repN="\u2003"), "repN: not text"), (line(repN=" "), "repN: not text"),
        (line(copyNum="0.0"), "copyNum: not decimal above 0"), (line(copyNum="1."), "copyNum: not decimal above 0"), (line(copyNum="+1"), "copyNum: not decimal above 0"), (line(aveMatch="100.01"), "aveMatch: not decimal to 100"),
        (line(start="0", subPos="0,20"), "start: not whole from 1"), (line(start="91"), "start after end"), (line(end="101"), "end after readLen"), (line(subPos="5,20,20"), "subPos not rising"),
        (line(subPos="6,20"), "subPos not from start"), (line(subPos="5,91"), "subPos after end"), (line(subPos="5,,20"), "subPos: not whole list"), (line(consLen="5"), "consLen is not the length"),
        (line(consSeq="ACGX"), "consSeq: not bases"), (line(repN='"rep0'), "repN: quoting"), (line(repN='re"p'), "repN: quoting"), (line(repN='"a""b"'), "repN: quoting"), (line(repN='"a\tb"'), "field count"),
        (line(end="9" * 40, readLen="9" * 41), None), ("x" * 100_000, "field count"),
    ]
    bad, clean = verdicts(spark, [c for c, _ in cases], P.TANDEM)
    for i, (text, why) in enumerate(cases):
        assert (i in clean) if why is None else (why in bad[i]), (text, bad.get(i))
    assert clean[0]["copyNum"] == 2.5 and clean[2]["consSeq"] == "acgt" and clean[36]["end"] is None and clean[36]["beyond"] == "readLen,end" and clean[0]["beyond"] == ""


def test_lines_without_id_are_rejected_each_by_itself(spark):
    df = spark.createDataFrame([(1, line(), None), (None, "x", None), (None, line(), None), (3, "x", None)], "line_id bigint, raw string, loaded_at timestamp")
    judged = P.judge(df, P.TANDEM)
    assert [r["line_id"] for r in P.records(judged, P.TANDEM).collect()] == [1]
    bad = sorted((r["line_id"] or 0, *r["errors"]) for r in P.rejected(judged).collect())
    assert bad == [(0, "no line id"), (0, "no line id"), (3, "field count")]


def test_overview_lines(spark):
    row = lambda *v: "\t".join(v)
    rest = ["10", "2", "3", "1", "0.5", "1.0"]
    cases = [
        (row(" chr1:5-9 ; X_1.2:9-5", *rest), True), (row('"chr1:5-9, chr2:1-2"', *rest), True), (row("chr1:5-9;chr1:5-9;chr1:5-9", *rest), False), (row("chr1:5-9;;chr2:1-2", *rest), False),
        (row("chr1:0-9;chr2:1-2", *rest), False), (row("chr1 :1-9;chr2:1-2", *rest), False), (row("chr1:1-9;chr2:1-2", "0", *rest[1:]), False), (row("chr1:1-9;chr2:1-2", *rest[:3], "1.01", *rest[4:]), False),
        (row("chr1:1–9;chr2:1-2", *rest), False), (row("chr1:1-9;chr2:1-2", "10", "02", *rest[2:]), True), (row("", *rest), False),
    ]
    bad, clean = verdicts(spark, [c for c, _ in cases], P.OVERVIEW)
    assert [i in clean for i in range(len(cases))] == [ok for _, ok in cases]


def test_latest_delivery_counts_and_empty_table(spark):
    df = spark.sql(f"select 1L line_id, '{line()}' raw, timestamp'2024-01-01' loaded_at union all select 1L, 'x', timestamp'2024-02-01' union all select 1L, '{line()}', null")
    assert P.rejected(P.judge(df, P.TANDEM)).count() == 1 and P.records(P.judge(df, P.TANDEM), P.TANDEM).count() == 0
    assert P.judge(df.limit(0), P.TANDEM).count() == 0


def test_digit_order(spark):
    rnd = random.Random(1)
    values = [str(rnd.randrange(10**n)).zfill(n) for n in range(1, 45) for _ in range(3)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [int(r[0]) for r in df.orderBy(P.digits(df.v)).collect()] == sorted(map(int, values))
