import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.sources import sinks, text


def put(folder, name, content, zipped=False):
    path = str(folder / name)
    with gzip.open(path, "wt") if zipped else open(path, "w", newline="") as f:
        f.write(content)
    return path


def test_fasta_round_trip(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">r1|x|3 some text\r\nACGT\r\nAC>GT\n\nA\n>r2\n>r3|y\nNN\n", zipped=False)
    got = {r["id"]: (r["description"], r["seq"]) for r in text.fasta(spark, path).collect()}
    assert got == {"r1|x|3": ("some text", "ACGTAC>GTA"), "r2": ("", ""), "r3|y": ("", "NN")}
    assert {r["base"] for r in text.with_base(text.fasta(spark, path)).collect()} == {"r1", "r2", "r3"}
    df = spark.createDataFrame([("a", "ACGT" * 40), ("b", ""), ("c", None), ("d", "A" * 60)], "id string, seq string")
    sinks.write_fasta(df, str(tmp_path / "out"))
    back = {r["id"]: r["seq"] for r in text.fasta(spark, str(tmp_path / "out")).collect()}
    assert back == {"a": "ACGT" * 40, "b": "N", "c": "N", "d": "A" * 60}
    lines = [x for p in (tmp_path / "out").glob("part*") for x in p.read_text().splitlines()]
    assert max(map(len, lines)) == 60 and "A" * 60 in lines


def test_fasta_to_fasta(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">r1|x some text\nACGT\n>r2\nAA\n>r3\nCC\n>r3|y\nGG\n")
    ids = spark.createDataFrame([("r1",), ("r3",), (None,), ("r3",)], "id string")
    read = lambda p: sorted((r["id"], r["description"], r["seq"]) for r in text.fasta(spark, str(p)).collect())
    text.copy_some(spark, path, ids, str(tmp_path / "kept"))
    assert read(tmp_path / "kept") == [("r1|x", "some text", "ACGT"), ("r3", "", "CC"), ("r3|y", "", "GG")]
    text.copy_some(spark, path, ids, str(tmp_path / "rest"), keep=False)
    assert read(tmp_path / "rest") == [("r2", "", "AA")]
    text.copy_some(spark, path, ids.limit(1), str(tmp_path / "rest"), append=True)
    assert read(tmp_path / "rest") == [("r1|x", "some text", "ACGT"), ("r2", "", "AA")]
    text.concat(spark, [str(tmp_path / "kept"), str(tmp_path / "rest")], str(tmp_path / "all"))
    assert len(read(tmp_path / "all")) == 5
    text.copy_some(spark, path, ids.limit(0), str(tmp_path / "none"))
    assert read(tmp_path / "none") == []


def test_sniffing(tmp_path):
    assert text.sniff(put(tmp_path, "a", ">x\nA\n")) == "fasta" and text.sniff(put(tmp_path, "b.gz", "@x\nA\n+\nI\n", True)) == "fastq"
    assert text.sniff(put(tmp_path, "c", "")) == "empty" and text.sniff(put(tmp_path, "d", "hello")) == "unknown"
    assert text.delimiter(put(tmp_path, "e", "a;b;c\n1;2;3\n")) == ";" and text.delimiter(put(tmp_path, "f", "a\tb\n")) == "\t"


def test_tables(spark, tmp_path):
    row = ["q|r|200|1.0", "chrR", "99.5", "200", "1", "0", "1", "200", "101", "300", "0.0", "50", "plus"]
    path = put(tmp_path, "aln.tsv", "\t".join(row) + "\n" + "\t".join([*row, "60"]) + "\n")
    got = text.alignments(spark, path).collect()
    assert [r["mapq"] for r in got] == [None, 60] and got[0]["s_end"] == 300
    with pytest.raises(Exception, match="12 fields"):
        text.alignments(spark, put(tmp_path, "bad.tsv", "\t".join(row[:12]) + "\n")).collect()
    t = text.tandem(spark, put(tmp_path, "t.tsv", "r\trep0\t2.0\t100\t1\t99\t10\t99.5\t0\t1,11\tACGT\n")).first()
    assert (t["readLen"], t["consSeq"]) == (100, "ACGT")
    both = text.table(spark, [put(tmp_path, "x.csv", "a,b\n1,2\n"), str(tmp_path / "none.csv"), put(tmp_path, "y.tsv", "b\tc\n3\tz\n"), put(tmp_path, "e.csv", "")])
    assert sorted(map(str, (r.asDict() for r in both.collect()))) == ["{'a': 1, 'b': 2, 'c': None}", "{'a': None, 'b': 3, 'c': 'z'}"]
    assert text.read_classes(spark, put(tmp_path, "c.csv", "READNAME,readclass\nr1, Other\n")).first()["readClass"] == "Other"
    with pytest.raises(ValueError, match="readclass"):
        text.read_classes(spark, put(tmp_path, "d.csv", "readName\nr1\n"))


def test_paf_lines(spark, tmp_path):
    lines = "query1\t200\t0\t155\t+\tref1\t1000\t100\t255\t150\t155\t60\tcs:Z::100*ac+tt-gg:50\nq2\t60\t0\t50\t-\tref2\t900\t500\t550\t40\t50\t40\nq3\t9\t0\t9\t+\tr\t9\t0\t9\t9\t9\t1\tde:f:0.0125\nshort\t1\n"
    got = [tuple(r)[:10] for r in text.paf(spark, put(tmp_path, "a.paf", lines)).collect()]
    assert got[0] == ("query1", "ref1", 96.77, 155, 1, 2, 1, 155, 101, 255) and got[1] == ("q2", "ref2", 80.0, 50, 10, 0, 1, 50, 550, 501)
    assert len(got) == 3 and got[2][2] == 98.75


def test_maf_blocks_and_clusters(spark, tmp_path):
    maf = "# head\na score=150 x=1\ns chr1 100 50 + 1000 ACG\ns q1 10 40 + 200 ACG\n\na\ns chr2 5 20 + 900 AC\ns q1 30 20 - 200 AC\n\na score=9\ns chr2 5 x + 900 AC\n"
    got = sorted(map(tuple, text.maf(spark, put(tmp_path, "a.maf", maf)).collect()))
    assert got == [("chr1", 100, 150, "q1", 10, 50, 200, 150, 95.0, "+"), ("chr2", 5, 25, "q1", 150, 170, 200, 0, 95.0, "-")]
    clstr = ">Cluster 0\n0\t100nt, >seq1... *\n1\t95nt, >seq2... at 95.0%\n>Cluster 1\n0\t9nt, >s3... at 1%\n1\t9nt, >s4... at 2%\n"
    got = {tuple(r) for r in text.clusters(spark, put(tmp_path, "a.clstr", clstr)).collect()}
    assert got == {("seq1", "0", True), ("seq2", "0", False), ("s3", "1", True), ("s4", "1", False)}
    table = put(tmp_path, "c.csv", "id,cluster,is_representative\na,1,True\nb,1,False\nc,,\n")
    assert {tuple(r) for r in text.cluster_table(spark, table).collect()} == {("a", "1", True), ("b", "1", False), ("c", "singleton:c", False)}


def test_reference_and_reports(spark, tmp_path):
    ref = spark.createDataFrame([("chr1", "AACCGGTT"), ("chr2", "TTTT")], "id string, seq string")
    segs = spark.createDataFrame([("x", 1, "chr2", 0, 2), ("x", 0, "chr1", 2, 4), ("y", 0, "chr1", 4, 8)], "id string, seg int, chr string, start0 bigint, end0 bigint")
    for size in (1, 3, 8, 100):
        chunks = text.chunked(ref, size)
        assert {r["id"]: r["seq"] for r in text.from_reference(chunks, segs, size).collect()} == {"x": "CCTT", "y": "GGTT"} and chunks.agg(F.max(F.length("seq"))).first()[0] <= size
    sinks.write_table(segs.limit(0), str(tmp_path / "empty"))
    assert next((tmp_path / "empty").glob("part*")).read_text().strip() == "id,seg,chr,start0,end0"
    sinks.write_bed(segs.select("chr", "start0", "end0"), str(tmp_path / "bed"), single=True)
    assert next((tmp_path / "bed").glob("part*")).read_text().splitlines()[0] == "chr2\t0\t2"
    sinks.write_json(spark, {"a": 1}, str(tmp_path / "s/x.json"))
    sinks.write_json(spark, {"a": 2}, str(tmp_path / "s/x.json"))
    assert json.load(open(tmp_path / "s/x.json")) == {"a": 2} and [x for x in os.listdir(tmp_path / "s") if not x.startswith(".")] == ["x.json"]
    assert "reads  5" in sinks.text_report("T", {"S": {"reads": 5}}) and "<th>a&lt;</th>" in sinks.html_report("T", {"S": {"a<": 5}})
    title = sinks.title_simple(F.lit("U1"), S.region(F.lit("chr1"), F.lit(0), F.lit(9)), F.lit("+"), F.lit(9), F.lit(2), F.lit(3))
    assert spark.range(1).select(title).first()[0] == "U1|chr1:0-9(+)|length=9|repeats=2|reads=3"
    with pytest.raises(ValueError, match="zz"):
        text.require(segs, ["id", "zz"])
