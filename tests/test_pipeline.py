import json

import pytest
from pyspark.sql import functions as F

from annulet import cli
from annulet.operators import simulate
from annulet.plans import config as C
from annulet.plans import deliverable
from annulet.plans import pipeline as P
from annulet.sources import text
from annulet.streaming import reads


def test_order_and_errors():
    ok = lambda *a: None
    stages = [P.Stage("b", ("a",), ok), P.Stage("a", ("in",), ok)]
    assert [s.name for s in P.in_order(stages, {"in"})] == ["a", "b"]
    for bad in ([P.Stage("a", ("x",), ok)], [P.Stage("a", ("b",), ok), P.Stage("b", ("a",), ok)], [P.Stage("a", (), ok), P.Stage("a", (), ok)]):
        with pytest.raises(P.PipelineError):
            P.in_order(bad, {"in"})


def test_resume(spark, tmp_path):
    ran = []

    def count(df, conf):
        ran.append(conf.prefix)
        return df.groupBy().agg(F.count("*").alias("n"))

    stages, inputs = [P.Stage("n", ("in",), count, ("n",))], {"in": spark.range(5)}
    go = lambda conf, **k: P.run(spark, stages, inputs, str(tmp_path), conf, **k)["n"].first()["n"]
    one, two = C.Config(prefix="one"), C.Config(prefix="two")
    assert go(one) == go(one) == 5 and ran == ["one"]
    with pytest.raises(P.PipelineError):
        go(two, on_change="fail")
    go(two, on_change="continue")
    assert ran == ["one"]
    go(two), go(two, force=True)
    assert ran == ["one", "two", "two"]
    with pytest.raises(P.PipelineError, match="lacks"):
        P.run(spark, [P.Stage("m", ("in",), count, ("z",))], inputs, str(tmp_path), two)


def test_config(tmp_path):
    C.save(C.Config(), str(tmp_path / "c.json"))
    assert C.load(str(tmp_path / "c.json")) == C.Config() and C.Config().fingerprint() != C.Config(prefix="x").fingerprint()
    assert C.from_dict({"rules": {"theta_u": 0.9}}).rules.theta_u == 0.9 and C.Config().with_preset("strict").rules.theta_u == 0.98
    for bad in ({"rules": {"theta_u": 2}}, {"nothing": 1}, {"rules": {"nothing": 1}}, {"unify": {"method": "x"}}, {"prefix": ""}):
        with pytest.raises(C.ConfigError):
            C.from_dict(bad)
    with pytest.raises(C.ConfigError):
        C.Config().with_preset("none")


def test_standard_pipeline_from_the_command_line(spark, tmp_path, capsys):
    truth = simulate.truth(spark, 4, 42)
    rows = simulate.alignments(truth).withColumns({"mismatches": F.lit(0), "gap_opens": F.lit(0), "evalue": F.lit(0.0), "loaded_at": F.lit("2024-01-01").cast("timestamp"), "produced_at": F.lit("2024-01-01").cast("timestamp")})
    rows.write.parquet(str(tmp_path / "in/alignments.parquet"))
    t = "select 1L rec_id, 'r' readName, 'rep0' repN, 2.0D copyNum, 100L readLen, 1L start, 100L end, 50L consLen, 99.5D aveMatch, 0L fullLen, '1,51' subPos, 'ACGT' consSeq, timestamp'2024-01-01' produced_at, timestamp'2024-01-01' loaded_at"
    spark.sql(t).write.parquet(str(tmp_path / "in/tandem.parquet"))
    out = str(tmp_path / "out")
    (tmp_path / "ref.fa").write_text("".join(f">{r['chr']}\n{'ACGT' * 25}\n" for r in truth.select("chr").distinct().collect()))
    assert cli.main(["run", str(tmp_path / "in"), out, "--prefix", "x", "--reference", str(tmp_path / "ref.fa")], spark) == cli.OK
    package = tmp_path / "out/package"
    beds = {p: [x.split("\t") for f in (package / p).glob("part*") for x in f.read_text().splitlines()] for p in ("UeccDNA/x_uecc.bed", "MeccDNA/x_mecc_sites.bed", "CeccDNA/x_cecc_junctions.bedpe")}
    assert sorted(r[3] for r in beds["UeccDNA/x_uecc.bed"]) == [f"UeccDNA000{i}" for i in range(1, 5)] and len(beds["MeccDNA/x_mecc_sites.bed"]) == 4 and beds["CeccDNA/x_cecc_junctions.bedpe"] == []
    assert spark.read.csv(str(package / "x_summary"), header=True).count() == 8 and sum(1 for _ in (package / "UeccDNA/x_UeccDNA.fasta").glob("part*"))
    assert "Uecc Confirmed" in json.loads((package / "x_report.json").read_text())["Circles"] and "Circles" in (package / "x_report.txt").read_text()
    summary = {(r["kind"], r["state"]): r["circles"] for r in spark.read.parquet(f"{out}/summary").collect()}
    assert summary == {("Uecc", "Confirmed"): 4, ("Mecc", "Confirmed"): 4}
    assert cli.main(["show-checkpoint", out], spark) == cli.OK and "summary" in json.loads(capsys.readouterr().out)["done"]
    assert cli.main(["package", f"{out}/unified", str(tmp_path / "again"), "--prefix", "z", "--id-width", "6"], spark) == cli.OK
    assert spark.read.csv(str(tmp_path / "again/z_summary"), header=True).where("eccDNA_id = 'UeccDNA000001'").count() == 1
    assert cli.main(["run", "a", "b", "--force"]) == cli.USAGE and cli.main(["nothing"]) == cli.USAGE and cli.main(["show-checkpoint", str(tmp_path / "none")], spark) == cli.FAILED
    assert cli.main(["validate"]) == cli.OK and cli.main(["init-config", str(tmp_path / "c.json")]) == cli.OK


def test_streams_agree_with_batch(spark, tmp_path):
    rows = spark.range(200).selectExpr("id % 180 as aln_id", "concat('q', id % 7) as query_id", "cast(id % 50 as double) as bit_score", "cast(null as double) as identity", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,id % 180,0) as loaded_at")
    rows.repartition(5).write.parquet(str(tmp_path / "d/alignments.parquet"))
    d = str(tmp_path / "d")
    stream = lambda: reads.stream(spark, d, "alignments", 2)
    kept = reads.run(reads.once(stream(), "aln_id", "loaded_at", "1 day"), "kept", str(tmp_path / "c1"))
    assert kept.count() == 180
    best = reads.run(reads.best_hits(stream()), "best", str(tmp_path / "c2"), "complete")
    assert {tuple(r) for r in best.collect()} == {tuple(r) for r in reads.best_hits(spark.read.parquet(f"{d}/alignments.parquet")).collect()}
    windows = reads.run(reads.counts(stream(), "loaded_at", "1 hour", "10 minutes", "query_id"), "windows", str(tmp_path / "c3"), "complete")
    assert windows.agg(F.sum("n")).first()[0] == 200
    seen = []
    reads.each_batch(stream(), lambda df, i: seen.append(df.count()), str(tmp_path / "c4"))
    assert sum(seen) == 200 and len(seen) == 3


def test_package_of_circles_of_several_segments(spark, tmp_path):
    rows = [("q9", "Cecc", "Confirmed", 0, 2, "chr1", 5, 9, "+", 8, 0.5), ("q9", "Cecc", "Confirmed", 1, 2, "chr2", 1, 5, "-", 8, 0.5), ("q10", "Cecc", "Confirmed", 0, 1, "chr2", 0, 3, "+", 3, 0.5), ("I1", "Cecc", "Inferred", 0, 1, "chr1", 1, 4, "+", 3, None)]
    unified = spark.createDataFrame(rows, "id string, kind string, state string, seg int, segs int, chr string, start0 bigint, end0 bigint, strand string, length bigint, conf double")
    reference = text.chunked(spark.createDataFrame([("chr1", "AACCGGTTAC"), ("chr2", "TTTGGG")], "id string, seq string"), text.CHUNK)
    found = deliverable.write(spark, unified, str(tmp_path), "y", None, reference)
    lines = lambda p: sorted(x for f in (tmp_path / p).glob("part*") for x in f.read_text().splitlines())
    assert lines("CeccDNA/y_cecc_junctions.bedpe") == ["chr1\t8\t9\tchr2\t1\t2\tCeccDNA0001|seg1->seg2\t0\t+\t-"]
    assert lines("CeccDNA/y_cecc_segments.bed") == ["chr1\t1\t4\tCeccDNA0003\t0\t+", "chr1\t5\t9\tCeccDNA0001|seg1|head\t0\t+", "chr2\t0\t3\tCeccDNA0002\t0\t+", "chr2\t1\t5\tCeccDNA0001|seg2|tail\t0\t-"]
    fasta = {r["id"]: r["seq"] for r in text.fasta(spark, str(tmp_path / "CeccDNA/y_CeccDNA.fasta")).collect()}
    assert fasta == {"CeccDNA0001|chr1:5-9;chr2:1-5|length=8|Confirmed": "GTTATTGG", "CeccDNA0002|chr2:0-3|length=3|Confirmed": "TTT", "CeccDNA0003|chr1:1-4|length=3|Inferred": "ACC"}
    assert found["Circles"] == {"Cecc Confirmed": "2", "Cecc Inferred": "1"} and found["Lengths of Cecc"]["max"] == 8
    empty = deliverable.write(spark, unified.limit(0), str(tmp_path / "e"), "y")
    assert empty == {"Circles": {}} and lines("e/CeccDNA/y_cecc_segments.bed") == []


def test_curated_and_split_read_tables(spark, tmp_path):
    simple = spark.createDataFrame([("IUeccDNA1", "chr1", 1, 4, "+", 3)], "eccDNA_id string, chr string, start0 bigint, end0 bigint, strand string, length bigint")
    chimeric = simple.selectExpr("'ICeccDNA1' eccDNA_id", "chr", "start0", "end0", "strand", "length", "explode(array(1, 2)) seg_index")
    reference = text.chunked(spark.createDataFrame([("chr1", "ACGTA")], "id string, seq string"))
    deliverable.write_curated(simple, chimeric, str(tmp_path), "s", reference)
    assert spark.read.csv(str(tmp_path / "s_chimeric.csv"), header=True).count() == 2
    assert [(r["id"], r["seq"]) for r in text.fasta(spark, str(tmp_path / "s_CeccDNA_I.fasta")).collect()] == [("ICeccDNA1", "CGTCGT")]
    deliverable.write_split_reads(simple.limit(0), chimeric, str(tmp_path))
    assert next((tmp_path / "circles.tsv").glob("part*")).read_text().split() == simple.columns
    assert {(r["id"], r["length"]) for r in text.sizes(spark.createDataFrame([("a", "ACG"), ("b", "")], "id string, seq string")).collect()} == {("a", 3), ("b", 0)}
