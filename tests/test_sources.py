import gzip

import pytest
import os

from pyspark.sql import functions as F

from genolith.operators import genotypes as gt
from genolith.sources import blockgzip, sinks, tables, vcf

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3
1\t100\trs1\tA\tC,G\t.\tPASS\tAC=1,2;DB\tGT:AD:DP:GQ:PL\t0/1:5,3,0:8:40:9,8,7,6,5,4\t1|2:0,4,4:8:50:1,2,3,4,5,6\t./.
X\t7\t.\tT\tTA\t.\tPASS\t.\tGT:DP\t1/1:12\t0/0:.\t0
"""


def test_vcf_text(spark, tmp_path):
    path = str(tmp_path / "x.vcf.gz")
    with gzip.open(path, "wt") as f:
        f.write(VCF)
    sites, calls = vcf.read_vcf(spark, path)
    assert {r["contig"] for r in sites.collect()} == {"chr1", "chrX"}
    assert {r["contig"] for r in vcf.read_vcf(spark, path, hg19=True)[0].collect()} == {"1", "X"}
    rows = {(r["contig"], r["alt"], r["sample"]): r for r in gt.split_multi(calls.drop("info")).collect()}
    assert rows["chr1", "C", "S1"]["gt"] == 1 and rows["chr1", "G", "S2"]["gt"] == 1 and rows["chr1", "C", "S3"]["gt"] is None
    assert rows["chr1", "C", "S2"]["AD"] == [4, 4] and rows["chr1", "C", "S1"]["dp"] == 8
    assert rows["chrX", "TA", "S1"]["gt"] == 2 and rows["chrX", "TA", "S2"]["dp"] is None
    info = {r["id"]: r["info"] for r in sites.collect()}
    assert info["rs1"]["AC"] == [1, 2] and info["rs1"]["TYPED"] is False
    with_info = {(r["contig"], r["alt"], r["sample"]): r for r in gt.split_multi(calls).collect()}
    assert with_info["chr1", "G", "S1"]["info"]["AC"] == [2] and with_info["chr1", "C", "S2"]["AD"] == [4, 4]


def test_every_vcf_file_has_its_own_samples(spark, tmp_path):
    line = "1\t5\t.\tA\tC\t.\t.\t{info}\tGT:DP:GP\t{a}\t{b}\n"
    head = "##fileformat=VCFv4.2\n{more}#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{names}\n"
    (tmp_path / "a.vcf").write_text(head.format(more='##INFO=<ID=QD,Number=1,Type=Float,Description="x">\n', names="X\tY") + line.format(info="QD=2.5;IMPUTED", a="0/1:3:0.1,0.9,0", b="0/0:4:."))
    (tmp_path / "b.vcf").write_text(head.format(more="", names="Y\tX") + line.format(info=".", a="1/1:5:0,0,1", b="./.:.:."))
    sites, calls = vcf.read_vcf(spark, str(tmp_path))
    got = sorted((r["sample"], r["a1"], r["a2"], r["dp"], r["GP"], r["info"]["QD"], r["info"]["IMPUTED"]) for r in calls.where("a1 is not null").collect())
    assert got == [("X", 0, 1, 3, [0.1, 0.9, 0.0], 2.5, True), ("Y", 0, 0, 4, None, 2.5, True), ("Y", 1, 1, 5, [0.0, 0.0, 1.0], None, False)]
    (tmp_path / "c.vcf").write_text(line.format(info=".", a="0/0:1:.", b="0/0:1:."))
    with pytest.raises(Exception, match="no header line"):
        vcf.read_vcf(spark, str(tmp_path))[1].collect()


def test_bed_is_half_open(spark, tmp_path):
    path = tmp_path / "t.bed"
    path.write_text("track name=x\nchr1\t0\t10\ta\nchr2\t5\t6\tb\n")
    rows = {r["name"]: (r["start_pos"], r["end_pos"]) for r in tables.read_bed(spark, str(path)).collect()}
    assert rows == {"a": (1, 10), "b": (6, 6)}


def test_labels_from_file_names(spark, tmp_path):
    for name in ("trait.Liver.csv", "trait.smultixcan.txt"):
        (tmp_path / name).write_text("gene\tpvalue\ng1\t0.5\n")
    df = tables.read_labelled(spark, [str(tmp_path / n) for n in ("trait.Liver.csv", "trait.smultixcan.txt")])
    assert {(r["phenotype"], r["tissue"]) for r in df.collect()} == {("trait", "Liver"), ("trait", "Meta")}


def test_comma_separated_sumstats(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("SNP,chr,pos,beta,se,p,N\nrs1,1,10,0.1,0.2,0.6,NA\n")
    row = tables.read_sumstats(spark, str(path)).first()
    assert (row["SNPID"], row["POS"], row["BETA"], row["N"]) == ("rs1", 10, 0.1, None)


def test_admixture_columns(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text("a b c d e id pop\n1 2 3 4 5 S1 EUR\n1 2 3 4 5 S2 AFR\n")
    assert [tuple(r) for r in tables.read_admixture(spark, str(path)).collect()] == [("S1", "EUR"), ("S2", "AFR")]


def test_every_shard_has_a_header(spark, tmp_path, genotypes):
    _, variants, people, entries = genotypes
    from genolith.operators.genotypes import GenotypeSet
    g = GenotypeSet(variants, people, entries.withColumns({"dp": F.lit(30), "gq": F.lit(50)}))
    path = sinks.write_vcf_shards(g, str(tmp_path / "v"), n=4)
    lines = 0
    for name in [n for n in os.listdir(path) if n.startswith("part-")]:
        text = open(os.path.join(path, name)).read().splitlines()
        if text:
            assert text[0].startswith("##fileformat") and text[1].startswith("#CHROM")
            places = [(int(x.split("\t")[0][3:]), int(x.split("\t")[1])) for x in text[2:]]
            assert places == sorted(places)
            lines += len(text) - 2
    assert lines == 60


def test_calls_are_put_to_text_once(spark, genotypes, request):
    """Genome ranges of the shards must not make all lines first, only to look at their places."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with more calls than these
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    from genolith.operators.genotypes import GenotypeSet
    _, variants, people, entries = genotypes
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    calls = entries.repartition(4, "variant_key").withColumns({"dp": F.udf(counted, "int")(F.col("sample_key").cast("int")), "gq": F.lit(50)})
    lines, _ = sinks.vcf_shards(GenotypeSet(variants, people, calls), 4)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "shufflepartitionidpassthrough" in plan and not any("rangepartitioning" in x and "contig" in x for x in plan.splitlines())
    got = [r["value"].split("\t") for r in lines.collect()]
    assert seen.value == entries.count()
    assert len(got) == 60 and all([x.split(":")[1] for x in line[9:]] == [str(i) for i in range(40)] for line in got)


@pytest.mark.parametrize("split_bytes", [700, 5000, 40_000, 1 << 24])
def test_block_gzip_lines_survive_every_cut(spark, tmp_path, monkeypatch, split_bytes):
    monkeypatch.setattr(blockgzip, "BLOCK_TEXT", 900)
    lines = [f"line {i} " + "xyz"[i % 3] * (i * 37 % 400) for i in range(600)] + ["a" * 20_000, "", "é" * 3000, ""]
    frame = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    files = blockgzip.write_block_gzip(frame, ["# head", "# names"], f"file://{tmp_path}/v")
    name, size = files.first()
    assert gzip.open(name.removeprefix("file://"), "rt").read().split("\n") == ["# head", "# names", *lines, ""]
    ranges = blockgzip.splits(files, split_bytes)
    assert ranges.count() == -(-size // split_bytes)
    got = [r["value"] for r in blockgzip.read_lines(ranges).collect()]
    assert sorted(got) == sorted(["# head", "# names", *lines])
    assert [r["value"] for r in blockgzip.read_heads(files).collect()] == ["# head", "# names"]


def test_block_gzip_vcf(spark, tmp_path):
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"]
    lines = [f"{1 + i // 6000}\t{10 * i}\trs{i}\tA\tC\t.\tPASS\tAC={i}\tGT:DP:GQ\t0/{i % 2}:{i % 50}:{i * 7 % 99}\t./.:.:." for i in range(12_000)]
    folder = f"file://{tmp_path}/v"
    frame = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    files = blockgzip.write_block_gzip(frame, head, folder)
    (tmp_path / "x.vcf").write_text("\n".join([*head, *lines]) + "\n")
    plain = vcf.read_vcf(spark, str(tmp_path / "x.vcf"))[1]
    whole = vcf.read_vcf(spark, folder)[1]
    assert whole.exceptAll(plain).count() == 0 and plain.exceptAll(whole).count() == 0
    index = blockgzip.block_index(files, split_bytes=20_000)
    ranges = blockgzip.ranges_of(index, "2", 70_000, 80_000)
    assert 0 < ranges.count() < blockgzip.splits(files, 20_000).count() / 3
    inside = lambda calls: calls.where("contig = 'chr2' and pos between 70000 and 80000").drop("info")
    assert sorted(map(str, inside(vcf.read_block_vcf(files, ranges)[1]).collect())) == sorted(map(str, inside(plain).collect()))
    assert inside(plain).count() == 2002
    assert vcf.read_block_vcf(files, blockgzip.ranges_of(index, "9", 1, 2))[1].count() == 0
    (tmp_path / "v" / "y.vcf").write_text("\n".join([*head, *lines[:2]]) + "\n")
    with pytest.raises(ValueError, match="mixes"):
        vcf.read_vcf(spark, folder)
