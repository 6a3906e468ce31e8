"""Queries that write the given tables as files and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.coloc_checks import BIOM
from genolith.checks.registry import genotypes, query
from genolith.operators import genotypes as gt
from genolith.session import scratch_table
from genolith.sources import blockgzip, sinks, tables, vcf

PEOPLE = "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment FROM customer"


@query("src1_read_table", PEOPLE)
def _(spark, d):
    path = sinks.write_table(fx.sql(spark, d, PEOPLE), scratch_table(spark, "people"), sep=",")
    return tables.read_table(spark, path, ",", "c_custkey bigint, c_name string, c_acctbal double, segment string")


@query("snk2_write_table", "SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type ELSE 'NA' END AS event_type, printf('%.3f', value) AS value FROM events")
def _(spark, d):
    e = fx.table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"), "value")
    path = sinks.write_table(e, scratch_table(spark, "events"), digits=3)
    return spark.read.option("sep", "\t").option("header", True).schema("event_id bigint, event_type string, value string").csv(path)


CALLS = """SELECT variant_key, sample_key, gt, gq, dp FROM fx_entries"""


@query("src2_read_vcf", """SELECT v.contig, v.pos, v.ref, v.alt, count(*) AS n, cast(coalesce(sum(gt), 0) AS BIGINT) AS ac, count(gt) AS n_called, cast(sum(dp) AS BIGINT) AS dp, cast(sum(gq) AS BIGINT) AS gq
  FROM fx_entries e JOIN fx_variants v USING (variant_key) GROUP BY ALL""")
def _(spark, d):
    path = sinks.write_vcf_shards(genotypes(spark, d), scratch_table(spark, "vcf"), n=8)
    _, calls = vcf.read_vcf(spark, path)
    split = gt.split_multi(calls.drop("info"))
    return split.groupBy("contig", "pos", "ref", "alt").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("gt"), F.lit(0)).alias("ac"), F.count("gt").alias("n_called"), F.sum("dp").alias("dp"), F.sum("gq").alias("gq"))


BLOCK_SQL = """SELECT v.contig, v.pos, v.ref, v.alt, count(*) AS n, cast(coalesce(sum(gt), 0) AS BIGINT) AS ac, count(gt) AS n_called, cast(sum(dp) AS BIGINT) AS dp
  FROM fx_entries e JOIN fx_variants v USING (variant_key){} GROUP BY ALL"""


def _block_vcf(spark, d, region=None):
    """Calls of the genotypes written as block-gzip files; those of a region through the block index."""
    lines, header = sinks.vcf_shards(genotypes(spark, d))
    files = blockgzip.write_block_gzip(lines, [sinks.META, header], scratch_table(spark, "vcf"))
    ranges = None if region is None else blockgzip.ranges_of(blockgzip.block_index(files), *region)
    _, calls = vcf.read_block_vcf(files, ranges)
    if region is not None:
        calls = calls.where((F.col("contig") == region[0]) & F.col("pos").between(region[1], region[2]))
    return gt.split_multi(calls.drop("info")).groupBy("contig", "pos", "ref", "alt").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("gt"), F.lit(0)).alias("ac"), F.count("gt").alias("n_called"), F.sum("dp").alias("dp"))


@query("src2_block_gzip", BLOCK_SQL.format(""))
def _(spark, d):
    return _block_vcf(spark, d)


@query("src2_block_region", BLOCK_SQL.format(" WHERE v.contig = 'chr2' AND v.pos BETWEEN 1 AND 100000000"))
def _(spark, d):
    return _block_vcf(spark, d, ("chr2", 1, 100_000_000))


# A call set with two alternate alleles, three samples and typed fields, spelled out per line; and what the split must give.
MULTI = "SELECT v.contig, v.pos, v.ref, v.alt, concat(v.ref, v.alt) AS alt2, p_partkey AS k, p_size AS z FROM part JOIN fx_variants v ON v.variant_key = p_partkey"
ALLELE = {"i": "least((k + s) % 3, (k + 2 * s) % 3)", "j": "greatest((k + s) % 3, (k + 2 * s) % 3)"}
DEPTH = ["z", "s", "k % 7"]
LIKELY = [f"(k + s + {n * n}) % 50" for n in range(6)]
COPIES = {1: [(0, 3, 5), (1, 4), (2,)], 2: [(0, 1, 2), (3, 4), (5,)]}


def _split_sql(a: int) -> str:
    pl = ", ".join(f"least({', '.join(LIKELY[n] for n in held)}, 99) AS pl{c}" for c, held in enumerate(COPIES[a]))
    return (f"SELECT contig, pos, {'alt' if a == 1 else 'alt2'} AS alt, concat('S', cast(s AS STRING)) AS sample, "
            f"cast(CASE WHEN {ALLELE['i']} = {a} THEN 1 ELSE 0 END + CASE WHEN {ALLELE['j']} = {a} THEN 1 ELSE 0 END AS INT) AS gt, "
            f"cast({' + '.join(DEPTH)} - ({DEPTH[a]}) AS BIGINT) AS ad_ref, cast({DEPTH[a]} AS BIGINT) AS ad_alt, {pl}, "
            f"cast(k % 5 + {a} AS BIGINT) AS ac, (k % {a + 1}) / 4e0 AS af, z % 2 = 0 AS typed, "
            f"z % 2 = 0 AND k % 5 + {a} >= 3 AS typed_common FROM ({MULTI}) m CROSS JOIN (SELECT unnest([1, 2, 3]) AS s) t")


@query("src2_vcf_fields", f"SELECT contig, pos, alt, sample, gt, ad_ref, ad_alt, cast(pl0 AS BIGINT) AS pl0, cast(pl1 AS BIGINT) AS pl1, cast(pl2 AS BIGINT) AS pl2, ac, af, typed, typed_common FROM ({_split_sql(1)} UNION ALL {_split_sql(2)}) q")
def _(spark, d):
    def entry(s: int) -> str:
        at = lambda text: text.replace("s", str(s)) if text == "s" else text.replace("+ s", f"+ {s}").replace("2 * s", f"2 * {s}")
        numbers = lambda parts: "concat_ws(',', " + ", ".join(f"cast({at(x)} AS STRING)" for x in parts) + ")"
        return f"concat(cast({at(ALLELE['i'])} AS STRING), '/', cast({at(ALLELE['j'])} AS STRING), ':', {numbers(DEPTH)}, ':', {numbers(LIKELY)})"

    info = "concat('AC=', k % 5 + 1, ',', k % 5 + 2, ';AF=', (k % 2) / 4e0, ',', (k % 3) / 4e0, CASE WHEN z % 2 = 0 THEN ';TYPED' ELSE '' END)"
    fields = ["contig", "cast(pos AS STRING)", "'.'", "ref", "concat(alt, ',', alt2)", "'.'", "'.'", info, "'GT:AD:PL'", entry(1), entry(2), entry(3)]
    lines = fx.sql(spark, d, MULTI).selectExpr(f"concat_ws('\t', {', '.join(fields)}) AS value")
    names = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "S1", "S2", "S3"])
    head = [sinks.META, '##INFO=<ID=TYPED,Number=0,Type=Flag,Description="typed">', names]
    path = sinks.write_with_header(lines.repartition(8), head, scratch_table(spark, "vcf"))
    _, calls = vcf.read_vcf(spark, path)
    split = gt.split_multi(calls)
    return split.select("contig", "pos", "alt", "sample", "gt", F.get("AD", F.lit(0)).alias("ad_ref"), F.get("AD", F.lit(1)).alias("ad_alt"),
                        *[F.get("PL", F.lit(i)).alias(f"pl{i}") for i in range(3)], F.get("info.AC", F.lit(0)).alias("ac"), F.get("info.AF", F.lit(0)).alias("af"), F.col("info.TYPED").alias("typed"),
                        (F.col("info.TYPED") & (F.get("info.AC", F.lit(0)) >= 3)).alias("typed_common"))


@query("snk3_vcf_shards", "SELECT contig, count(*) AS n_lines FROM fx_variants GROUP BY contig")
def _(spark, d):
    path = sinks.write_vcf_shards(genotypes(spark, d), scratch_table(spark, "vcf"), n=8)
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    return lines.groupBy(F.element_at(F.split("value", "\t"), 1).alias("contig")).agg(F.count(F.lit(1)).alias("n_lines"))


@query("src3_sample_list", "SELECT c_name AS \"Subject_ID\" FROM customer")
def _(spark, d):
    ids = fx.table(spark, d, "customer").select(F.col("c_name").alias("Subject_ID"))
    return tables.read_sample_list(spark, sinks.write_table(ids, scratch_table(spark, "ids")))


@query("src4_read_bed", "SELECT contig, start_pos, end_pos, gene_id AS name FROM fx_genes")
def _(spark, d):
    bed = fx.view(spark, d, "fx_genes").select("contig", (F.col("start_pos") - 1).alias("start"), "end_pos", "gene_id")
    return tables.read_bed(spark, sinks.write_table(bed, scratch_table(spark, "bed"), header=False))


BIM_SQL = """SELECT CASE WHEN {all_chr} THEN substr(contig, 4) ELSE contig END AS chrom, contig || ':' || cast(pos AS STRING) || ':' || ref || ':' || alt AS {id}, 0e0 AS {cm}, pos AS {pos}, alt AS {a1}, ref AS {a2} FROM fx_variants"""


@query("src6_headerless_bim", BIM_SQL.format(all_chr="true", id="snpid", cm="cm", pos="pos", a1="\"A1\"", a2="\"A2\""))
def _(spark, d):
    path = sinks.write_bim(fx.view(spark, d, "fx_variants"), scratch_table(spark, "bim"))
    return tables.read_headerless(spark, path, tables.BIM)


@query("snk4_bim_table", BIM_SQL.format(all_chr="true", id="varid", cm="pos_cm", pos="pos_bp", a1="a1", a2="a2"))
def _(spark, d):
    return sinks.bim_table(fx.view(spark, d, "fx_variants"))


@query("snk4_bim_mixed_names", BIM_SQL.format(all_chr="false", id="varid", cm="pos_cm", pos="pos_bp", a1="a1", a2="a2").replace("FROM fx_variants", "FROM (SELECT CASE WHEN variant_key % 3 = 0 THEN substr(contig, 4) ELSE contig END AS contig, pos, ref, alt FROM fx_variants) v"))
def _(spark, d):
    return sinks.bim_table(fx.sql(spark, d, "SELECT CASE WHEN variant_key % 3 = 0 THEN substr(contig, 4) ELSE contig END AS contig, pos, ref, alt FROM fx_variants"))


@query("src7_sniffed_sumstats", f"""SELECT SNPID AS "SNPID", CHR AS "CHR", POS AS "POS", BETA AS "BETA", PVAL AS "PVAL", SE AS "SE", F AS "F", cast(N AS DOUBLE) AS "N", A1 AS "A1", A2 AS "A2" FROM ({BIOM}) b""")
def _(spark, d):
    named = fx.sql(spark, d, BIOM).withColumnsRenamed({"SNPID": "variant.id", "CHR": "chr", "POS": "pos", "BETA": "Est", "PVAL": "Score.pval", "SE": "Est.SE", "F": "freq",
                                                       "N": "n.obs", "A1": "effect.allele", "A2": "other.allele"})
    return tables.read_sumstats(spark, sinks.write_table(named, scratch_table(spark, "assoc"), sep=" ")).select(
        "SNPID", "CHR", "POS", "BETA", "PVAL", "SE", "F", "N", "A1", "A2")


RESULT = "SELECT p_partkey AS gene, p_retailprice AS pvalue, p_brand, p_type FROM part"


@query("src8_labelled_files", f"SELECT gene, pvalue, CASE WHEN p_type = 'ECONOMY' THEN 'Meta' ELSE p_type END AS tissue, replace(p_brand, '#', '') AS phenotype FROM ({RESULT}) r")
def _(spark, d):
    rows = fx.sql(spark, d, RESULT)
    base = scratch_table(spark, "labelled")
    # One file per label pair, named like the result files of a tissue run and read back by those names.
    label = F.when(F.col("p_type") == "ECONOMY", "smultixcan").otherwise(F.col("p_type"))
    named = rows.select("gene", "pvalue", F.concat(F.regexp_replace("p_brand", "#", ""), F.lit("."), label, F.lit(".csv")).alias("file"))
    named.write.mode("overwrite").partitionBy("file").option("header", True).option("sep", "\t").csv(base)
    store = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    paths = []
    for folder in store.listStatus(path(base)):
        if not folder.isDirectory():
            continue
        name = folder.getPath().getName().removeprefix("file=").removesuffix(".csv")
        for i, part in enumerate(store.listStatus(folder.getPath())):
            if part.getPath().getName().endswith(".csv"):
                target = path(f"{base}/{name}.{i}.csv")
                store.rename(part.getPath(), target)
                paths.append(target.toString())
    return tables.read_labelled(spark, paths, schema="gene bigint, pvalue double").select("gene", "pvalue", "tissue", "phenotype")


READS = "SELECT concat('S', cast(l_suppkey AS STRING)) AS sample, l_orderkey * 10 + l_linenumber AS read_no, concat('I:1:H', cast(l_partkey % 5 AS STRING), CASE WHEN l_quantity > 49 THEN 'X' ELSE '' END, ':1:2:3:4') AS read_name FROM lineitem"


@query("src9_flowcells", f"""SELECT sample, string_agg(DISTINCT split_part(read_name, ':', 3), '+' ORDER BY split_part(read_name, ':', 3)) AS flowcells FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY read_no, read_name) AS rn
  FROM ({READS}) r) q WHERE rn <= 20 GROUP BY sample""")
def _(spark, d):
    return tables.extract_flowcells(fx.sql(spark, d, READS).withColumn("read_no", F.struct("read_no", "read_name")), 20)


@query("src10_endpoint", "SELECT * FROM fx_variants")
def _(spark, d):
    path = sinks.write_endpoint(fx.view(spark, d, "fx_variants"), scratch_table(spark, "endpoint"))
    return tables.read_endpoint(spark, path)


@query("snk1_endpoint_by_contig", "SELECT * FROM fx_variants")
def _(spark, d):
    path = sinks.write_endpoint(fx.view(spark, d, "fx_variants"), scratch_table(spark, "endpoint"))
    # Each chromosome comes from its own folder.
    read = tables.read_endpoint(spark, path)
    parts = [read.where(F.col("contig") == f"chr{i}") for i in range(1, 23)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("set2_gather_shards", "SELECT event_id, event_type, value FROM events")
def _(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "event_type", "value")
    paths = [sinks.write_table(e.where(F.col("event_type") == t), scratch_table(spark, "shard"), sep=" ") for t in ("view", "click", "purchase")]
    paths.append(sinks.write_table(e.where(~F.col("event_type").isin("view", "click", "purchase")), scratch_table(spark, "shard"), sep=" "))
    return tables.gather_shards(spark, paths, " ", "event_id bigint, event_type string, value double")


@query("set6_concatenated_reports", "SELECT l_returnflag AS phenotype, l_linestatus AS tissue, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, d):
    from genolith.operators.samples import union_endpoints
    li = fx.table(spark, d, "lineitem")
    parts = [li.where(F.col("l_returnflag") == f).select(F.lit(f).alias("phenotype"), F.col("l_linestatus").alias("tissue")) for f in ("A", "N", "R")]
    return union_endpoints(parts).groupBy("phenotype", "tissue").agg(F.count(F.lit(1)).alias("n"))


KIN_SELF = "SELECT s_suppkey AS id, 1000 + s_nationkey AS nsnp, s_acctbal / 100000e0 AS f FROM supplier"
KIN_BETWEEN = "SELECT DISTINCT a.l_suppkey AS id1, a.l_suppkey + 1 AS id2, 900 AS nsnp, (a.l_suppkey % 50) / 400e0 AS kin FROM lineitem a"


@query("snk5_grm_triplets", f"""WITH ids AS (SELECT id, row_number() OVER (ORDER BY id) AS i FROM ({KIN_SELF}) k), allk AS (SELECT id AS id1, id AS id2, nsnp, 5e-1 * (1 + f) AS kin FROM ({KIN_SELF}) s UNION ALL SELECT * FROM ({KIN_BETWEEN}) b)
  SELECT cast(a.i AS INT) AS id1, cast(b.i AS INT) AS id2, nsnp, printf('%.4f', 2 * kin) AS kin FROM allk JOIN ids a ON a.id = id1 JOIN ids b ON b.id = id2""")
def _(spark, d):
    return sinks.kinship_to_grm(fx.sql(spark, d, KIN_SELF), fx.sql(spark, d, KIN_BETWEEN))[0]


@query("prj25_endpoint_name", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('set', cast(p_size AS VARCHAR), '.LOF_filtered') ELSE concat('set', cast(p_size AS VARCHAR), '.QC.LOF_filtered') END AS name FROM part")
def _(spark, d):
    stems = fx.table(spark, d, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 2 = 0 THEN concat('set', p_size, '.VEP_annotated.mt') ELSE concat('set', p_size, '.QC.mt') END AS stem")
    return stems.select("p_partkey", gt.endpoint_name(F.col("stem"), "LOF_filtered").alias("name"))
