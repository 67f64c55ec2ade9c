"""Queries for sources/: tables are written in a file format to the shared scratch folder, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..scratch import scratch_path
from ..sources import readers as R
from ..sources import writers as W
from ..sources.block_gzip import write_block_gzip
from .registry import query, rows


def _tsv(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.options(header=True, sep="\t", compression="gzip").csv(path)
    return path


def _text(df, name, **options):
    path = scratch_path(df.sparkSession, name)
    df.write.text(path, **options)
    return path


@query("read_haplotype_calls", "SELECT sample_id, gene, mip, haplotype_id, haplotype_sequence, sequence_quality, read_count, umi_count FROM calls")
def read_haplotype_calls(spark, sf):
    back = {v: k for k, v in R.HAPLOTYPE_COLUMNS.items()}
    calls = rows(spark, sf, "calls").select(*[F.col(c).alias(back[c]) for c in back])
    return R.read_haplotype_calls(spark, _tsv(calls, "calls"))


@query("read_library_sheet", "SELECT sample_name || '-' || sample_set || '-' || ord AS sample_id, string_split(probe_set, ',') AS probe_sets FROM requests")
def read_library_sheet(spark, sf):
    sheet = rows(spark, sf, "requests").select("sample_name", "sample_set", F.col("ord").alias("replicate"), "probe_set")
    return R.read_library_sheet(spark, _tsv(sheet, "sheet")).select("sample_id", "probe_sets")


_NAMED = "SELECT gene, gene || '_S0_Sub' || length(mip) || '_mip' || substr(mip, 4) AS mip, copy, chrom, capture_start, capture_end, orientation FROM probe_copies"


def _catalogue(spark, sf):
    """One JSON file per gene, as the probe catalogue nests them."""
    copies = rows(spark, sf, _NAMED)
    entry = lambda k, v: F.map_from_entries(F.collect_list(F.struct(F.col(k).alias("k"), v.alias("v"))))
    mips = copies.groupBy("gene", "mip").agg(entry("copy", F.struct("chrom", "capture_start", "capture_end", "orientation")).alias("copies"))
    genes = mips.groupBy("gene").agg(entry("mip", F.struct("copies")).alias("m"))
    files = genes.select("gene", F.to_json(F.create_map("gene", "m")).alias("value")).repartition("gene")
    path = scratch_path(spark, "catalogue")
    files.write.partitionBy("gene").text(path)
    return R.read_probe_catalogue(spark, f"{path}/gene=*")


@query("read_probe_catalogue", f"SELECT gene, mip, copy, chrom, capture_start, capture_end, orientation, substr(mip, strpos(mip, '_mip') + 4)::INT AS mip_number, regexp_extract(mip, '_Sub([0-9]+)', 1)::INT AS sub_number FROM ({_NAMED})")
def read_probe_catalogue(spark, sf):
    return _catalogue(spark, sf).drop("file", "capture_sequence")


@query("merge_probe_catalogues", f"SELECT gene, mip, copy, CASE WHEN copy = 'C1' THEN 'new' ELSE 'old' END AS origin FROM ({_NAMED}) AS n WHERE copy = 'C1' OR mip NOT IN (SELECT mip FROM ({_NAMED}) WHERE copy = 'C1')")
def merge_probe_catalogues(spark, sf):
    copies = rows(spark, sf, _NAMED)
    return R.merge_probe_catalogues([copies.withColumn("origin", F.lit("old")), copies.where("copy = 'C1'").withColumn("origin", F.lit("new"))]).select("gene", "mip", "copy", "origin")


_SITES = "SELECT l_partkey AS pos, 'chr' || l_linenumber AS chrom, max(l_suppkey) AS s, cast(sum(l_quantity) AS bigint) AS q, count(*) AS n FROM lineitem GROUP BY l_partkey, l_linenumber"


def _vcf(spark, sf):
    head = spark.range(1).select(F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.lit("\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT S1 S2".split())))).alias("value"))
    body = rows(spark, sf, _SITES).select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), F.lit("A"), F.lit("G"), F.col("q").cast("string"), F.when(F.col("s") % 2 == 0, "PASS").otherwise("LowQual;Bias"), F.concat(F.lit("DP="), F.col("q").cast("string"), F.lit(";OT")), F.lit("GT:DP"), F.concat(F.lit("0/1:"), F.col("n").cast("string")), F.lit("./.")).alias("value"))
    return head.unionByName(body)


@query("read_vcf", f"WITH v AS ({_SITES}) SELECT chrom, pos, q::DOUBLE AS qual, q::VARCHAR AS dp_info, 'true' AS ot, 'S' || k AS sample, CASE k WHEN 1 THEN '0/1' ELSE './.' END AS gt, CASE k WHEN 1 THEN n::VARCHAR END AS dp FROM v, (SELECT unnest([1, 2]) AS k)")
def read_vcf(spark, sf):
    # many part files, of which one has the header
    path = _text(_vcf(spark, sf), "vcf")
    back = R.read_vcf(spark, path, R.vcf_samples(spark.read.text(path)))
    return back.select("chrom", "pos", "qual", F.col("info")["DP"].alias("dp_info"), F.col("info")["OT"].alias("ot"), "sample", F.col("call")["GT"].alias("gt"), F.col("call")["DP"].alias("dp"))


_VCF_LINE = "concat_ws(chr(9), chrom, pos, '.', 'A', 'G', q, 'PASS', 'DP=' || q || ';OT', 'GT:DP', '0/1:' || n, './.')"


@query("write_vcf_filtered", f"SELECT {_VCF_LINE} AS line FROM ({_SITES}) WHERE s % 2 = 0 UNION ALL SELECT unnest(['##fileformat=VCFv4.2', concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 'S1', 'S2')])")
def write_vcf_filtered(spark, sf):
    path = scratch_path(spark, "filtered")
    W.write_lines(W.filter_vcf_lines(_vcf(spark, sf), ["LowQual"]), path, "value")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("write_target_vcf", f"SELECT chrom, pos, chrom || chr(9) || pos || chr(9) || '.' || chr(9) || 'A' || chr(9) || 'T' || chr(9) || '.' || chr(9) || '.' || chr(9) || '.' AS line FROM ({_SITES})")
def write_target_vcf(spark, sf):
    return W.target_vcf(rows(spark, sf, _SITES).withColumns({"ref": F.lit("A"), "alt": F.lit("T")}))


@query("read_sam", "SELECT haplotype_id, chrom, pos, CASE WHEN alignment_score % 2 = 0 THEN alignment_score ELSE -5000 END AS alignment_score FROM alignments")
def read_sam(spark, sf):
    lines = rows(spark, sf, "alignments").select(F.concat_ws("\t", "haplotype_id", F.lit("0"), "chrom", F.col("pos").cast("string"), F.lit("60"), F.lit("10M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"), F.when(F.col("alignment_score") % 2 == 0, F.concat(F.lit("AS:i:"), F.col("alignment_score").cast("string")))).alias("value"))
    back = R.read_sam(spark, _text(lines.unionByName(spark.range(1).select(F.lit("@HD\tVN:1.6").alias("value"))), "sam"))
    return back.select("haplotype_id", "chrom", "pos", "alignment_score")


@query("read_lastz_general", "SELECT name, chrom, start::VARCHAR AS start FROM targets UNION ALL SELECT name, chrom, NULL FROM targets")
def read_lastz_general(spark, sf):
    t = rows(spark, sf, "targets")
    a = t.select(F.col("name").alias("#name"), "chrom", "start")
    b = t.select(F.col("chrom").alias("#chrom"), "name")
    return R.read_lastz_general(spark, [_tsv(a, "lastz"), _tsv(b, "lastz")]).select("name", "chrom", "start")


@query("read_genepred", "SELECT name, gene, chrom, strand, tx_start, cds_end, [e0, e1, e2] AS exon_starts, [f0, f1, f2] AS exon_ends FROM transcripts")
def read_genepred(spark, sf):
    t = rows(spark, sf, "transcripts")
    comma = lambda *c: F.concat(F.concat_ws(",", *c), F.lit(","))
    zero = F.lit("0")
    table = t.select(zero.alias("b"), "name", "chrom", "strand", "tx_start", "tx_end", "cds_start", "cds_end", F.lit("3").alias("n"), comma("e0", "e1", "e2").alias("s"), comma("f0", "f1", "f2").alias("e"), zero.alias("z"), "gene", F.lit("c").alias("c1"), F.lit("c").alias("c2"), F.lit("0,").alias("fr"))
    path = scratch_path(spark, "genepred")
    table.write.option("sep", "\t").csv(path)
    return R.read_genepred(spark, path).select("name", "gene", "chrom", "strand", "tx_start", "cds_end", "exon_starts", "exon_ends")


_SEQS_SQL = "SELECT doc_id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS seq FROM documents"


def _seqs(spark, sf):
    return rows(spark, sf, "SELECT doc_id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '') AS seq FROM documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "seq")


@query("write_fasta", f"SELECT 'd' || doc_id AS id, seq, false AS repeated FROM ({_SEQS_SQL})")
def write_fasta(spark, sf):
    path = scratch_path(spark, "fasta")
    W.write_fasta(_seqs(spark, sf).withColumn("id", F.concat("id", F.lit(" note"))), path)
    return R.read_fasta(spark, path)


@query("read_fasta", f"SELECT 'd' || doc_id || '>x c.76A>T' AS id, seq, false AS repeated FROM ({_SEQS_SQL})")
def read_fasta(spark, sf):
    path = scratch_path(spark, "fasta")
    W.write_fasta(_seqs(spark, sf).withColumn("id", F.concat("id", F.lit(">x c.76A>T"))), path)
    return R.read_fasta(spark, path, full_name=True)


@query("read_fastq", f"SELECT '@d' || doc_id AS id, seq, repeat('@', length(seq)) AS qual FROM ({_SEQS_SQL})")
def read_fastq(spark, sf):
    record = W.fastq_record(F.concat(F.lit("@"), "id"), F.col("seq"), F.repeat(F.lit("@"), F.length("seq")))
    return R.read_fastq(spark, _text(_seqs(spark, sf).select(record.alias("value")), "fastq")).select("id", "seq", "qual")


@query("read_fastq_blocks", f"SELECT 'd' || doc_id AS id, seq, repeat('I', length(seq)) AS qual FROM ({_SEQS_SQL})")
def read_fastq_blocks(spark, sf):
    """Block-gzipped files, each read in pieces whose borders lie inside records."""
    record = W.fastq_record(F.col("id"), F.col("seq"), F.repeat(F.lit("I"), F.length("seq")))
    path = scratch_path(spark, "fastq-blocks")
    write_block_gzip(_seqs(spark, sf).select(record.alias("value")), path)
    return R.read_fastq(spark, path, block_gzip=True).select("id", "seq", "qual")


@query("read_vcf_blocks", f"WITH v AS ({_SITES}) SELECT chrom, pos, q::DOUBLE AS qual, 'S' || k AS sample, CASE k WHEN 1 THEN '0/1' ELSE './.' END AS gt FROM v, (SELECT unnest([1, 2]) AS k)")
def read_vcf_blocks(spark, sf):
    path = scratch_path(spark, "vcf-blocks")
    write_block_gzip(_vcf(spark, sf), path)
    back = R.read_vcf(spark, path, ["S1", "S2"], block_gzip=True)
    return back.select("chrom", "pos", "qual", "sample", F.col("call")["GT"].alias("gt"))


@query("write_fastq_per_sample", f"SELECT 'S' || doc_id % 5 AS sample_id, 'd' || doc_id AS id, seq, repeat('I', length(seq)) AS qual FROM ({_SEQS_SQL})")
def write_fastq_per_sample(spark, sf):
    path = scratch_path(spark, "fastq")
    reads = _seqs(spark, sf).select(F.concat(F.lit("S"), (F.expr("cast(substring(id, 2) AS bigint)") % 5).cast("string")).alias("sample_id"), F.col("id").alias("name"), "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))
    W.write_fastq_per_sample(reads, path)
    back = R.read_fastq(spark, f"{path}/sample_id=*/*.gz")
    return back.select(F.regexp_extract("path", "sample_id=([^/]+)", 1).alias("sample_id"), "id", "seq", "qual")


@query("write_long", "SELECT variant, gene, sample_id, alt FROM depths")
def write_long(spark, sf):
    path = scratch_path(spark, "long")
    W.write_long(rows(spark, sf, "SELECT variant, gene, sample_id, alt FROM depths"), path, ["gene"])
    return spark.read.parquet(path).select("variant", "gene", "sample_id", "alt")


def _wide_back(spark, sf, value):
    """All variants of a value as a wide file, read back and turned long."""
    path, depths = scratch_path(spark, "wide"), rows(spark, sf, "depths")
    W.write_wide_matrix(depths, path, "sample_id", "variant", value)
    back = R.read_wide_matrix(spark, path, ["sample_id"]).where("value is not null")
    return back.toDF("sample_id", "variant", value).withColumn(value, F.col(value).cast("bigint"))


@query("write_wide_matrix", "SELECT sample_id, variant, ref FROM depths")
def write_wide_matrix(spark, sf):
    return _wide_back(spark, sf, "ref")


@query("write_wide_matrix_whole", "SELECT sample_id, variant, alt FROM depths")
def write_wide_matrix_whole(spark, sf):
    return _wide_back(spark, sf, "alt")


def _matrix(spark, sf, value):
    """All variants of a value as a matrix with header rows, read back."""
    path, depths = scratch_path(spark, "matrix"), rows(spark, sf, "depths").withColumnsRenamed({"gene": "Gene", "variant": "Mutation Name"})
    W.write_header_matrix(depths, path, "sample_id", ["Gene", "Mutation Name"], value)
    return R.read_wide_matrix(spark, path, ["Gene", "Mutation Name"]).where("value is not null")


@query("read_wide_matrix", "SELECT sample_id, gene AS \"Gene\", variant AS \"Mutation Name\", coverage::DOUBLE AS value FROM depths")
def read_wide_matrix(spark, sf):
    return _matrix(spark, sf, "coverage")


@query("read_wide_matrix_whole", "SELECT sample_id, gene AS \"Gene\", variant AS \"Mutation Name\", alt::DOUBLE AS value FROM depths")
def read_wide_matrix_whole(spark, sf):
    return _matrix(spark, sf, "alt")


@query("read_demux_stats", "SELECT l_suppkey::INT AS sample_number, sum(cast(l_quantity AS bigint))::BIGINT AS reads_raw FROM lineitem GROUP BY l_suppkey")
def read_demux_stats(spark, sf):
    table = rows(spark, sf, "SELECT l_suppkey AS SampleNumber, cast(sum(l_quantity) AS bigint) AS NumberOfReadsRaw, cast(sum(l_quantity) AS bigint) AS NumberOfReadsPF FROM lineitem GROUP BY l_suppkey")
    return R.read_demux_stats(spark, _tsv(table, "demux")).select("sample_number", "reads_raw")


@query("read_targets", "SELECT name, chrom, start, stop, capture_type FROM targets UNION ALL SELECT name || 's', chrom, start, start, 'targets' FROM targets")
def read_targets(spark, sf):
    t = rows(spark, sf, "targets")
    coordinates = t.select(F.col("name").alias("Name"), F.col("chrom").alias("Chrom"), F.col("start").alias("Start"), F.col("stop").alias("End"), F.col("capture_type").alias("CaptureType"))
    snps = t.select(F.col("chrom").alias("Chrom"), F.col("start").alias("Start"), F.col("start").alias("End"), F.concat("name", F.lit("s")).alias("Name"), F.lit(0).alias("InsertionLength"))
    return R.read_targets(spark, _tsv(coordinates, "coordinates"), _tsv(snps, "snps"))


@query("read_plates", "SELECT c_name AS sample_name, substr('ABCDEFGH', (c_custkey % 8 + 1)::INT, 1) AS well_row, (c_custkey % 12 + 1)::INT AS well_column FROM customer")
def read_plates(spark, sf):
    plates = rows(spark, sf, "SELECT c_name AS sample_name, 'P1' AS sample_plate, substr('ABCDEFGH', cast(c_custkey % 8 + 1 AS int), 1) || (c_custkey % 12 + 1) AS sample_well FROM customer")
    return R.read_plates(spark, _tsv(plates, "plates")).select("sample_name", "well_row", "well_column")
