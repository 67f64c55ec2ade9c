"""Readers of the suite's files. Schemas are explicit; missing columns are errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import spread_join
from .block_gzip import read_block_gzip

#: Parts of a PLINK data set, one folder each.
PLINK_KINDS = ("ped", "map", "geno", "hlist")
#: Sample names of VCF headers are broadcast up to this size.
BROADCAST_BYTES = 32 << 20

#: Columns of a wrangler's table and the names that we give them.
HAPLOTYPE_COLUMNS = {"s_Sample": "sample_id", "p_geneName": "gene", "p_targetName": "mip", "h_popUID": "haplotype_id", "h_seq": "haplotype_sequence", "c_qual": "sequence_quality", "c_readCnt": "read_count", "c_barcodeCnt": "umi_count"}


def _tsv(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return spark.read.options(header=True, sep="\t", **options).csv(path)


def _need(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = [c for c in columns if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {gone}")
    return df


def read_haplotype_calls(spark: SparkSession, path: str, columns: dict[str, str] = HAPLOTYPE_COLUMNS) -> DataFrame:
    """Plain or gzipped tables; the named columns under their new names, counts as whole numbers."""
    raw = _need(_tsv(spark, path), list(columns))
    out = raw.select(*[F.col(a).alias(b) for a, b in columns.items()])
    return out.withColumns({c: F.col(c).cast("double").cast("bigint") for c in ("read_count", "umi_count") if c in out.columns})


def read_library_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with sample_id name-set-replicate and probe_sets as an array."""
    raw = _need(_tsv(spark, path), ["sample_name", "sample_set", "replicate", "probe_set"])
    return raw.withColumns({"sample_id": F.concat_ws("-", "sample_name", "sample_set", "replicate"), "probe_sets": F.transform(F.split("probe_set", ","), F.trim)})


_COPY = "struct<chrom: string, capture_start: bigint, capture_end: bigint, orientation: string, capture_sequence: string>"
_CATALOGUE = f"map<string, map<string, struct<copies: map<string, {_COPY}>>>>"


def read_probe_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """One row per gene, probe and copy of nested JSON files, with the file's path; probe and sub-region numbers from the name."""
    text = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("file"), F.from_json("value", _CATALOGUE).alias("j"))
    mips = text.select("file", F.explode("j").alias("gene", "m")).select("file", "gene", F.explode("m").alias("mip", "d"))
    copies = mips.select("file", "gene", "mip", F.explode("d.copies").alias("copy", "c")).select("file", "gene", "mip", "copy", "c.*")
    number = lambda p: F.regexp_extract("mip", p, 1).try_cast("int")
    return copies.withColumns({"mip_number": number("_mip(\\d+)"), "sub_number": number("_Sub(\\d+)")})


def merge_probe_catalogues(catalogues: Sequence[DataFrame]) -> DataFrame:
    """All catalogues; of a gene and probe that several have, the last one's copies."""
    rows = None
    for i, c in enumerate(catalogues):
        part = c.withColumn("_i", F.lit(i))
        rows = part if rows is None else rows.unionByName(part)
    last = F.max("_i").over(Window.partitionBy("gene", "mip"))
    return rows.withColumn("_last", last).where("_i = _last").drop("_i", "_last")


def parse_vcf(lines: DataFrame, samples: Sequence[str] | None = None) -> DataFrame:
    """One row per site and sample of VCF lines (column value, and file to tell several files apart).

    chrom, pos, id, ref, alt, qual, filter, info (map; flags are 'true'), sample, call (map from FORMAT keys). A file's
    samples are named by its header, or for all files by samples, as a file in parts has one header only.
    """
    lines = lines if "file" in lines.columns else lines.withColumn("file", F.lit(""))
    cells = lines.where(~F.col("value").startswith("#")).select("file", F.split("value", "\t").alias("f"))
    if samples is None:
        heads = lines.where(F.col("value").startswith("#CHROM")).select("file", F.slice(F.split("value", "\t"), 10, 1 << 30).alias("samples"))
        names = materialize(heads.groupBy("file").agg(F.first("samples").alias("samples")), "vcf-headers")  # one row for each file
        size = names.agg(F.coalesce(F.sum(F.octet_length(F.concat_ws("", "samples", "file")) + 64), F.lit(0))).first()[0]
        base = cells.join(F.broadcast(names) if size <= BROADCAST_BYTES else names, "file")
    else:
        base = cells.withColumn("samples", F.array(*map(F.lit, samples)))
    info = F.transform_values(F.str_to_map(F.col("f")[7], F.lit(";"), F.lit("=")), lambda k, v: F.coalesce(v, F.lit("true")))
    base = base.select(
        "file", F.col("f")[0].alias("chrom"), F.col("f")[1].cast("bigint").alias("pos"), F.col("f")[2].alias("id"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"), F.col("f")[5].try_cast("double").alias("qual"), F.col("f")[6].alias("filter"),
        info.alias("info"), F.split(F.get("f", F.lit(8)), ":").alias("_keys"), F.explode(F.arrays_zip(F.col("samples").alias("s"), F.slice("f", 10, 1 << 30).alias("v"))).alias("_c"),
    )
    values = F.split("_c.v", ":")
    pairs = F.transform("_keys", lambda k, i: F.struct(k.alias("key"), F.get(values, i).alias("value")))
    return base.select("file", "chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", F.col("_c.s").alias("sample"), F.map_from_entries(pairs).alias("call"))


def read_vcf(spark: SparkSession, path: str, samples: Sequence[str] | None = None, block_gzip: bool = False) -> DataFrame:
    """parse_vcf() of plain or gzipped files. block_gzip: the files are block-gzipped, and many tasks read one."""
    if block_gzip:
        return parse_vcf(read_block_gzip(spark, path).select(F.col("path").alias("file"), "value"), samples)
    return parse_vcf(spark.read.text(path).withColumn("file", F.input_file_name()), samples)


def vcf_samples(lines: DataFrame) -> list[str]:
    """The sample names of the first header among VCF lines."""
    head = lines.where(F.col("value").startswith("#CHROM")).first()
    return head["value"].split("\t")[9:] if head else []


def parse_sam(lines: DataFrame) -> DataFrame:
    """The eleven columns and the alignment score, -5000 without one, of SAM lines (column value)."""
    f = F.split("value", "\t")
    text = ["haplotype_id", "flag", "chrom", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    whole = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
    score = F.coalesce(F.regexp_extract("value", "\tAS:i:(-?\\d+)", 1).try_cast("int"), F.lit(-5000))
    return lines.where(~F.col("value").startswith("@")).select(*[f[i].cast(whole.get(n, "string")).alias(n) for i, n in enumerate(text)], score.alias("alignment_score"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(spark.read.text(path))


def read_lastz_general(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Alignment tables with a '#' before the header, as one; columns are matched by name."""
    out = None
    for p in paths:
        part = _tsv(spark, p)
        part = part.withColumnRenamed(part.columns[0], part.columns[0].lstrip("#"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_genepred(spark: SparkSession, path: str) -> DataFrame:
    """Gene models with exon bounds as arrays."""
    names = "bin name chrom strand tx_start tx_end cds_start cds_end exon_count exon_starts exon_ends score gene cds_start_stat cds_end_stat exon_frames".split()
    raw = spark.read.options(sep="\t").schema(", ".join(f"{n} string" for n in names)).csv(path)
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    return raw.withColumns({"exon_starts": numbers("exon_starts"), "exon_ends": numbers("exon_ends"), **{c: F.col(c).cast("bigint") for c in ("tx_start", "tx_end", "cds_start", "cds_end")}})


def read_fasta(spark: SparkSession, path: str, full_name: bool = False) -> DataFrame:
    """id (up to the first white space unless full_name), seq, and whether the id occurs again.

    A record begins with '>' at the start of a line; a name may hold others.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where(F.trim("value") != "")
    head = F.regexp_extract("value", "^([^\r\n]*)", 1)
    rows = records.select((head if full_name else F.split(head, "\\s")[0]).alias("id"), F.translate(F.regexp_replace("value", "^[^\n]*", ""), "\r\n", "").alias("seq"))
    return rows.withColumn("repeated", F.count("*").over(Window.partitionBy("id")) > 1)


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """path, line (from 0 in its file) and value of lines with path, block and at, whose order is that of block and at.

    The lines are written once, as what a second scan is cut into isn't sure; counts by block, one small row each, give
    the first numbers of a file's blocks.
    """
    lines = materialize(lines, "lines")
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("from"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = blocks.select("path", "block", (before - F.col("from")).alias("shift"), "n")
    return spread_join(lines, shifts, ["path", "block"]).select("path", (F.col("at") + F.col("shift")).alias("line"), "value")


def read_fastq(spark: SparkSession, paths: str | Sequence[str], block_gzip: bool = False) -> DataFrame:
    """path, id, seq and qual of plain or gzipped files; a record that the file's end cuts off is left out.

    No file has to fit in memory. block_gzip: the files are block-gzipped, and many tasks read one; plain gzip is read
    by one task a file.
    """
    if block_gzip:
        lines = read_block_gzip(spark, paths).select("value", "path", F.col("part").cast("long").alias("block"), F.col("line").alias("at"))
    else:
        lines = spark.read.text(paths).select("value", F.input_file_name().alias("path"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("at"))
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    records = _numbered_lines(lines).groupBy("path", F.floor(F.col("line") / 4).alias("record")).agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("qual"))
    return records.where("qual is not null").select("path", F.expr("substring(head, 2)").alias("id"), "seq", "qual")


def read_plink(spark: SparkSession, path: str) -> DataFrame:
    """kind (ped, map, geno or hlist) and line of the tables below a path, as write_plink() writes them."""
    out = None
    for kind in PLINK_KINDS:
        part = spark.read.text(f"{path}/{kind}").select(F.lit(kind).alias("kind"), F.col("value").alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


def read_pmo(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """The rows of one kind of part (panel, detected or representative) of a written document, with its ids."""
    parts = spark.read.schema("panel_id string, run_id string, json string, kind string").json(path).where(F.col("kind") == kind)
    return parts.select("panel_id", "run_id", F.from_json("json", schema).alias("j")).select("panel_id", "run_id", "j.*")


def _quoted_cells(line: Column) -> Column:
    """Cells of a comma-separated line, some of them in quotes."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def read_wide_matrix(spark: SparkSession, path: str, levels: Sequence[str]) -> DataFrame:
    """Long form of a matrix with header rows: sample_id, one column per level, and value (null if empty).

    Header lines are told by their first cell, the level's name. The cells' positions join them to the data lines. A
    single level named sample_id, as a plain table has it, is returned as column name.
    """
    cells = F.when(F.contains("value", F.lit('"')), _quoted_cells(F.col("value"))).otherwise(F.split("value", ",", -1))
    lines = spark.read.text(path).select(cells.alias("f"))
    first = "name" if list(levels) == ["sample_id"] else None
    named = lines.where(F.col("f")[0].isin(list(levels))).select(F.col("f")[0].alias("level"), F.posexplode("f").alias("at", "name")).where("at > 0")
    heads = named.groupBy("at").pivot("level", list(levels)).agg(F.first("name"))
    heads = heads.withColumnRenamed("sample_id", first) if first else heads
    cells = lines.where(~F.col("f")[0].isin(list(levels))).select(F.col("f")[0].alias("sample_id"), F.posexplode("f").alias("at", "cell")).where("at > 0")
    return cells.join(heads, "at").select("sample_id", *([first] if first else levels), F.col("cell").try_cast("double").alias("value"))


def read_demux_stats(spark: SparkSession, path: str) -> DataFrame:
    """sample_number, lane (from the file's name) and reads of the instrument's summaries."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    lane = F.regexp_extract(F.input_file_name(), "L(?:ane)?(\\d+)[^/]*$", 1).try_cast("int")
    return raw.select(F.col("SampleNumber").cast("int").alias("sample_number"), lane.alias("lane"), F.col("NumberOfReadsRaw").cast("bigint").alias("reads_raw"), F.col("NumberOfReadsPF").cast("bigint").alias("reads_pf"))


def read_undetermined(spark: SparkSession, path: str) -> DataFrame:
    """Index pairs and their reads from the lines of that shape; others are passed over."""
    pattern = "^([ACGTN]+\\+[ACGTN]+)\t(\\d+)$"
    return spark.read.text(path).where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("header"), F.regexp_extract("value", pattern, 2).cast("bigint").alias("reads"))


def read_targets(spark: SparkSession, coordinates: str | None = None, snps: str | None = None) -> DataFrame:
    """Design targets of coordinate and SNP files as one table: name, chrom, start, stop, capture_type."""
    parts = []
    if coordinates:
        c = _need(_tsv(spark, coordinates), ["Name", "Chrom", "Start", "End", "CaptureType"])
        parts.append(c.select(F.col("Name").alias("name"), F.col("Chrom").alias("chrom"), F.col("Start").cast("bigint").alias("start"), F.col("End").cast("bigint").alias("stop"), F.col("CaptureType").alias("capture_type")))
    if snps:
        s = _need(_tsv(spark, snps), ["Chrom", "Start", "End", "Name"])
        parts.append(s.select(F.col("Name").alias("name"), F.col("Chrom").alias("chrom"), F.col("Start").cast("bigint").alias("start"), F.col("End").cast("bigint").alias("stop"), F.lit("targets").alias("capture_type")))
    if not parts:
        raise ValueError("no target file")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_plates(spark: SparkSession, path: str) -> DataFrame:
    """Sample plates with the well's row and column."""
    raw = _need(_tsv(spark, path), ["sample_name", "sample_plate", "sample_well"])
    return raw.withColumns({"well_row": F.substring("sample_well", 1, 1), "well_column": F.expr("substring(sample_well, 2)").cast("int")})
