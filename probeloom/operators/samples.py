"""Library sheets, sample lists and run statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reverse_complement
from ..spread import running_total
from .intervals import overlap_join


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on all columns that both have."""
    return a.join(b, [c for c in a.columns if c in b.columns])


def build_sample_sheet(capture: DataFrame, samples: DataFrame, *lookups: DataFrame, legacy: DataFrame | None = None) -> DataFrame:
    """Capture plates joined with sample plates and the index and quadrant lookups, without repeats, legacy rows added."""
    sheet = reduce(natural_join, lookups, natural_join(capture, samples)).dropDuplicates()
    return sheet if legacy is None else sheet.unionByName(legacy, allowMissingColumns=True)


def plate_orphans(capture: DataFrame, samples: DataFrame) -> DataFrame:
    """Plates without a partner: kind 'missing' if referenced only, 'unused' if supplied only."""
    a, b = capture.select("sample_plate").distinct(), samples.select("sample_plate").distinct()
    gone = a.join(b, "sample_plate", "left_anti").withColumn("kind", F.lit("missing"))
    return gone.unionByName(b.join(a, "sample_plate", "left_anti").withColumn("kind", F.lit("unused")))


def assign_replicates(requests: DataFrame, group: Sequence[str] = ("sample_name", "sample_set"), order: str = "ord") -> DataFrame:
    """The first row of a requested number keeps it; rows without one, or too late, take the smallest numbers nobody asked for."""
    g = list(group)
    first = F.row_number().over(Window.partitionBy(*g, "replicate").orderBy(order)) == 1
    rows = requests.withColumn("_keeps", F.col("replicate").isNotNull() & first)
    whole = Window.partitionBy(*g)
    free = F.array_sort(F.array_except(F.sequence(F.lit(1), F.count("*").over(whole).cast("int")), F.collect_set(F.col("replicate").cast("int")).over(whole)))
    needy = F.row_number().over(Window.partitionBy(*g, "_keeps").orderBy(order))
    return rows.withColumn("_free", free).withColumn("assigned", F.when(F.col("_keeps"), F.col("replicate").cast("int")).otherwise(F.get("_free", needy - 1))).drop("_keeps", "_free")


def validate_sample_ids(sheet: DataFrame, column: str = "sample_name") -> DataFrame:
    """Offenders: ids with other characters than letters, digits and '-'."""
    return sheet.where(~F.coalesce(F.col(column).rlike("^[0-9A-Za-z-]+$"), F.lit(False)))


def required_columns_check(sheet: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column: whether it has nulls."""
    flags = sheet.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(c) for c in columns])
    return flags.unpivot([], list(columns), "column_name", "has_nulls")


def duplicate_primer_pairs(sheet: DataFrame) -> DataFrame:
    """Rows whose (fw, rev) pair is used more than once, with the number of uses."""
    repeated = sheet.groupBy("fw", "rev").agg(F.count("*").alias("uses")).where("uses > 1")
    return sheet.join(repeated, ["fw", "rev"])


def split_by_probe_set(sheet: DataFrame) -> DataFrame:
    """One row per library and probe set; repeats tells whether the primer pair occurs again in the set."""
    rows = sheet.withColumn("probe_set", F.explode(F.split("probe_set", ",")))
    return rows.withColumn("repeats", F.count("*").over(Window.partitionBy("probe_set", "fw", "rev")) > 1)


def attach_index_sequences(sheet: DataFrame, primers: DataFrame, platform: str) -> DataFrame:
    """i7 of the reverse primer and i5 of the forward one; which strand is read depends on the instrument."""
    i5 = "index_sequence" if platform == "nextseq" else "sequence"
    rev = primers.select(F.col("primer").alias("rev"), F.col("index_sequence").alias("i7"))
    fw = primers.select(F.col("primer").alias("fw"), F.col(i5).alias("i5"))
    return sheet.join(rev, "rev", "left").join(fw, "fw", "left")


def instrument_sheet(sheet: DataFrame) -> DataFrame:
    """The nine columns that the instrument's sheet wants."""
    empty = F.lit("")
    return sheet.select(
        F.col("sample_id").alias("Sample_ID"), F.col("sample_id").alias("Sample_Name"), empty.alias("Sample_Plate"), empty.alias("Sample_Well"), F.concat(F.lit("N"), F.col("rev").cast("string")).alias("I7_Index_ID"), F.col("i7").alias("index"),
        F.concat(F.lit("S"), F.col("fw").cast("string")).alias("I5_Index_ID"), F.col("i5").alias("index2"), empty.alias("Sample_Project"),
    )


def select_samples(sheet: DataFrame, probe_sets: Sequence[str], sample_sets: Sequence[str], sequenced: DataFrame) -> DataFrame:
    """Libraries of the named probe and sample sets (in either case) that were sequenced."""
    upper = lambda xs: F.array(*[F.lit(x.strip().upper()) for x in xs])
    wanted = F.arrays_overlap(F.transform(F.split("probe_set", ","), lambda x: F.upper(F.trim(x))), upper(probe_sets)) & F.array_contains(upper(sample_sets), F.upper("sample_set"))
    return sheet.where(wanted).join(sequenced.select("sample_id").distinct(), "sample_id", "left_semi")


def select_samples_regex(sheet: DataFrame, probe_set: str, sample_set: str) -> DataFrame:
    """The older rule: patterns contained in the columns."""
    return sheet.where(F.concat("probe_set", F.lit(",")).contains(probe_set + ",") & F.col("sample_set").rlike(sample_set))


def collapse_run_meta(meta: DataFrame, order: str = "ord") -> DataFrame:
    """The first known value of each column per sample and library."""
    w = Window.partitionBy("sample_id", "library_prep").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    others = [c for c in meta.columns if c not in ("sample_id", "library_prep", order)]
    return meta.select("sample_id", "library_prep", *[F.first(c, ignorenulls=True).over(w).alias(c) for c in others]).distinct()


def merge_sample_sheets(*sheets: DataFrame) -> DataFrame:
    """All sheets without repeated lines; sheets must have the same columns."""
    for s in sheets[1:]:
        if s.columns != sheets[0].columns:
            raise ValueError(f"columns differ: {sheets[0].columns} and {s.columns}")
    return reduce(DataFrame.unionByName, sheets).dropDuplicates()


def select_panel_arms(arms: DataFrame, panel: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """The first row of each probe of the panel that has all columns."""
    rows = arms.join(panel.select("mip_family").distinct(), "mip_family", "left_semi").na.drop(subset=list(columns))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("mip_id").orderBy(order))).where("_n = 1").select(*columns)


def derive_mip_arms(probes: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Arms and barcode lengths of a probe with two runs of N; well_formed tells others."""
    part = lambda i: F.regexp_extract(sequence, "^([^N]*)(N+)([^N]*)(N+)([^N]*)$", i)
    return probes.withColumns({"well_formed": F.col(sequence).rlike("^[^N]*N+[^N]*N+[^N]*$"), "ligation_arm": reverse_complement(part(1)), "ligation_barcode_length": F.length(part(2)), "extension_barcode_length": F.length(part(4)), "extension_arm": part(5)})


def probe_info_table(copies: DataFrame, targets: DataFrame) -> DataFrame:
    """Each probe copy with the names of the targets that its capture spans."""
    spans = copies.select("mip", "copy", "chrom", F.col("capture_start").alias("start"), F.col("capture_end").alias("stop"))
    hits = overlap_join(spans, targets.select("name", "chrom", "start", "stop")).where("b_start >= start AND b_stop <= stop").select("mip", "copy", F.col("b_name").alias("name"))
    names = hits.groupBy("mip", "copy").agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("targets"))
    return copies.join(names, ["mip", "copy"], "left").na.fill("", ["targets"])


def filter_probe_catalogue(catalogue: DataFrame, selected: DataFrame) -> DataFrame:
    return catalogue.join(selected.select("mip").distinct(), "mip", "left_semi")


def probe_sets_long(wide: DataFrame, sets: Sequence[str]) -> DataFrame:
    """One row per probe set and probe of a table with a column for each set."""
    return wide.select(*[F.col(c).cast("string").alias(c) for c in sets]).unpivot([], list(sets), "probe_set", "mip").where("mip is not null")


def sheet_combinations(sheet: DataFrame, order: str = "ord") -> DataFrame:
    """The first library of each sample set and probe set."""
    return sheet.withColumn("_n", F.row_number().over(Window.partitionBy("sample_set", "probe_set").orderBy(order))).where("_n = 1").drop("_n")


def plate_layout(design: DataFrame, wells: int = 96) -> DataFrame:
    """Plate and well (A1 to H12) of each distinct probe, in the order of gene and probe number.

    Ranks are per gene, moved by the sizes of the genes before: no single task sees all probes.
    """
    rows = design.dropDuplicates(["sequence", "mip"])
    own = rows.withColumn("_r", F.row_number().over(Window.partitionBy("gene").orderBy("number", "mip", "sequence")) - 1)
    before = running_total(rows.groupBy("gene").agg(F.count("*").alias("n")), ["gene"], "n", "_before").drop("n")
    place = (F.col("_r") + F.col("_before")).cast("int")
    out = own.join(before, "gene").withColumn("_p", place)
    well = F.concat(F.substring(F.lit("ABCDEFGH"), F.floor(F.col("_p") % wells / 12).cast("int") + 1, F.lit(1)), (F.col("_p") % 12 + 1).cast("string"))
    return out.withColumns({"plate": F.floor(F.col("_p") / wells).cast("int"), "well": well, "order_sequence": F.regexp_replace("sequence", "^([^N]*)N+", "$1(N)")}).drop("_r", "_before", "_p")


def demux_read_summary(stats: DataFrame, sheet: DataFrame) -> DataFrame:
    """Raw and passing reads of each library and lane; the share of its lane."""
    sums = stats.groupBy("sample_number", "lane").agg(F.sum("reads_raw").alias("reads_raw"), F.sum("reads_pf").alias("reads_pf"))
    lane = F.sum("reads_pf").over(Window.partitionBy("lane"))
    return sheet.join(sums.withColumn("lane_share", F.try_divide(F.col("reads_pf").cast("double"), lane)), "sample_number")


def decode_undetermined(headers: DataFrame, primers: DataFrame, sheet: DataFrame, platform: str) -> DataFrame:
    """fw and rev primer numbers of index headers 'a+b', 999 if unknown; caught tells pairs that a library uses."""
    a, b = F.split("header", "\\+")[0], F.split("header", "\\+")[1]
    i7, i5 = (reverse_complement(a), reverse_complement(b)) if platform == "nextseq" else (a, b)
    names = lambda c, n: primers.select(F.col("sequence").alias(c), F.col("primer").alias(n))
    rows = headers.withColumns({"_i7": i7, "_i5": i5}).join(names("_i7", "rev"), "_i7", "left").join(names("_i5", "fw"), "_i5", "left").na.fill(999, ["rev", "fw"])
    used = sheet.select("fw", "rev").distinct().withColumn("caught", F.lit(True))
    return rows.join(used, ["fw", "rev"], "left").na.fill(False, ["caught"]).drop("_i7", "_i5")


def strip_percent(c: Column) -> Column:
    """123 of '123(45.6%)'."""
    return F.regexp_extract(c, "^(\\d+)", 1).try_cast("bigint")


def extraction_stats(table: DataFrame, fields: Sequence[str], total: str, group: str) -> DataFrame:
    """Sums of decorated counts per group, and each field's share of the total field."""
    sums = table.groupBy(group).agg(*[F.sum(strip_percent(F.col(c))).alias(c) for c in fields])
    return sums.withColumns({f"{c}_share": F.try_divide(F.col(c).cast("double"), F.col(total)) for c in fields if c != total})


def stitch_log_summary(logs: DataFrame) -> DataFrame:
    """Sample, all pairs and combined pairs of one JSON log line per sample."""
    schema = "sample string, stitched struct<total: bigint, combined: bigint>"
    return logs.select(F.from_json("line", schema).alias("j")).select("j.sample", F.col("j.stitched.total").alias("total"), F.col("j.stitched.combined").alias("combined"))


def good_samples(reports: DataFrame, expected: DataFrame) -> DataFrame:
    """Samples with good reads; none while an expected sample hasn't reported."""
    silent = expected.select("sample_id").distinct().join(reports, "sample_id", "left_anti").agg((F.count("*") == 0).alias("_all"))
    return reports.where("good_reads > 0").crossJoin(F.broadcast(silent)).where("_all").select("sample_id")  # one row on the right


def archive_file_table(files: DataFrame, constants: DataFrame, width: int = 1) -> DataFrame:
    """One row per library with all of its files in columns filename, filename2, ..., and the constant columns.

    There are as many columns as the library with most files needs, and width at least.
    """
    most = files.groupBy("library_id").agg(F.count("file").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    width = max(width, most)
    listed = files.groupBy("library_id").agg(F.sort_array(F.collect_list("file")).alias("_f"))
    names = ["filename", *[f"filename{i}" for i in range(2, width + 1)]]
    return listed.select("library_id", *[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names)]).crossJoin(F.broadcast(constants))  # one constant row


def biosample_table(meta: DataFrame, accessions: DataFrame, place: str = "not collected") -> DataFrame:
    """Submission columns of samples that aren't controls, with their accession."""
    rows = meta.where(~F.coalesce("control", F.lit(False)))
    return rows.select("sample_id", F.lit("Plasmodium").alias("organism"), F.coalesce("site", F.lit(place)).alias("geo_loc_name"), F.col("year").alias("collection_date"), F.lit("blood").alias("isolation_source")).join(accessions, "sample_id", "left")
