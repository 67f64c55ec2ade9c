"""Haplotype and UMI operators. Columns: sample_id, gene, mip, copy, haplotype_id, haplotype_sequence, umi_count, read_count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..quantiles import with_quantiles
from ..scratch import materialize


def filter_to_panel_and_sheet(calls: DataFrame, arms: DataFrame, sheet: DataFrame) -> DataFrame:
    """Calls of probes in arms (mip) and samples in sheet (sample_id, new_id, library)."""
    return calls.join(arms.select("mip").distinct(), "mip", "left_semi").join(sheet.select("sample_id", "new_id", "library"), "sample_id").drop("sample_id").withColumnRenamed("new_id", "sample_id")


def combine_runs(calls: DataFrame) -> DataFrame:
    """One row per sample, sequence and library: counts add up, quality is that of the row with most UMIs."""
    best = F.max(F.struct("umi_count", "sequence_quality"))["sequence_quality"]
    first = F.min(F.struct("ord", "mip", "gene"))
    return calls.groupBy("sample_id", "haplotype_sequence", "library_prep").agg(
        F.sum("umi_count").alias("umi_count"), F.sum("read_count").alias("read_count"), best.alias("sequence_quality"), first["mip"].alias("mip"), first["gene"].alias("gene")
    )


def merge_replicates(calls: DataFrame, merged: str = "merged") -> DataFrame:
    """Replicates of a sample become replicate 1 of one library."""
    return combine_runs(calls.withColumns({"sample_id": F.regexp_replace("sample_id", "-[^-]*$", "-1"), "library_prep": F.lit(merged)}))


def assign_haplotype_ids(calls: DataFrame) -> DataFrame:
    """haplotype_id is mip.rank; a probe's sequences rank by their number of rows, ties by sequence."""
    counts = calls.groupBy("mip", "haplotype_sequence").agg(F.count("*").alias("n"))
    order = Window.partitionBy("mip").orderBy(F.desc("n"), "haplotype_sequence")
    ids = counts.select("mip", "haplotype_sequence", F.concat_ws(".", "mip", F.row_number().over(order) - 1).alias("haplotype_id"))
    return calls.drop("haplotype_id").join(ids, ["mip", "haplotype_sequence"])


def unique_haplotypes(calls: DataFrame) -> DataFrame:
    return calls.groupBy("gene", "mip", "haplotype_id").agg(F.min("haplotype_sequence").alias("haplotype_sequence"))


def haplotype_support(calls: DataFrame, min_umis: int = 0, min_samples: int = 0, min_fraction: float = 0.0) -> DataFrame:
    """UMIs, samples and share of all samples of each haplotype that reaches all three minima."""
    total = calls.agg(F.countDistinct("sample_id").alias("total"))
    stats = calls.groupBy("haplotype_id").agg(F.sum("umi_count").alias("umis"), F.countDistinct("sample_id").alias("samples"))
    rows = stats.crossJoin(F.broadcast(total)).withColumn("sample_fraction", F.col("samples") / F.col("total")).drop("total")  # one row on the right
    return rows.where((F.col("umis") >= min_umis) & (F.col("samples") >= min_samples) & (F.col("sample_fraction") >= min_fraction))


def best_alignment_flag(alignments: DataFrame) -> DataFrame:
    """best_alignment: the score is the haplotype's greatest; ties are all best."""
    return alignments.withColumn("best_alignment", F.col("alignment_score") == F.max("alignment_score").over(Window.partitionBy("haplotype_id")))


def classify_on_target(alignments: DataFrame, copies: DataFrame, tolerance: int = 200) -> DataFrame:
    """Each alignment against each copy of its probe: aligned_copy, mapped_copy, and off_target of the haplotype."""
    known = copies.select("mip", "copy", F.col("chrom").alias("copy_chrom"), "capture_start")
    rows = best_alignment_flag(alignments).join(known, "mip")
    rows = rows.withColumn("aligned_copy", (F.col("chrom") == F.col("copy_chrom")) & (F.abs(F.col("pos") - F.col("capture_start")) <= tolerance))
    rows = rows.withColumn("mapped_copy", F.col("aligned_copy") & F.col("best_alignment"))
    return rows.withColumn("off_target", ~F.max("mapped_copy").over(Window.partitionBy("haplotype_id")))


def best_copy_alignment(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("mip", "copy", "haplotype_id").orderBy(F.desc("alignment_score"), "chrom", "pos")
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def mapped_copy_number(rows: DataFrame) -> DataFrame:
    """Number of copies that a haplotype maps to, on the rows of those copies."""
    return rows.where("mapped_copy").withColumn("mapped_copy_number", F.count("*").over(Window.partitionBy("haplotype_id")))


def offtarget_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mip").agg(F.countDistinct("haplotype_id").alias("haplotypes"), F.countDistinct(F.when(F.col("off_target"), F.col("haplotype_id"))).alias("off_target"))


def dense_grid(samples: DataFrame, probes: DataFrame) -> DataFrame:
    """Every sample with every probe copy: both are dimension tables, never facts."""
    return samples.distinct().crossJoin(probes.distinct())


def dense_umi_table(counts: DataFrame, samples: DataFrame, probes: DataFrame, keys: Sequence[str] = ("mip", "copy"), value: str = "umi_count") -> DataFrame:
    """UMIs per sample and probe copy, 0 where nothing was seen; silent samples and probes are present."""
    sums = counts.groupBy("sample_id", *keys).agg(F.sum(value).alias("umi"))
    return dense_grid(samples.select("sample_id"), probes.select(*keys)).join(sums, ["sample_id", *keys], "left").withColumn("umi", F.coalesce("umi", F.lit(0)).cast("long"))


def unique_umi_matrix(mapped: DataFrame, samples: DataFrame, probes: DataFrame) -> DataFrame:
    """The dense table over haplotypes that map to one copy only."""
    return dense_umi_table(mapped.where("mapped_copy_number = 1"), samples, probes, ("gene", "mip", "copy"))


def estimate_copy_counts(matrix: DataFrame, average: float = 2.0, quantiles: tuple[float, float] = (0.4, 0.6), keys: Sequence[str] = ("mip", "copy"), value: str = "umi") -> DataFrame:
    """copy_count = average * share of the sample / mean of two quantiles of the probe's shares, zeros included."""
    share = F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy("sample_id")))
    rows = with_quantiles(materialize(matrix.withColumn("share", share), "shares"), keys, "share", quantiles, "_q")
    level = (F.col("_q")[0] + F.col("_q")[1]) / 2
    return rows.withColumn("copy_count", F.try_divide(average * F.col("share"), level)).select(*matrix.columns, "share", "copy_count")


def copy_share(estimates: DataFrame) -> DataFrame:
    """Share of each copy in a sample's estimate for the gene."""
    sums = estimates.groupBy("sample_id", "gene", "copy").agg(F.sum("copy_count").alias("copies"))
    return sums.withColumn("copy_share", F.try_divide(F.col("copies"), F.sum("copies").over(Window.partitionBy("sample_id", "gene"))))


def redistribute_multimapped(mapped: DataFrame, shares: DataFrame) -> DataFrame:
    """UMIs and reads of a haplotype that maps to several copies are split by the copies' shares in the sample.

    No known share, or only zeros: equal parts. An unknown share beside known ones counts as zero.
    """
    rows = mapped.where("mapped_copy_number > 1").join(shares.select("sample_id", "gene", "copy", "copy_share"), ["sample_id", "gene", "copy"], "left")
    group = Window.partitionBy("sample_id", "haplotype_id")
    whole = F.coalesce(F.sum("copy_share").over(group), F.lit(0.0))
    part = F.when(whole > 0, F.coalesce("copy_share", F.lit(0.0)) / F.nullif(whole, F.lit(0.0))).otherwise(1.0 / F.count("*").over(group))
    return rows.withColumn("part", part).withColumns({"umi_count": F.col("umi_count") * F.col("part"), "read_count": F.col("read_count") * F.col("part")}).drop("copy_share", "part")


def normalize_copy_rows(table: DataFrame, value: str = "copy_share", group: Sequence[str] = ("sample_id", "gene")) -> DataFrame:
    """Groups without any value get equal shares; elsewhere a missing value is 0."""
    w = Window.partitionBy(*group)
    return table.withColumn(value, F.when(F.count(value).over(w) == 0, 1.0 / F.count("*").over(w)).otherwise(F.coalesce(value, F.lit(0.0))))


def on_target_totals(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """UMIs and reads before and after, one row."""
    total = lambda df, name: df.agg(F.sum("umi_count").alias(f"{name}_umis"), F.sum("read_count").alias(f"{name}_reads"))
    return total(raw, "raw").crossJoin(F.broadcast(total(kept, "kept")))  # one row each


def sample_summary(calls: DataFrame, samples: DataFrame, levels: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """Reads, UMIs and probes with at least k UMIs; samples without calls have zeros."""
    probes = calls.groupBy("sample_id", "mip").agg(F.sum("umi_count").alias("umis"), F.sum("read_count").alias("reads"))
    reached = [F.count(F.when(F.col("umis") >= k, 1)).alias(f"targets_{k}") for k in levels]
    stats = probes.groupBy("sample_id").agg(F.sum("reads").alias("read_count"), F.sum("umis").alias("umi_count"), *reached)
    return samples.select("sample_id").distinct().join(stats, "sample_id", "left").na.fill(0)


def umi_presence(table: DataFrame, minimum: int, value: str = "umi") -> DataFrame:
    return table.withColumn("present", F.when(F.col(value) >= minimum, 1).otherwise(0))


def umi_log_matrix(table: DataFrame, base: str = "log2", constant: float = 1.0, value: str = "umi") -> DataFrame:
    """log2, log10 or ln of count + constant."""
    take = {"log2": F.log2, "log10": F.log10, "ln": F.ln}[base]
    return table.withColumn("level", take(F.col(value) + constant))


def repool_decision(
    summary: DataFrame,
    high_umis: float,
    *,
    covered: str = "targets_10",
    seen: str = "targets_1",
    goal: float | None = None,
    goal_fraction: float = 0.95,
    saturation: float = 10,
    least_umis: float = 100,
    low_action: str = "Repool",
    quantile: float = 0.25,
) -> DataFrame:
    """What to do with each sample: Complete, Recapture, Repool or low_action; how much more of it; uneven coverage."""
    needed = F.lit(float(goal)) if goal is not None else F.col("_most") * goal_fraction
    most = summary.agg(F.max(covered).alias("_most"))
    rows = summary.crossJoin(F.broadcast(most)).withColumn("_goal", needed)  # one row on the right
    depth = F.coalesce(F.try_divide(F.col("read_count").cast("double"), F.col("umi_count")), F.lit(0.0))
    status = (
        F.when(F.col(covered) >= F.col("_goal"), "Complete")
        .when(F.col("umi_count") < least_umis, low_action)
        .when(F.col("umi_coverage") >= saturation, "Recapture")
        .when(F.col("umi_coverage") == 0, low_action)
        .otherwise("Repool")
    )
    rows = rows.withColumn("umi_coverage", depth).withColumn("status", status)
    rows = rows.withColumn("_more", F.try_divide(high_umis - F.col("umi_count"), F.col("umi_count").cast("double")))
    rows = rows.withColumn("umis_per_target", F.when(F.col(covered) > 0, F.col("umi_count") / F.col(covered)))
    level = rows.agg(F.max("_more").alias("_cap"), F.expr(f"percentile(CASE WHEN status = 'Complete' THEN umis_per_target END, {quantile})").alias("_level"))
    rows = rows.crossJoin(F.broadcast(level))  # one row on the right
    uneven = F.coalesce((F.col("umis_per_target") > F.col("_level")) & (F.col(seen) < F.col("_goal")), F.lit(False))
    return rows.withColumns({"library_to_completion": F.coalesce("_more", "_cap"), "uneven_coverage": uneven}).drop("_most", "_goal", "_more", "_cap", "_level")


def downsample_umis(reads: DataFrame, n: int, group: Sequence[str], key: Column, weight: Column | None = None, seed: int = 0, part_rows: int = 1_000_000) -> DataFrame:
    """n records of each group without replacement, the same ones for the same seed.

    Uniform, or with probability proportional to weight: the records with the least -ln(u) / weight are a sequential
    weighted draw. u is made of the first 52 bits of the MD5 of seed and key, so it is the same everywhere. A group of
    more than part_rows records is dealt to parts; the n least of each part meet, so no task sorts a whole group.
    """
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 13), 16, 10).cast("long")
    u = (bits + 1) / F.lit(float((1 << 52) + 1))
    order = u if weight is None else -F.ln(u) / weight
    first = lambda df, *by: df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_order", "_key"))).where(F.col("_n") <= n).drop("_n")
    rows = reads.withColumns({"_order": order, "_key": key})
    sizes = materialize(reads.groupBy(*group).agg(F.count("*").alias("_size")).where(F.col("_size") > part_rows), "large-groups")  # of T records at most T / part_rows groups
    if not sizes.isEmpty():
        parts = F.coalesce(F.ceil(F.col("_size") / part_rows), F.lit(1))
        dealt = rows.join(F.broadcast(sizes), list(group), "left").withColumn("_part", F.pmod(F.xxhash64("_key"), parts))
        rows = first(dealt, *group, "_part").drop("_size", "_part")
    return first(rows, *group).select(*reads.columns)


def expand_umi_reads(calls: DataFrame) -> DataFrame:
    """One read for each UMI, named @sample_haplotype_i."""
    rows = calls.where("umi_count >= 1").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("umi_count") - 1)))
    return rows.withColumn("read_name", F.concat(F.lit("@"), F.concat_ws("_", "sample_id", "haplotype_id", "i")))


def umi_read_names(calls: DataFrame) -> DataFrame:
    """Of the reads of expand_umi_reads, for each sample and haplotype: reads, different names, and the last name.

    The names of a call's reads are made and looked at within its row, so reads are neither sorted nor shuffled. Every call
    counts its reads from 0: of a sample and haplotype, the call with most names has all of them.
    """
    named = F.transform(F.sequence(F.lit(0).cast("long"), F.col("umi_count") - 1), lambda i: F.concat(F.lit("@"), F.concat_ws("_", F.col("sample_id"), F.col("haplotype_id"), i.cast("string"))))
    names = calls.where("umi_count >= 1").select("sample_id", "haplotype_id", named.alias("_names"))
    rows = names.select("sample_id", "haplotype_id", F.size("_names").cast("long").alias("reads"), F.size(F.array_distinct("_names")).cast("long").alias("names"), F.array_max("_names").alias("last_name"))
    return rows.groupBy("sample_id", "haplotype_id").agg(F.sum("reads").alias("reads"), F.max("names").alias("names"), F.max("last_name").alias("last_name"))


def padded_reads(haplotypes: DataFrame, contigs: DataFrame, pad: int, min_count: int = 1) -> DataFrame:
    """Haplotypes with the reference on both sides of the capture; flanks have quality '!'.

    contigs: chrom and sequence pieces as (chrom, chunk, chunk_size, seq); a flank takes part of at most a few chunks.
    """
    size = F.col("chunk_size")
    rows = haplotypes.withColumn("count", F.floor(F.col("umi_count") / F.col("mapped_copy_number")).cast("long")).where(F.col("count") >= min_count)
    ends = rows.select("haplotype_id", "chrom", F.explode(F.array(F.struct(F.lit("left").alias("side"), F.greatest(F.lit(1), F.col("capture_start") - pad).alias("lo"), (F.col("capture_start") - 1).alias("hi")), F.struct(F.lit("right").alias("side"), (F.col("capture_end") + 1).alias("lo"), (F.col("capture_end") + pad).alias("hi")))).alias("e")).select("haplotype_id", "chrom", "e.*")
    one = contigs.select("chunk_size").limit(1)
    spread = ends.crossJoin(F.broadcast(one)).withColumn("chunk", F.explode(F.sequence(F.floor((F.col("lo") - 1) / size), F.floor((F.col("hi") - 1) / size)))).drop("chunk_size")
    parts = spread.join(contigs, ["chrom", "chunk"]).withColumn("at", F.greatest(F.col("lo") - F.col("chunk") * size, F.lit(1)))
    text = F.substring("seq", F.col("at").cast("int"), (F.least(F.col("hi") - F.col("chunk") * size, size) - F.col("at") + 1).cast("int"))
    joined = parts.groupBy("haplotype_id", "chrom", "side").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", text.alias("t")))), lambda x: x["t"]), "").alias("flank"))
    wide = joined.groupBy("haplotype_id", "chrom").agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col("flank"))), F.lit("")).alias(s) for s in ("left", "right")])
    forward = F.when(F.col("orientation") == "reverse", F.reverse(F.translate("haplotype_sequence", "ACGTacgt", "TGCAtgca"))).otherwise(F.col("haplotype_sequence"))
    quality = F.when(F.col("orientation") == "reverse", F.reverse("sequence_quality")).otherwise(F.col("sequence_quality"))
    out = rows.join(wide, ["haplotype_id", "chrom"], "left").na.fill("", ["left", "right"])
    return out.withColumns({"seq": F.concat("left", forward, "right"), "qual": F.concat(F.repeat(F.lit("!"), F.length("left")), quality, F.repeat(F.lit("!"), F.length("right")))}).drop("left", "right")


def raw_reads(calls: DataFrame, min_count: int = 1, min_fraction: float = 0.0) -> DataFrame:
    """Reads of haplotypes with enough UMIs and a large enough share of their sample's probe."""
    share = F.col("umi_count") / F.sum("umi_count").over(Window.partitionBy("sample_id", "mip"))
    kept = calls.withColumn("fraction", share).where((F.col("umi_count") >= min_count) & (F.col("fraction") >= min_fraction))
    return expand_umi_reads(kept)


def haplotype_fraction_filter(calls: DataFrame, min_count: int, min_fraction: float, keys: Sequence[str] = ("sample_id", "gene", "mip", "copy")) -> DataFrame:
    """Merge a haplotype's rows in a cell, keep it by count and by its share of the cell, and list the cell's haplotypes."""
    merged = calls.groupBy(*keys, "haplotype_id").agg(F.sum("umi_count").alias("umi_count"))
    kept = merged.withColumn("total", F.sum("umi_count").over(Window.partitionBy(*keys))).where((F.col("umi_count") >= min_count) & (F.col("umi_count") >= min_fraction * F.col("total")))
    return kept.groupBy(*keys).agg(F.sum("umi_count").alias("umi_count"), F.max("total").alias("total"), F.array_join(F.sort_array(F.collect_list("haplotype_id")), ",").alias("haplotypes"))


def sample_normalizer(calls: DataFrame, stable: Column) -> DataFrame:
    """UMIs per stable probe and the factor that brings it to 100; samples without stable UMIs have a null factor."""
    stats = calls.groupBy("sample_id").agg(
        F.sum("umi_count").alias("umis"), F.countDistinct("mip").alias("mips"), F.sum(F.when(stable, F.col("umi_count"))).alias("stable_umis"), F.countDistinct(F.when(stable, F.col("mip"))).alias("stable_mips")
    )
    mean = F.try_divide(F.col("stable_umis").cast("double"), F.col("stable_mips"))
    return stats.withColumn("mean_umis", mean).withColumn("normalizer", F.round(F.try_divide(F.lit(100.0), F.col("mean_umis")), 2))


def normalize_calls(calls: DataFrame, normalizers: DataFrame) -> DataFrame:
    return calls.join(normalizers.where("normalizer is not null").select("sample_id", "normalizer"), "sample_id").withColumn("normalized", F.col("umi_count") * F.col("normalizer"))


def not_normalized(calls: DataFrame, normalizers: DataFrame) -> DataFrame:
    """Samples of calls without a factor."""
    return calls.select("sample_id").distinct().join(normalizers.where("normalizer is not null"), "sample_id", "left_anti")


def probe_table(normalized: DataFrame, copies: DataFrame) -> DataFrame:
    """Normalised counts per probe copy and sample with the copy's place and length."""
    sums = normalized.groupBy("mip", "sample_id").agg(F.sum("normalized").alias("normalized"))
    return copies.withColumn("size", F.col("capture_end") - F.col("capture_start") + 1).join(sums, "mip")


def median_filters(table: DataFrame, min_probe: float, min_sample: float, value: str = "umi") -> DataFrame:
    """Drop probes, then samples, with too small a median; normalized = 2 * value / the probe's median."""
    rows = with_quantiles(materialize(table, "probes"), ["mip", "copy"], value, [0.5], "_q").withColumn("probe_median", F.col("_q")[0]).where(F.col("probe_median") >= min_probe)
    median = F.percentile(value, 0.5).over(Window.partitionBy("sample_id"))  # of as many values as there are probes
    rows = rows.withColumn("_m", median).where(F.col("_m") >= min_sample)
    return rows.withColumn("normalized", F.try_divide(2.0 * F.col(value), F.col("probe_median"))).select(*table.columns, "probe_median", "normalized")


def record_filter(table: DataFrame, field: str, compare: str, value) -> DataFrame:
    """Rows whose field is gt, gte, lt, lte the value, or in or nin the values."""
    c = F.col(field)
    tests = {"gt": lambda: c > value, "gte": lambda: c >= value, "lt": lambda: c < value, "lte": lambda: c <= value, "in": lambda: c.isin(list(value)), "nin": lambda: ~c.isin(list(value))}
    return table.where(tests[compare]())


def classify_probe_uniqueness(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """unique, non-unique (shares a copy with another copy set) or unseen for each probe copy set of a haplotype."""
    sets = rows.where("mapped_copy").groupBy("mip", "haplotype_id").agg(F.array_join(F.sort_array(F.collect_set("copy")), ",").alias("copies")).select("mip", "copies").distinct()
    single = sets.withColumn("copy", F.explode(F.split("copies", ",")))
    shared = single.groupBy("mip", "copy").agg(F.count("*").alias("n"))
    seen = single.join(shared, ["mip", "copy"]).groupBy("mip", "copies").agg(F.when(F.max("n") > 1, "non-unique").otherwise("unique").alias("kind"))
    unseen = copies.select("mip", F.col("copy").alias("copies")).distinct().join(single.select("mip", F.col("copy").alias("copies")), ["mip", "copies"], "left_anti").withColumn("kind", F.lit("unseen"))
    return seen.unionByName(unseen)


def incremental_calls(old: DataFrame, new: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New rows with known sequences appended to old ones under the known ids; and the rows with unknown sequences."""
    ids = known.select("haplotype_sequence", "haplotype_id").distinct()
    placed = new.drop("haplotype_id").join(ids, "haplotype_sequence")
    return old.unionByName(placed, allowMissingColumns=True), new.join(ids, "haplotype_sequence", "left_anti")


def call_microsats(calls: DataFrame, cutoff: float, adjustments: DataFrame) -> DataFrame:
    """Lengths of repeats per sample and region: adjusted length, UMIs, share. Lengths under the cutoff of a cell's total go."""
    rows = calls.join(adjustments, "mip").withColumn("repeat_length", F.length("haplotype_sequence") - F.col("adjustment"))
    cell = rows.groupBy("sample_id", "region", "mip", "repeat_length").agg(F.sum("umi_count").alias("umis"))
    kept = cell.withColumn("total", F.sum("umis").over(Window.partitionBy("sample_id", "region", "mip"))).where(F.col("umis") >= cutoff * F.col("total"))
    sums = kept.groupBy("sample_id", "region", "repeat_length").agg(F.sum("umis").alias("umis"))
    return sums.withColumn("frequency", F.col("umis") / F.sum("umis").over(Window.partitionBy("sample_id", "region")))


def concat_target_tables(tables: Sequence[DataFrame], *order: str) -> DataFrame:
    """Tables of single targets under one header, sorted."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.orderBy(*order)
