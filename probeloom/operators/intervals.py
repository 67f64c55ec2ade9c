"""Intervals on chromosomes: 1-based, both ends included. Columns chrom, start, stop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import codon_map, reverse_complement
from ..scratch import materialize
from .components import components


def _merge_within(df: DataFrame, keys: Sequence[str], spacer: int, order: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("start", "stop", *order)
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.withColumn("_new", F.when(reach.isNull() | (F.col("start") - reach > spacer), 1).otherwise(0))
    return flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _carried(bins: DataFrame, keys: Sequence[str], spacer: int) -> DataFrame:
    """Of each bin (_reach, and _last, the start of its last piece): how far the bins before it reach, _carry, and where the island begins that is open there, _open."""
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.withColumn("_carry", F.max("_reach").over(before))
    fresh = F.col("_carry").isNull() | (F.col("_last") - F.col("_carry") > spacer)  # the last piece of a bin joins nothing earlier
    return carried.withColumn("_open", F.last(F.when(fresh, F.col("_last")), ignorenulls=True).over(before)).drop("_reach", "_last")


def merge_intervals(df: DataFrame, spacer: int = 0, *, keys: Sequence[str] = ("chrom",), bin_size: int = 1_000_000) -> DataFrame:
    """Intervals joined while the gap to what came before is at most spacer; n counts the rows in each.

    First inside bins of the genome, into pieces. Then one row for each bin, how far it reaches and where its last piece
    starts, is carried along the chromosome: that tells each piece whether it joins an earlier island, and which. So
    neither a chromosome's rows nor its pieces meet in one task.
    """
    keys = list(keys)
    binned = df.select(*keys, "start", "stop", F.floor(F.col("start") / bin_size).alias("_bin"))
    inside = _merge_within(binned, [*keys, "_bin"], spacer).groupBy(*keys, "_bin", "_island")
    pieces = materialize(inside.agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n")).drop("_island"), "pieces")
    carried = _carried(pieces.groupBy(*keys, "_bin").agg(F.max("stop").alias("_reach"), F.max("start").alias("_last")), keys, spacer)
    own = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*keys, "_bin")]
    placed = pieces.alias("p").join(carried.alias("c"), own).select("p.*", "_carry", "_open")
    island = F.when(F.col("_carry").isNull() | (F.col("start") - F.col("_carry") > spacer), F.col("start")).otherwise(F.col("_open"))
    return placed.groupBy(*keys, island.alias("_island")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n")).select(*keys, "start", "stop", "n")


def _leveled(lo: Column, hi: Column, bin_size: int) -> Column:
    """The least level whose bins, bin_size * 8 ** level wide, are at least as long as the interval."""
    length = F.greatest(hi - lo + 1, F.lit(1))
    return F.greatest(F.ceil(F.log(8.0, length / float(bin_size)) - 1e-9), F.lit(0)).cast("int")


#: A side of so many dealt rows at most is broadcast. Spark can't tell: it takes rows before they are dealt to bins.
BROADCAST_ROWS = 20_000


def overlap_join(a: DataFrame, b: DataFrame, padding: int = 0, bin_size: int = 256, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Pairs of overlapping intervals; b's columns other than the keys get the prefix b_.

    Intervals are dealt to bins of the width of their own length class, so each lies in two or three; bin_size is the
    least width, and classes go up by eight. A pair meets at the level of the longer of the two: each side's intervals
    stand in their own bins, and once more at the levels of longer ones of the other side, and a pair counts in the bin
    where the later one starts. A chromosome-long interval is in a few bins of its own, and short ones don't meet in the
    wide bins. Bins that are dense all the same, since their intervals do overlap, are split by Spark's skew handling.
    The same small job counts the rows, so that only a side that is small once dealt is broadcast.
    """
    keys = list(on)
    left = a.withColumn("_level", _leveled(F.col("start"), F.col("stop"), bin_size))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in keys])
    right = right.withColumns({"_lo": F.col("b_start") - padding, "_hi": F.col("b_stop") + padding}).withColumn("_b_level", _leveled(F.col("_lo"), F.col("_hi"), bin_size))
    sides = left.select(F.lit("a").alias("side"), F.col("_level").alias("level")).unionByName(right.select(F.lit("b").alias("side"), F.col("_b_level").alias("level")))
    used = sides.where("level IS NOT NULL").groupBy("side", "level").agg(F.count("*").alias("n")).collect()  # a dozen of length classes
    of_a, of_b = (sorted(r["level"] for r in used if r["side"] == side) for side in "ab")
    most_a, most_b = (sum(3 * r["n"] * (1 + sum(x >= r["level"] for x in others)) for r in used if r["side"] == side) for side, others in (("a", of_b), ("b", of_a)))

    def dealt(df: DataFrame, own: str, lo: Column, hi: Column, others: list[int], may_equal: bool) -> DataFrame:
        """_at: level, bin and which side's own level it is."""
        higher = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: (x >= F.col(own)) if may_equal else (x > F.col(own)))
        places = F.concat(F.array(F.struct(F.col(own).alias("level"), F.lit(may_equal).alias("of_b"))), F.transform(higher, lambda x: F.struct(x.alias("level"), F.lit(not may_equal).alias("of_b"))))
        width = F.lit(bin_size) * F.pow(F.lit(8.0), F.col("_place.level")).cast("long")
        out = df.withColumn("_place", F.explode(places)).withColumn("_bin", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))
        return out.withColumns({"_at": F.col("_place.level"), "_of_b": F.col("_place.of_b"), "_width": width}).drop("_place", own)

    x = dealt(left, "_level", F.col("start"), F.col("stop"), of_b, False)
    y = dealt(right, "_b_level", F.col("_lo"), F.col("_hi"), of_a, True).drop("_width")
    meets = (F.col("start") <= F.col("_hi")) & (F.col("_lo") <= F.col("stop")) & (F.col("_bin") == F.floor(F.greatest("start", "_lo") / F.col("_width")))
    if min(most_a, most_b) > BROADCAST_ROWS:
        x, y = x.hint("merge"), y.hint("merge")
    elif most_a <= most_b:
        x = F.broadcast(x)
    else:
        y = F.broadcast(y)
    return x.join(y, [*keys, "_at", "_of_b", "_bin"]).where(meets).drop("_bin", "_lo", "_hi", "_at", "_of_b", "_width")


def intersect_intervals(a: DataFrame, b: DataFrame, **options) -> DataFrame:
    """Pairs with the bounds of what they share."""
    return overlap_join(a, b, **options).withColumns({"common_start": F.greatest("start", "b_start"), "common_stop": F.least("stop", "b_stop")})


def remove_overlap(pairs: DataFrame) -> DataFrame:
    """For overlapping pairs, the parts that only one of the two covers."""
    lo, hi = F.greatest("start", "b_start"), F.least("stop", "b_stop")
    parts = F.array(F.struct(F.least("start", "b_start").alias("start"), (lo - 1).alias("stop")), F.struct((hi + 1).alias("start"), F.greatest("stop", "b_stop").alias("stop")))
    return pairs.withColumn("_part", F.explode(parts)).where("_part.start <= _part.stop").withColumns({"part_start": F.col("_part.start"), "part_stop": F.col("_part.stop")}).drop("_part")


def contains() -> Column:
    """Whether one of a pair contains the other."""
    return ((F.col("start") <= F.col("b_start")) & (F.col("stop") >= F.col("b_stop"))) | ((F.col("b_start") <= F.col("start")) & (F.col("b_stop") >= F.col("stop")))


def redundant(spacer: int) -> Column:
    """Whether one contains the other, or what they don't share is at most spacer long."""
    extra = F.abs(F.col("start") - F.col("b_start")) + F.abs(F.col("stop") - F.col("b_stop"))
    return contains() | (extra <= spacer)


def subtract_intervals(uncovered: DataFrame, covered: DataFrame, spacer: int = 0, bin_size: int = 10_000) -> DataFrame:
    """What of the first is not in the second; a piece stays if stop - start exceeds spacer, so single bases go at 0."""
    left = merge_intervals(uncovered, 1).drop("n").withColumnsRenamed({"start": "whole_start", "stop": "whole_stop"})
    base = left.select("chrom", F.col("whole_start").alias("start"), F.col("whole_stop").alias("stop"))
    cuts = overlap_join(base, merge_intervals(covered, 1).drop("n"), bin_size=bin_size).select("chrom", F.col("start").alias("whole_start"), F.col("stop").alias("whole_stop"), F.col("b_start").alias("cut"), F.col("b_stop").alias("resume"))
    # an empty cut before each interval opens its first piece
    opened = left.select("chrom", "whole_start", "whole_stop", (F.col("whole_start") - 1).alias("cut"), (F.col("whole_start") - 1).alias("resume")).unionByName(cuts)
    w = Window.partitionBy("chrom", "whole_start").orderBy("cut", "resume")
    pieces = opened.select("chrom", (F.col("resume") + 1).alias("start"), (F.coalesce(F.lead("cut").over(w), F.col("whole_stop") + 1) - 1).alias("stop"))
    return pieces.where(F.col("stop") - F.col("start") > spacer)


def islands(df: DataFrame, spacer: int = 0, *, bin_size: int = 1_000_000) -> DataFrame:
    """df with island, the start of the merged interval that each row belongs to. Rows without a place are left out.

    As in merge_intervals(): pieces inside bins, then one row for each bin tells which pieces join an earlier island.
    """
    rows = df.where("chrom IS NOT NULL AND start <= stop").withColumn("_bin", F.floor(F.col("start") / bin_size))
    w = Window.partitionBy("chrom", "_bin").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    pieces = _merge_within(rows, ["chrom", "_bin"], spacer).withColumn("_piece", F.max(F.when(F.col("_new") == 1, F.col("start"))).over(w))
    pieces = materialize(pieces.drop("_new", "_island"), "pieces")
    carried = _carried(pieces.groupBy("chrom", "_bin").agg(F.max("stop").alias("_reach"), F.max("_piece").alias("_last")), ["chrom"], spacer)
    own = F.col("_carry").isNull() | (F.col("_piece") - F.col("_carry") > spacer)
    placed = pieces.join(carried, ["chrom", "_bin"]).withColumn("island", F.when(own, F.col("_piece")).otherwise(F.col("_open")))
    return placed.select(*df.columns, "island")


def _share(low: float, high: float) -> Column:
    """What becomes of an overlapping pair by (shared stop - start) / smaller length: 'cut', 'shared', or null in between."""
    shared = F.least("stop", "b_stop") - F.greatest("start", "b_start")
    smaller = F.least(F.col("stop") - F.col("start"), F.col("b_stop") - F.col("b_start")) + 1
    ratio = shared / smaller
    return F.when(ratio <= low, "cut").when(ratio >= high, "shared")


def _trim_neighbours(df: DataFrame, low: float, high: float, bin_size: int) -> DataFrame:
    """Rounds of changes between neighbours of a bin (of start) in order of start and stop, until there are none.

    A pair changes if its hash is less than that of the changing pairs on both sides. A round costs one sorted pass,
    however deep intervals are piled. No change reaches beyond an island, so islands without one leave the rounds.
    """
    w = Window.partitionBy("chrom", "_bin").orderBy("start", "stop")
    none = F.expr("cast(array() AS array<struct<start: bigint, stop: bigint>>)")
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("stop"))
    open_, done = islands(df), []
    while True:
        rows = open_.withColumn("_bin", F.floor(F.col("start") / bin_size)).withColumns({"b_start": F.lead("start").over(w), "b_stop": F.lead("stop").over(w)})
        rows = rows.withColumn("_change", F.when(F.col("b_start") <= F.col("stop"), _share(low, high)))
        rows = rows.withColumn("_rank", F.when(F.col("_change").isNotNull(), F.md5(F.concat_ws(":", "chrom", "start", "stop", "b_start", "b_stop"))))
        before, after = F.lag("_rank").over(w), F.lead("_rank").over(w)
        now = F.col("_rank").isNotNull() & F.coalesce(F.col("_rank") < before, F.lit(True)) & F.coalesce(F.col("_rank") < after, F.lit(True))
        rows = rows.withColumn("_now", now)
        rows = materialize(rows.withColumn("_gone", F.col("_now") | F.coalesce(F.lag("_now").over(w), F.lit(False))).drop("_rank"), "neighbours")
        moving = rows.where("_now").select("chrom", "island").distinct()
        done.append(rows.join(moving, ["chrom", "island"], "left_anti").select("chrom", "start", "stop"))
        if moving.isEmpty():
            return reduce(DataFrame.unionByName, done)
        lo, hi = F.greatest("start", "b_start"), F.least("stop", "b_stop")
        kept = F.when(F.col("_change") == "shared", F.array(span(lo, hi))).otherwise(F.array(span(F.col("start"), lo - 1), span(hi + 1, F.greatest("stop", "b_stop"))))
        parts = F.concat(F.when(F.col("_gone"), none).otherwise(F.array(span(F.col("start"), F.col("stop")))), F.when(F.col("_now"), kept).otherwise(none))
        changed = rows.join(moving, ["chrom", "island"], "left_semi").select("chrom", "island", F.explode(F.filter(parts, lambda x: x["start"] <= x["stop"])).alias("x"))
        open_ = changed.select("chrom", "island", "x.*").distinct()


#: All pairs of an island of so many intervals meet by its number; of larger ones those that share a bin.
PAIRED = 64


def trim_overlaps(df: DataFrame, low: float = 0.1, high: float = 0.9, bin_size: int = 10_000) -> DataFrame:
    """Repeats go; pairs that share little are cut apart, pairs that share nearly all keep what they share.

    The ratio is (shared stop - start) to the smaller length. Pairs in between stay and are marked unclear. Works in
    rounds. First neighbours change, which thins out deep piles; then any pairs: every interval takes part in one change
    of a round at most, that of the pair whose hash is the least of all changing pairs of both intervals. Islands without
    a change are settled and leave the rounds: what they hold overlaps, or is alone.
    """
    pair = ["start", "stop", "b_start", "b_stop"]
    ends = lambda a, b: F.struct(F.col(a).alias("start"), F.col(b).alias("stop"))
    distinct = df.select("chrom", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")).distinct()
    open_, done = materialize(_trim_neighbours(distinct, low, high, bin_size), "thinned"), []
    while True:
        tagged = islands(open_)
        sizes = tagged.groupBy("chrom", "island").agg(F.count("*").alias("n"))
        open_ = materialize(tagged.join(sizes, ["chrom", "island"]), "intervals")
        few, many = (open_.where(c).drop("n") for c in (f"n BETWEEN 2 AND {PAIRED}", f"n > {PAIRED}"))
        met = few.join(few.withColumnsRenamed({"start": "b_start", "stop": "b_stop"}), ["chrom", "island"]).where("start <= b_stop AND b_start <= stop")
        if not many.isEmpty():
            met = met.unionByName(overlap_join(many, many, on=("chrom", "island"), bin_size=bin_size))
        rank = F.struct(F.md5(F.concat_ws(":", "chrom", *pair)).alias("hash"), *pair)
        changing = met.where(F.struct("start", "stop") < F.struct("b_start", "b_stop")).withColumn("change", _share(low, high)).where("change is not null").withColumn("rank", rank)
        changing = materialize(changing.select("chrom", "island", *pair, "change", "rank"), "changes")
        moving = changing.select("chrom", "island").distinct()
        done.append(open_.join(moving, ["chrom", "island"], "left_anti").select("chrom", "start", "stop", (F.col("n") > 1).alias("unclear")))
        if changing.isEmpty():
            return reduce(DataFrame.unionByName, done)
        turns = changing.select("chrom", "island", F.explode(F.array(ends("start", "stop"), ends("b_start", "b_stop"))).alias("x"), "rank")
        first = turns.groupBy("chrom", "island", "x").agg(F.min("rank").alias("rank"))
        chosen = first.groupBy("chrom", "island", "rank").agg(F.count("*").alias("n")).where("n = 2").select("chrom", "island", "rank")  # first in turn on both sides
        now = materialize(changing.join(chosen, ["chrom", "island", "rank"], "left_semi"), "changes-now")
        kept = now.where("change = 'shared'").select("chrom", F.greatest("start", "b_start").alias("start"), F.least("stop", "b_stop").alias("stop"))
        parts = remove_overlap(now.where("change = 'cut'")).select("chrom", F.col("part_start").alias("start"), F.col("part_stop").alias("stop"))
        gone = now.select("chrom", "island", F.explode(F.array(ends("start", "stop"), ends("b_start", "b_stop"))).alias("x")).select("chrom", "island", "x.*")
        rest = open_.join(moving, ["chrom", "island"], "left_semi").join(gone, ["chrom", "island", "start", "stop"], "left_anti").select("chrom", "start", "stop")
        open_ = rest.unionByName(kept).unionByName(parts).distinct()


def region_string(chrom: Column, start: Column, stop: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), stop.cast("string"))


def parse_region(region: Column) -> Column:
    """Struct of chrom, start and stop."""
    part = lambda i: F.regexp_extract(region, "^(.+):(\\d+)-(\\d+)$", i)
    return F.struct(part(1).alias("chrom"), part(2).cast("bigint").alias("start"), part(3).cast("bigint").alias("stop"))


def query_region_sites(sites: DataFrame, regions: DataFrame) -> DataFrame:
    """Sites (chrom, pos, ..., af) inside regions; a frequency of '.' counts as 0."""
    points = sites.withColumns({"start": F.col("pos"), "stop": F.col("pos"), "af": F.coalesce(F.col("af").try_cast("double"), F.lit(0.0))})
    return overlap_join(points, regions.select("chrom", "name", "start", "stop")).drop("start", "stop")


def ucsc_snp_frequencies(snps: DataFrame) -> DataFrame:
    """1-based position, alleles on the forward strand and minor allele frequency (total - reference) / total."""
    flip = lambda x: F.translate(x, "ACGT", "TGCA")
    alleles = F.when(F.col("strand") == "-", F.transform("alleles", flip)).otherwise(F.col("alleles"))
    rows = snps.withColumns({"alleles": alleles, "pos": F.col("chrom_start") + 1})
    total = F.aggregate("counts", F.lit(0.0), lambda acc, x: acc + x)
    ref = F.aggregate(F.arrays_zip(F.col("alleles").alias("a"), F.col("counts").alias("n")), F.lit(0.0), lambda acc, x: acc + F.when(x["a"] == F.col("ref"), x["n"]).otherwise(0.0))
    return rows.withColumn("maf", F.try_divide(total - ref, total))


def _exons(transcripts: DataFrame) -> DataFrame:
    """One row per exon, 1-based: gene, chrom, strand, start, stop; transcripts on standard chromosomes (short names)."""
    pairs = F.arrays_zip(F.col("exon_starts").alias("s"), F.col("exon_ends").alias("e"))
    return transcripts.where(F.length("chrom") < 6).select("gene", "chrom", "strand", F.explode(pairs).alias("x")).select("gene", "chrom", "strand", (F.col("x.s") + 1).alias("start"), F.col("x.e").alias("stop"))


def gene_exons(transcripts: DataFrame) -> DataFrame:
    """Merged exons of all transcripts of a gene; genes on more than one standard chromosome have none."""
    exons = _exons(transcripts)
    single = exons.groupBy("gene").agg(F.countDistinct("chrom").alias("n")).where("n = 1")
    return merge_intervals(exons.join(single.select("gene"), "gene", "left_semi"), 0, keys=("gene", "chrom", "strand")).drop("n")


def gene_targets(transcripts: DataFrame) -> DataFrame:
    return gene_exons(transcripts).groupBy("gene", "chrom").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def exon_targets(transcripts: DataFrame) -> DataFrame:
    """gene-exon-j, counted from 0 in the direction of the gene."""
    exons = gene_exons(transcripts)
    order = Window.partitionBy("gene").orderBy(F.when(F.col("strand") == "-", -F.col("stop")).otherwise(F.col("start")))
    return exons.withColumn("name", F.concat("gene", F.lit("-exon-"), (F.row_number().over(order) - 1).cast("string"))).select("name", "gene", "chrom", "start", "stop")


def genes_in_region(transcripts: DataFrame, regions: DataFrame) -> DataFrame:
    spans = transcripts.select("gene", "chrom", (F.col("tx_start") + 1).alias("start"), F.col("tx_end").alias("stop"))
    return overlap_join(spans, regions.select("chrom", "name", "start", "stop")).select(F.col("b_name").alias("name"), "gene").distinct()


def cds_positions(transcripts: DataFrame) -> DataFrame:
    """gene, chrom, strand, pos and cds_pos (from 0, in the direction of the gene); bounds of the first transcript by name."""
    first = transcripts.groupBy("gene").agg(F.min(F.struct("name", "cds_start", "cds_end")).alias("t")).select("gene", (F.col("t.cds_start") + 1).alias("lo"), F.col("t.cds_end").alias("hi"))
    exons = gene_exons(transcripts).join(first, "gene").withColumns({"start": F.greatest("start", "lo"), "stop": F.least("stop", "hi")}).where("start <= stop")
    bases = exons.withColumn("pos", F.explode(F.sequence("start", "stop")))
    order = Window.partitionBy("gene").orderBy(F.when(F.col("strand") == "-", -F.col("pos")).otherwise(F.col("pos")))
    return bases.select("gene", "chrom", "strand", "pos", (F.row_number().over(order) - 1).alias("cds_pos"))


def aa_to_coordinate(ranges: DataFrame, positions: DataFrame) -> DataFrame:
    """Genomic bounds of residues aa_start to aa_stop of a gene; null outside of its coding sequence."""
    at = positions.select("gene", "chrom", "strand", "pos", "cds_pos")
    lo = at.withColumnsRenamed({"pos": "first_pos", "cds_pos": "_first"})
    hi = at.select("gene", F.col("pos").alias("last_pos"), F.col("cds_pos").alias("_last"))
    rows = ranges.withColumns({"_first": F.col("aa_start") * 3 - 3, "_last": F.col("aa_stop") * 3 - 1})
    out = rows.join(lo, ["gene", "_first"], "left").join(hi, ["gene", "_last"], "left").drop("_first", "_last")
    return out.withColumns({"start": F.least("first_pos", "last_pos"), "stop": F.greatest("first_pos", "last_pos")}).drop("first_pos", "last_pos")


def merge_targets(targets: DataFrame, capture: int) -> DataFrame:
    """Targets within twice the capture size become one: names listed, labelled by the first name, genes before others.

    targets: name, chrom, start, stop and priority (0 first).
    """
    merged = islands(targets, 2 * capture)
    out = merged.groupBy("chrom", "island").agg(F.max("stop").alias("stop"), F.min(F.struct("priority", "start", "name"))["name"].alias("label"), F.array_join(F.sort_array(F.collect_set("name")), ",").alias("names"))
    return out.select(F.regexp_replace("label", "[^A-Za-z0-9-]", "-").alias("label"), "chrom", F.col("island").alias("start"), "stop", "names")


def snp_targets(rows: DataFrame) -> DataFrame:
    """Locations of each SNP id: alternate alleles listed, the main assembly's location first (no '_' in its name)."""
    at = rows.groupBy("rsid", "chrom", "pos", "ref").agg(F.array_join(F.sort_array(F.collect_set("alt")), ",").alias("alts"))
    order = Window.partitionBy("rsid").orderBy(F.col("chrom").contains("_"), "chrom", "pos")
    return at.withColumn("location", F.row_number().over(order) - 1)


def unresolved_snps(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Ids without a location on the main assembly."""
    return wanted.select("rsid").distinct().join(rows.where(~F.col("chrom").contains("_")), "rsid", "left_anti")


def snp_region_targets(locations: DataFrame, flank: int) -> DataFrame:
    return locations.withColumns({"start": F.greatest(F.lit(1), F.col("pos") - flank), "stop": F.col("pos") + flank})


def missed_targets(targets: DataFrame, aligned: DataFrame, min_size: int) -> DataFrame:
    """Parts of targets that no alignment covers, at least so long, with the names of the targets that they come from."""
    left = subtract_intervals(targets.select("chrom", "start", "stop"), aligned, 0).where(F.col("stop") - F.col("start") + 1 >= min_size)
    named = overlap_join(left, targets.select("chrom", "start", "stop", "name"))
    return named.groupBy("chrom", "start", "stop").agg(F.array_join(F.sort_array(F.collect_set("b_name")), ",").alias("names"))


def group_overlapping_targets(regions: DataFrame, spacer: int = 0) -> DataFrame:
    """Targets that share any aligned region form a group: name and group_id, the smallest target number of the group.

    regions: number (long), name, chrom, start, stop; a target may have many.
    """
    pairs = overlap_join(regions, regions, padding=spacer).where("number < b_number").select(F.col("number").alias("a"), F.col("b_number").alias("b")).distinct()
    found = components(pairs)
    names = regions.select("number", "name").distinct()
    return names.join(found, names["number"] == found["node"], "left").select("number", "name", F.coalesce("component", "number").alias("group_id"))


def split_multi_aligned_copies(alignments: DataFrame) -> DataFrame:
    """Copies aligned more than once get a suffix per place."""
    w = Window.partitionBy("group_name", "copy")
    n, k = F.count("*").over(w), F.row_number().over(w.orderBy("chrom", "start", "stop"))
    return alignments.withColumn("copy_name", F.when(n > 1, F.concat("copy", F.lit("-"), (k - 1).cast("string"))).otherwise(F.col("copy")))


def missing_copies(expected: DataFrame, alignments: DataFrame) -> DataFrame:
    return expected.join(alignments, ["group_name", "copy"], "left_anti")


def msa_position_map(rows: DataFrame, start: str = "start") -> DataFrame:
    """Alignment column to genome position: gaps have none."""
    cells = rows.select("name", F.col(start).alias("_s"), F.posexplode(F.split("aligned", "")).alias("column", "base"))
    seen = F.sum((F.col("base") != "-").cast("int")).over(Window.partitionBy("name").orderBy("column"))
    return cells.withColumn("pos", F.when(F.col("base") != "-", F.col("_s") + seen - 1)).drop("_s")


def paralog_coordinate_map(rows: DataFrame) -> DataFrame:
    """Positions of two aligned copies against each other, and where their bases differ.

    rows: name, a_start, a_aligned, b_start, b_aligned.
    """
    pairs = F.arrays_zip(F.split("a_aligned", "").alias("a"), F.split("b_aligned", "").alias("b"))
    cells = rows.select("name", "a_start", "b_start", F.posexplode(pairs).alias("column", "c")).select("name", "column", "a_start", "b_start", "c.a", "c.b")
    w = Window.partitionBy("name").orderBy("column")
    place = lambda c: F.when(F.col(c) != "-", F.col(f"{c}_start") + F.sum((F.col(c) != "-").cast("int")).over(w) - 1)
    return cells.select("name", "column", place("a").alias("a_pos"), place("b").alias("b_pos"), (F.col("a") != F.col("b")).alias("differs"))


def contig_regions(probes: DataFrame, lengths: DataFrame, targets: DataFrame, merge: int = 1000, pad: int = 500) -> DataFrame:
    """Contigs of probes with padded region strings inside their chromosome, and whether they hold a target."""
    contigs = merge_intervals(probes, merge).drop("n").join(lengths, "chrom")
    name = F.concat("chrom", F.lit("_"), (F.row_number().over(Window.partitionBy("chrom").orderBy("start")) - 1).cast("string"))
    region = region_string(F.col("chrom"), F.greatest(F.lit(1), F.col("start") - pad), F.least(F.col("stop") + pad, F.col("length")))
    rows = contigs.select("chrom", "start", "stop", name.alias("contig_name"), region.alias("region"))
    points = targets.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("stop"))
    held = overlap_join(rows, points).select("contig_name").distinct().withColumn("contains_targets", F.lit(True))
    return rows.join(held, "contig_name", "left").na.fill(False, ["contains_targets"])


def region_sequences(regions: DataFrame, contigs: DataFrame, chunk_size: int) -> DataFrame:
    """Sequence of each region; contigs hold the genome in pieces (chrom, chunk, seq)."""
    spread = regions.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("start") - 1) / chunk_size), F.floor((F.col("stop") - 1) / chunk_size))))
    lo = F.greatest(F.col("start") - F.col("chunk") * chunk_size, F.lit(1)).cast("int")
    hi = F.least(F.col("stop") - F.col("chunk") * chunk_size, F.lit(chunk_size)).cast("int")
    parts = spread.join(contigs, ["chrom", "chunk"]).select("name", "chrom", "start", "stop", "chunk", F.substring("seq", lo, hi - lo + 1).alias("part"))
    return parts.groupBy("name", "chrom", "start", "stop").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"]), "").alias("sequence"))


def codon_sequences(coordinates: DataFrame, sequences: DataFrame) -> DataFrame:
    """codon and residue of genomic codon bounds, read in the direction of the gene."""
    rows = coordinates.join(sequences.select("name", "sequence"), "name")
    codon = F.when(F.col("strand") == "-", reverse_complement(F.col("sequence"))).otherwise(F.col("sequence"))
    return rows.withColumn("codon", codon).withColumn("residue", F.coalesce(codon_map()[F.col("codon")], F.lit("X"))).drop("sequence")


def padded_bed(probes: DataFrame, pad: int = 200) -> DataFrame:
    return probes.select("chrom", (F.col("start") - pad).alias("start"), (F.col("stop") + pad).alias("stop"), "name")


def locus_variants(*sources: DataFrame) -> DataFrame:
    """Variants of several sources as one table of single bases, the source with the least name winning a place."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s, allowMissingColumns=True)
    places = F.when((F.length("ref") == F.length("alt")) & (F.length("ref") > 1), F.sequence(F.lit(1), F.length("ref"))).otherwise(F.array(F.lit(1)))
    many = F.size(places) > 1
    single = rows.withColumn("_i", F.explode(places)).select("chrom", (F.col("pos") + F.col("_i") - 1).alias("pos"), F.when(many, F.substring("ref", F.col("_i"), F.lit(1))).otherwise(F.col("ref")).alias("ref"), F.when(many, F.substring("alt", F.col("_i"), F.lit(1))).otherwise(F.col("alt")).alias("alt"), "source")
    return single.where("ref <> alt").groupBy("chrom", "pos", "ref", "alt").agg(F.min("source").alias("source"))


def subregions(targets: DataFrame, exons: DataFrame, flank: int) -> DataFrame:
    """By capture type: whole targets; exons, with targets that no exon covers; or targets. Merged at twice the flank."""
    keyed = targets.select("region", "chrom", "start", "stop", "capture_type")
    whole = keyed.where("capture_type = 'whole'")
    listed = keyed.where("capture_type = 'targets'")
    wanted = keyed.where("capture_type = 'exons'")
    parts = exons.join(wanted.select("region").distinct(), "region", "left_semi").withColumn("capture_type", F.lit("exons"))
    hit = overlap_join(wanted, exons.select("region", "chrom", "start", "stop"), on=("region", "chrom")).select("region", "chrom", "start", "stop").distinct()
    bare = wanted.join(hit, ["region", "chrom", "start", "stop"], "left_anti")
    rows = whole.unionByName(listed).unionByName(parts.select(keyed.columns)).unionByName(bare)
    return merge_intervals(rows, 2 * flank, keys=("region", "capture_type", "chrom")).drop("n")


def projected_exons(exons: DataFrame, mapping: DataFrame) -> DataFrame:
    """A copy's exons in the coordinates of the reference copy, merged. mapping: name, a_pos (reference), b_pos (copy)."""
    at = mapping.where("a_pos is not null and b_pos is not null").select("name", F.col("a_pos"), F.col("b_pos").alias("start"), F.col("b_pos").alias("stop"))
    inside = overlap_join(exons, at, on=("name",)).select("name", F.col("b_a_pos").alias("start"), F.col("b_a_pos").alias("stop"))
    return merge_intervals(inside, 1, keys=("name",)).drop("n")


def mask_positions(templates: DataFrame, variants: DataFrame) -> DataFrame:
    """A template's sequence with variant positions in lower case. templates: name, chrom, start, sequence."""
    bases = templates.select("name", "chrom", F.posexplode(F.split("sequence", "")).alias("i", "base"), F.col("start")).withColumn("pos", F.col("start") + F.col("i"))
    marks = variants.select("chrom", "pos").distinct().withColumn("_mask", F.lit(True))
    letters = bases.join(marks, ["chrom", "pos"], "left").withColumn("base", F.when(F.col("_mask"), F.lower("base")).otherwise(F.upper("base")))
    return letters.groupBy("name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "base"))), lambda x: x["base"]), "").alias("masked"))


def excluded_ranges(templates: DataFrame, variants: DataFrame, spacer: int = 17) -> DataFrame:
    """Variant positions inside templates as ranges, merged when close."""
    points = variants.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("stop")).distinct()
    spans = templates.select("name", "chrom", "start", (F.col("start") + F.length("sequence") - 1).alias("stop"))
    hits = overlap_join(points, spans).select(F.col("b_name").alias("name"), "chrom", "start", "stop")
    return merge_intervals(hits, spacer, keys=("name", "chrom")).drop("n")
