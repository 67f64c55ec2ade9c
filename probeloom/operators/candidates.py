"""Tables of probe candidates: primers, their hits, pairs and scores. Candidates and temperatures come from outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reference_length
from ..scratch import materialize
from .intervals import merge_intervals, overlap_join


def primer_hit_filter(hits: DataFrame, keep: int, drop: int) -> DataFrame:
    """Alignment hits of primers with fewer than drop hits, the first keep - 1 of each, with their end and strand.

    hits: primer, ord, flag, chrom, pos, cigar. Hits are counted first, so that those of repeats go before any sorting.
    """
    few = hits.groupBy("primer").agg(F.count("*").alias("_n")).where(F.col("_n") < drop).select("primer")
    rows = hits.join(few, "primer", "left_semi").withColumn("_i", F.row_number().over(Window.partitionBy("primer").orderBy("ord"))).where(F.col("_i") < keep)
    strand = F.when(F.col("flag").bitwiseAND(16) == 16, "-").otherwise("+")
    return rows.withColumns({"stop": F.col("pos") + reference_length(F.col("cigar")) - 1, "strand": strand}).drop("_i")


def offtarget_tm_filter(primers: DataFrame, hits: DataFrame, low: float, high: float, most_high: int, most_low: int) -> DataFrame:
    """Primers without too many off-target hits that melt at high or more, or between low and high."""
    bad = hits.groupBy("primer").agg(F.count(F.when(F.col("tm") >= high, 1)).alias("h"), F.count(F.when((F.col("tm") >= low) & (F.col("tm") < high), 1)).alias("l")).where((F.col("h") > most_high) | (F.col("l") > most_low))
    return primers.join(bad, "primer", "left_anti")


def intended_hit_match(hits: DataFrame, intended: DataFrame) -> DataFrame:
    """Hits with copy, the intended copy that they equal in place and strand; null for off-target hits."""
    return hits.join(intended.select("primer", "chrom", "start", "stop", "strand", "copy"), ["primer", "chrom", "start", "stop", "strand"], "left")


def alternative_arm(alternatives: DataFrame, limit: float) -> DataFrame:
    """Of each primer's and copy's alternatives the one closest in temperature to the reference, if within the limit."""
    rows = alternatives.withColumn("distance", F.abs(F.col("tm") - F.col("reference_tm"))).where(F.col("distance") <= limit)
    best = rows.groupBy("primer", "copy").agg(F.min(F.struct("distance", "alternative")).alias("b"))
    return best.select("primer", "copy", F.col("b.alternative").alias("alternative"), F.col("b.distance").alias("distance"))


def linear_feature_score(features: DataFrame, coefficients: DataFrame, intercept: float = 0.0, key: str = "primer") -> DataFrame:
    """Sum over features of coefficient * value ** degree, and the intercept. Features without coefficients don't count."""
    terms = features.join(coefficients, "feature").withColumn("term", F.col("coefficient") * F.pow(F.col("value"), F.col("degree")))
    return terms.groupBy(key).agg((F.sum("term") + intercept).alias("score"))


def top_n_per_bin(primers: DataFrame, n: int, bin_size: int) -> DataFrame:
    """The n best primers of each strand and bin of their 3' end; ties by name."""
    end = F.when(F.col("strand") == "+", F.col("stop")).otherwise(F.col("start"))
    order = Window.partitionBy("strand", "_bin").orderBy(F.desc("score"), "primer")
    return primers.withColumn("_bin", F.floor(end / bin_size)).withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("_bin")


def _net_places(ends: DataFrame, insertions: DataFrame, bin_size: int) -> DataFrame:
    """Ends of products with net, their place less the insertions before it, and top, the greatest net place so far on the chromosome.

    ends: chrom, at, turn: 0 for first bases, before the insertions at their place, 2 for last bases, behind them. Totals run
    inside bins, then over one row for each bin, so no task sees a whole chromosome.
    """
    inserted = insertions.where("chrom IS NOT NULL AND pos IS NOT NULL").select("chrom", F.col("pos").cast("long").alias("at"), F.lit(1).alias("turn"), F.coalesce("size", F.lit(0)).alias("size"))
    both = ends.unionByName(inserted, allowMissingColumns=True).withColumn("_bin", F.floor(F.col("at") / bin_size))
    so_far = Window.partitionBy("chrom", "_bin").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_net", F.col("at") - F.coalesce(F.sum("size").over(so_far), F.lit(0)) + F.when(F.col("turn") == 1, F.col("size")).otherwise(0))
    both = materialize(both.withColumn("_top", F.max("_net").over(so_far)), "net-places")
    before = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = both.groupBy("chrom", "_bin").agg(F.sum("size").alias("_sum"), F.max("_top").alias("_best"))
    bins = bins.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    bins = bins.withColumn("_reached", F.max(F.col("_best") - F.col("_base")).over(before)).drop("_sum", "_best")
    placed = both.where("turn != 1").join(bins, ["chrom", "_bin"])
    return placed.withColumns({"net": F.col("_net") - F.col("_base"), "top": F.greatest(F.col("_top") - F.col("_base"), "_reached")}).select(*ends.columns, "net", "top")


def pair_primers(extension: DataFrame, ligation: DataFrame, insertions: DataFrame, least: int, most: int, reference: str = "C0", *, apart: int | None = None, bin_size: int = 100_000) -> DataFrame:
    """Pairs of primers on one copy and strand, extension first, with a product size within bounds on the reference copy.

    Insertions inside the product make it smaller than it looks; on other copies only the upper bound holds. Pairs that
    don't fit on the reference copy are left out on all copies. Primers: primer, copy, chrom, strand, start, stop, with
    start <= stop; the others have no place and are left out. apart: so many bases at most from the end of one primer to
    the start of the other; without it, whatever the bounds allow.

    A product's size less its insertions is a difference of two net places, one of each primer, so pairs never meet the
    insertions. Pairs are looked for within apart; without it, where the first base's greatest net place so far can lie:
    from the net place of the last base less most up to the greatest there.
    """

    def ends(primers: DataFrame, first: str) -> DataFrame:
        opens = F.col("strand") == first
        placed = primers.where("primer IS NOT NULL AND chrom IS NOT NULL AND start <= stop AND strand IN ('+', '-')")
        return placed.select("primer", "copy", "chrom", "strand", "start", "stop", F.when(opens, F.col("start")).otherwise(F.col("stop")).cast("long").alias("at"), F.when(opens, 0).otherwise(2).alias("turn"))

    places = _net_places(ends(extension, "+").unionByName(ends(ligation, "-")), insertions, bin_size).drop("at")
    own = ["primer", "start", "stop", "net"]
    width = most if apart is None else max(1, apart)
    mark, lo, hi = (F.col("top"), F.col("net") - most + 1, F.col("top")) if apart is None else (F.col("stop"), F.col("start") - width, F.col("start") - 1)
    a = places.where("turn = 0").select("copy", "chrom", "strand", *[F.col(c).alias(f"a_{c}") for c in own], F.floor(mark / width).alias("_cell"))
    cells = F.sequence(F.floor(lo / width), F.floor(hi / width))
    b = places.where("turn = 2").select("copy", "chrom", "strand", *[F.col(c).alias(f"b_{c}") for c in own], F.explode(cells).alias("_cell"))
    net, size = F.col("b_net") - F.col("a_net") + 1, F.col("b_stop") - F.col("a_start") + 1
    fits = (F.col("a_stop") < F.col("b_start")) & (net <= most) & ((F.col("copy") != reference) | (size >= least))
    if apart is not None:
        fits &= F.col("b_start") - F.col("a_stop") <= apart
    forward = F.col("strand") == "+"
    each = {f"{p}_{c}": F.when(forward, F.col(f"{x}_{c}")).otherwise(F.col(f"{y}_{c}")) for p, x, y in (("e", "a", "b"), ("l", "b", "a")) for c in ("primer", "start", "stop")}
    kept = a.join(b, ["copy", "chrom", "strand", "_cell"]).where(fits).select(*[x.alias(name) for name, x in each.items()], "copy", "chrom", "strand", F.col("a_start").alias("start"), F.col("b_stop").alias("stop"), (size - net).alias("inserted"), size.alias("size"))
    on_reference = F.max(F.col("copy") == reference).over(Window.partitionBy("e_primer", "l_primer"))
    return kept.withColumn("_on", on_reference).where("_on").drop("_on")


def near_duplicate_filter(probes: DataFrame, bin_size: int) -> DataFrame:
    """Of probes on one strand whose both ends are within bin_size, the ones that no better probe repeats; ties by name."""
    ends = probes.select("probe", "chrom", "strand", F.col("start").alias("_s"), F.col("stop").alias("_e"), "score")
    other = ends.select("chrom", "strand", *[F.col(c).alias(f"o_{c}") for c in ("probe", "_s", "_e", "score")])
    left = ends.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_s") / bin_size) - 1, F.floor(F.col("_s") / bin_size) + 1)))
    right = other.withColumn("_bin", F.floor(F.col("o__s") / bin_size))
    close = (F.abs(F.col("_s") - F.col("o__s")) <= bin_size) & (F.abs(F.col("_e") - F.col("o__e")) <= bin_size)
    better = (F.col("o_score") > F.col("score")) | ((F.col("o_score") == F.col("score")) & (F.col("o_probe") < F.col("probe")))
    beaten = left.join(right, ["chrom", "strand", "_bin"]).where(close & better).select("probe").distinct()
    return probes.join(beaten, "probe", "left_anti")


def probe_compatibility(probes: DataFrame, same_strand: int, opposite: int) -> DataFrame:
    """Pairs of overlapping probes and whether both may be used: spans on one strand share at most same_strand bases,
    arms on opposite strands at most opposite bases.

    probes: probe, chrom, strand, start, stop, left_stop, right_start (the inner ends of the arms).
    """
    pairs = overlap_join(probes, probes).where("probe < b_probe")
    span = F.least("stop", "b_stop") - F.greatest("start", "b_start") + 1

    def shared(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
        return F.greatest(F.lit(0), F.least(a[1], b[1]) - F.greatest(a[0], b[0]) + 1)

    arms = lambda p: [(F.col(f"{p}start"), F.col(f"{p}left_stop")), (F.col(f"{p}right_start"), F.col(f"{p}stop"))]
    arm = F.greatest(*[shared(a, b) for a in arms("") for b in arms("b_")])
    ok = F.when(F.col("strand") == F.col("b_strand"), span <= same_strand).otherwise(arm <= opposite)
    return pairs.select("probe", "b_probe", span.alias("shared_span"), arm.alias("shared_arm"), ok.alias("compatible"))


def bin_probes(probes: DataFrame, bin_size: int) -> DataFrame:
    """Each probe with every bin of its chromosome that it touches."""
    return probes.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("stop") / bin_size))))


def capture_targets(probes: DataFrame, targets: DataFrame, mode: str = "capture", read_length: int = 150, trim: int = 0, barcode: int = 0) -> DataFrame:
    """Targets that a probe covers: inside its capture as far as reads reach, or inside its extension or ligation arm.

    probes: probe, chrom, capture_start, capture_end, ext_start, ext_end, lig_start, lig_end. mode: capture, extension,
    ligation, any or both (arms).
    """
    hits = overlap_join(targets.select("name", "chrom", "start", "stop", "kind"), probes.select("probe", "chrom", F.least("capture_start", "ext_start", "lig_start").alias("start"), F.greatest("capture_end", "ext_end", "lig_end").alias("stop"), "capture_start", "capture_end", "ext_start", "ext_end", "lig_start", "lig_end"))
    reach = read_length - trim - barcode
    inside = lambda a, b: (F.col("start") >= F.col(f"b_{a}")) & (F.col("stop") <= F.col(f"b_{b}"))
    read = (F.col("stop") < F.col("b_capture_start") + reach) | (F.col("start") > F.col("b_capture_end") - reach)
    capture, ext, lig = inside("capture_start", "capture_end") & read, inside("ext_start", "ext_end"), inside("lig_start", "lig_end")
    rule = {"capture": capture, "extension": ext, "ligation": lig, "any": capture | ext | lig, "both": ext | lig}[mode]
    return hits.where(rule).select(F.col("b_probe").alias("probe"), "name", "kind")


def unique_captures(captures: DataFrame) -> DataFrame:
    """Copies whose captured sequence no other copy of the probe has."""
    return captures.withColumn("_n", F.count("*").over(Window.partitionBy("probe", "sequence"))).where("_n = 1").drop("_n")


def probe_score(technical: DataFrame, arms: DataFrame, covered: DataFrame, points: DataFrame, unique: DataFrame, unique_bonus: float, alternatives: DataFrame, alternative_penalty: float, scale: float = 2000.0) -> DataFrame:
    """technical: scaled polynomial and arm scores; functional: points of covered targets, unique copies and alternatives."""
    base = technical.join(arms.groupBy("probe").agg(F.sum("score").alias("_arms")), "probe", "left").select("probe", F.round(scale * (F.col("score") + F.coalesce("_arms", F.lit(0.0))), 0).alias("technical"))
    got = covered.join(points, "kind").groupBy("probe").agg(F.sum("points").alias("_points"))
    copies = unique.groupBy("probe").agg(F.count("*").alias("_unique"))
    extra = alternatives.groupBy("probe").agg(F.count("*").alias("_alternatives"))
    rows = base.join(got, "probe", "left").join(copies, "probe", "left").join(extra, "probe", "left").na.fill(0)
    return rows.select("probe", "technical", (F.col("_points") + unique_bonus * F.col("_unique") - alternative_penalty * F.col("_alternatives")).alias("functional"))


def probe_set_score(sets: DataFrame, covered: DataFrame, scores: DataFrame, spans: DataFrame, must_bonus: float, spacer: int = 50) -> DataFrame:
    """Per set of probes: bonus for distinct must targets, the probes' scores, and the bases that the set covers.

    sets: set_id and probe, one row each.
    """
    targets = sets.join(covered.where("kind = 'must'"), "probe").groupBy("set_id").agg(F.countDistinct("name").alias("must"))
    total = sets.join(scores, "probe").groupBy("set_id").agg(F.sum("score").alias("scores"))
    merged = merge_intervals(sets.join(spans, "probe"), spacer, keys=("set_id", "chrom")).groupBy("set_id").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("covered"))
    rows = sets.select("set_id").distinct().join(targets, "set_id", "left").join(total, "set_id", "left").join(merged, "set_id", "left").na.fill(0)
    return rows.withColumn("score", must_bonus * F.col("must") + F.col("scores"))


def design_summary(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows left after each named filter."""
    out = None
    for i, (name, df) in enumerate(stages):
        row = df.agg(F.count("*").alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def missed_by_design(targets: DataFrame, covered: DataFrame) -> DataFrame:
    return targets.join(covered.select("name").distinct(), "name", "left_anti")


def name_probes(selected: DataFrame) -> DataFrame:
    """Final names gene_mipN in the order of position."""
    return selected.withColumn("mip_name", F.concat("gene", F.lit("_mip"), (F.row_number().over(Window.partitionBy("gene").orderBy("start", "probe")) - 1).cast("string")))


def select_probes(probes: DataFrame, listed: DataFrame, keep: bool = True) -> DataFrame:
    return probes.join(listed.select("probe").distinct(), "probe", "left_semi" if keep else "left_anti")
