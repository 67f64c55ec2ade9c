"""Queries for operators/copy_number.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import copy_number as C
from ..scratch import materialize
from .haplotype_queries import _DENSE, _dense
from .registry import query, rows

_STABLE = "mip NOT IN ('mip0', 'mip3')"
_FILTERED = f"""{_DENSE},
fs AS (SELECT sample_id FROM dense WHERE {_STABLE} GROUP BY sample_id HAVING quantile_cont(umi, 0.5) >= 300),
fr AS (SELECT * FROM dense WHERE sample_id IN (SELECT sample_id FROM fs)),
fp AS (SELECT mip, copy FROM fr GROUP BY mip, copy HAVING quantile_cont(umi, 0.5) >= 100),
ft AS (SELECT fr.* FROM fr JOIN fp ON fr.mip = fp.mip AND fr.copy = fp.copy),
nm AS (SELECT *, umi / nullif(cast(sum(CASE WHEN {_STABLE} THEN umi END) OVER (PARTITION BY sample_id) AS double), 0) AS normalized FROM ft),
lv AS (SELECT mip, copy, (quantile_cont(normalized, 0.4) + quantile_cont(normalized, 0.6)) / 2 AS level FROM nm GROUP BY mip, copy),
cc AS (SELECT nm.*, 2 * normalized / nullif(level, 0) AS copy_count FROM nm JOIN lv ON nm.mip = lv.mip AND nm.copy = lv.copy)"""


def _filtered(spark, sf):
    return C.filter_samples_probes(_dense(spark, sf), F.expr(_STABLE), 300, 100)


def _normalized(spark, sf):
    return C.sample_normalize(_filtered(spark, sf), F.expr(_STABLE))


def _counts(spark, sf):
    return C.annotate_probe_coordinates(C.probe_normalize(_normalized(spark, sf)), rows(spark, sf, "probe_copies"))


@query("annotate_probe_coordinates", f"WITH {_DENSE} SELECT d.*, chrom, capture_start AS begin, capture_end AS \"end\", gene FROM dense AS d JOIN probe_copies AS p ON d.mip = p.mip AND d.copy = p.copy")
def annotate_probe_coordinates(spark, sf):
    return C.annotate_probe_coordinates(_dense(spark, sf), rows(spark, sf, "probe_copies"))


@query("filter_samples_probes", f"WITH {_FILTERED} SELECT * FROM ft")
def filter_samples_probes(spark, sf):
    return _filtered(spark, sf)


@query("sample_normalize", f"WITH {_FILTERED} SELECT sample_id, mip, copy, umi, round(normalized, 9) AS normalized FROM nm")
def sample_normalize(spark, sf):
    return _normalized(spark, sf).withColumn("normalized", F.round("normalized", 9))


@query("probe_normalize", f"WITH {_FILTERED} SELECT sample_id, mip, copy, umi, round(copy_count, 6) AS copy_count FROM cc")
def probe_normalize(spark, sf):
    return C.probe_normalize(_normalized(spark, sf)).select("sample_id", "mip", "copy", "umi", F.round("copy_count", 6).alias("copy_count"))


def _clusters(spark, sf):
    return C.cluster_samples(_counts(spark, sf).withColumnRenamed("chrom", "unit"), "unit", 3)


@query("cluster_samples", None)
def cluster_samples(spark, sf):
    return _clusters(spark, sf)


def _segments(spark, sf):
    counts = materialize(_counts(spark, sf).withColumnRenamed("chrom", "unit"), "copy-counts")  # read for the clusters and for their profiles
    return C.segment_breakpoints(C.cluster_profiles(counts, C.cluster_samples(counts, "unit", 3), "unit"), "unit", undo_small=1.0)


@query("segment_breakpoints", None)
def segment_breakpoints(spark, sf):
    return _segments(spark, sf)


@query("clean_breakpoints", None)
def clean_breakpoints(spark, sf):
    return C.clean_breakpoints(_segments(spark, sf), "unit")


_UNITS = f"{_FILTERED}, un AS (SELECT cc.*, p.chrom AS unit, p.gene, CASE WHEN length(cc.mip) = 4 THEN 0 ELSE 1 END AS segment FROM cc JOIN probe_copies AS p ON cc.mip = p.mip AND cc.copy = p.copy)"


def _units(spark, sf):
    return _counts(spark, sf).withColumnRenamed("chrom", "unit").withColumn("segment", F.when(F.length("mip") == 4, 0).otherwise(1))


@query("integer_calls", f"""WITH {_UNITS}, sp AS (SELECT unit, segment, mip, copy, stddev_samp(copy_count) AS sd FROM un GROUP BY unit, segment, mip, copy), md AS (SELECT unit, segment, quantile_cont(sd, 0.5) AS m FROM sp GROUP BY unit, segment),
r AS (SELECT un.* FROM un JOIN sp ON un.unit = sp.unit AND un.segment = sp.segment AND un.mip = sp.mip AND un.copy = sp.copy JOIN md ON md.unit = un.unit AND md.segment = un.segment WHERE sd <= 2 * m),
o AS (SELECT unit, segment, sample_id, round_even(quantile_cont(copy_count, 0.5), 0) AS rounded FROM r GROUP BY unit, segment, sample_id),
d AS (SELECT r.unit, r.segment, r.sample_id, rounded, sqrt(sum(pow(copy_count - 2.5, 2))) AS du, sqrt(sum(pow(copy_count - 1.5, 2))) AS dl, sqrt(sum(pow(copy_count - rounded, 2))) AS dr
  FROM r JOIN o ON r.unit = o.unit AND r.segment = o.segment AND r.sample_id = o.sample_id GROUP BY r.unit, r.segment, r.sample_id, rounded)
SELECT unit, segment, sample_id, (CASE WHEN du <= dr OR dl <= dr THEN 2 ELSE rounded END)::INT AS copies FROM d""")
def integer_calls(spark, sf):
    return C.integer_calls(_units(spark, sf))


_STATES = f"""{_UNITS}, sg AS (SELECT unit, sample_id, segment, quantile_cont(copy_count, 0.5) AS level FROM un GROUP BY unit, sample_id, segment),
pf AS (SELECT unit, sample_id, list(level ORDER BY segment) AS "values", list(round_even(level, 0) ORDER BY segment) AS state FROM sg GROUP BY unit, sample_id)"""


@query("collapse_to_common_states", f"""WITH {_STATES}, rk AS (SELECT unit, state AS common, row_number() OVER (PARTITION BY unit ORDER BY count(*) DESC, state) AS place FROM pf GROUP BY unit, state),
ft2 AS (SELECT pf.unit, sample_id, common, place FROM pf JOIN rk ON pf.unit = rk.unit WHERE list_distance("values", common) - list_distance("values", state) < 0.8)
SELECT unit, sample_id, min(ROW(place, common))[2] AS state FROM ft2 GROUP BY unit, sample_id""")
def collapse_to_common_states(spark, sf):
    segments = _units(spark, sf).groupBy("unit", "sample_id", "segment").agg(F.expr("percentile(copy_count, 0.5)").alias("level"))
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("segment", c.alias("v")))), lambda x: x["v"])
    profiles = segments.groupBy("unit", "sample_id").agg(in_order(F.col("level")).alias("values"), in_order(F.bround("level", 0)).alias("state"))
    return C.collapse_to_common_states(profiles, profiles, 0.8)


_CNV = "SELECT DISTINCT 'S' || l_suppkey AS sample_id, 'chr' || (l_partkey % 5 + 1) AS chrom, l_partkey % 40 * 1000 - 50 AS start, l_partkey % 40 * 1000 + l_linenumber * 60 AS stop, cast(l_linenumber % 5 AS int) AS copies FROM lineitem WHERE l_quantity > 30"
_CONTROL = f"""kn AS ({_CNV}), hit AS (SELECT p.mip, p.copy, kn.sample_id, count(*) AS n, max(copies) AS mx, min(copies) AS mn FROM probe_copies AS p JOIN kn ON p.chrom = kn.chrom AND p.capture_start <= kn.stop AND kn.start <= p.capture_end GROUP BY p.mip, p.copy, kn.sample_id),
ctl AS (SELECT p.mip, p.copy, m.sample_id, CASE WHEN n IS NULL THEN 2 WHEN n = 1 THEN mx WHEN mx > 2 THEN CASE WHEN mn >= 2 THEN mx END ELSE mn END AS copies
  FROM (SELECT DISTINCT mip, copy FROM probe_copies) AS p CROSS JOIN (SELECT sample_id FROM sample_meta) AS m LEFT JOIN hit ON hit.mip = p.mip AND hit.copy = p.copy AND hit.sample_id = m.sample_id)"""


def _control(spark, sf):
    return C.control_copies(rows(spark, sf, "probe_copies"), rows(spark, sf, _CNV), rows(spark, sf, "sample_meta"))


@query("control_copies", f"WITH {_CONTROL} SELECT * FROM ctl")
def control_copies(spark, sf):
    return _control(spark, sf)


@query("control_normalize", f"""WITH {_FILTERED}, {_CONTROL}, one AS (SELECT nm.mip, nm.copy, normalized / nullif(ctl.copies, 0) AS v FROM nm JOIN ctl ON nm.mip = ctl.mip AND nm.copy = ctl.copy AND nm.sample_id = ctl.sample_id),
lw AS (SELECT mip, copy, (quantile_cont(v, 0.4) + quantile_cont(v, 0.6)) / 2 AS level FROM one GROUP BY mip, copy)
SELECT sample_id, nm.mip, nm.copy, umi, round(normalized / nullif(level, 0), 6) AS copy_count FROM nm JOIN lw ON nm.mip = lw.mip AND nm.copy = lw.copy""")
def control_normalize(spark, sf):
    return C.control_normalize(_normalized(spark, sf), _control(spark, sf)).select("sample_id", "mip", "copy", "umi", F.round("copy_count", 6).alias("copy_count"))


@query("allele_copies", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 + 0 ELSE 3 + p_size % 5 END::INT AS copies FROM part")
def allele_copies(spark, sf):
    table = rows(spark, sf, "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '0|0' WHEN 1 THEN '0|1' ELSE '2/3' END AS gt, '<CN0>,<CN3>,<CN' || p_size % 5 || '>' AS alts FROM part")
    return table.select("p_partkey", C.allele_copies(F.col("gt"), F.col("alts")).alias("copies"))


@query("simple_copy_calls", f"""WITH {_DENSE}, g AS (SELECT d.*, gene FROM dense AS d JOIN probe_copies AS p ON d.mip = p.mip AND d.copy = p.copy), v AS (SELECT *, umi / nullif(avg(umi) OVER (PARTITION BY sample_id), 0) AS v FROM g),
k AS (SELECT * FROM v WHERE gene = 'gene3' AND sample_id IN (SELECT sample_id FROM v WHERE gene = 'gene3' GROUP BY sample_id HAVING quantile_cont(umi, 0.5) >= 200)),
l AS (SELECT mip, copy, quantile_cont(v, 0.5) AS level FROM k GROUP BY mip, copy), r AS (SELECT k.*, v / nullif(level, 0) AS w FROM k JOIN l ON k.mip = l.mip AND k.copy = l.copy),
b AS (SELECT stddev_samp(m) AS base FROM (SELECT quantile_cont(w, 0.5) AS m FROM r GROUP BY sample_id)), c AS (SELECT mip, copy FROM r, b GROUP BY mip, copy, base HAVING stddev_samp(w) < 2 * base)
SELECT sample_id, round(quantile_cont(w, 0.5), 6) AS median_copy_count, round(avg(w), 6) AS mean_copy_count FROM r JOIN c ON r.mip = c.mip AND r.copy = c.copy GROUP BY sample_id""")
def simple_copy_calls(spark, sf):
    table = _dense(spark, sf).join(rows(spark, sf, "probe_copies").select("mip", "copy", "gene"), ["mip", "copy"])
    return C.simple_copy_calls(table, "gene3", 200, 2.0).select("sample_id", F.round("median_copy_count", 6).alias("median_copy_count"), F.round("mean_copy_count", 6).alias("mean_copy_count"))


@query("collapse_repeat_probes", f"WITH {_FILTERED} SELECT sample_id, mip, round(sum(copy_count), 6) AS copies, count(*) AS n, 2 * count(*) - 0.5::DOUBLE AS lower, 2 * count(*) + 0.5::DOUBLE AS upper FROM cc GROUP BY sample_id, mip")
def collapse_repeat_probes(spark, sf):
    return C.collapse_repeat_probes(_counts(spark, sf)).withColumn("copies", F.round("copies", 6))


_BYYEAR = "cl AS (SELECT 'all' AS unit, sample_id, year AS cluster FROM sample_meta)"


@query("cluster_summaries", f"""WITH {_FILTERED}, {_BYYEAR}, m AS (SELECT unit, cluster, count(*) AS members, count(CASE WHEN affected THEN 1 END) AS cases, count(CASE WHEN NOT affected THEN 1 END) AS controls FROM cl LEFT JOIN phenotype AS p ON cl.sample_id = p.sample_id GROUP BY unit, cluster),
d AS (SELECT cl.unit, cl.cluster, quantile_cont(copy_count, 0.5) AS median FROM cc JOIN cl ON cc.sample_id = cl.sample_id GROUP BY cl.unit, cl.cluster) SELECT m.*, round(median, 6) AS median FROM m JOIN d ON m.unit = d.unit AND m.cluster = d.cluster""")
def cluster_summaries(spark, sf):
    clusters = rows(spark, sf, "SELECT 'all' AS unit, sample_id, year AS cluster FROM sample_meta")
    out = C.cluster_summaries(_counts(spark, sf).withColumn("unit", F.lit("all")), clusters, "unit", rows(spark, sf, "phenotype"))
    return out.withColumn("median", F.round("median", 6))
