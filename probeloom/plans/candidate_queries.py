"""Queries for operators/candidates.py and operators/microhaplotypes.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import candidates as K
from ..operators import microhaplotypes as M
from ..scratch import scratch_path
from ..sources import readers as R
from ..sources import writers as W
from .registry import query, rows

_HITS = "SELECT 'p' || l_partkey AS primer, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey * 100 + cast(l_quantity AS bigint) AS ord, cast(l_suppkey % 2 * 16 AS int) AS flag, 'chr' || (l_suppkey % 14 + 1) AS chrom, l_partkey * 100 AS pos, '2S' || (l_linenumber + 15) || 'M1I' AS cigar, 40 + l_extendedprice % 30 AS tm FROM lineitem"


@query("primer_hit_filter", f"""WITH h AS (SELECT *, count(*) OVER (PARTITION BY primer) AS n, row_number() OVER (PARTITION BY primer ORDER BY ord) AS i FROM ({_HITS}))
SELECT primer, ord, chrom, pos, pos + (regexp_extract(cigar, '([0-9]+)M', 1)::BIGINT + 2) - 1 AS stop, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand FROM h WHERE n < 30 AND i < 5""")
def primer_hit_filter(spark, sf):
    return K.primer_hit_filter(rows(spark, sf, _HITS), 5, 30).select("primer", "ord", "chrom", "pos", "stop", "strand")


@query("offtarget_tm_filter", f"WITH b AS (SELECT primer FROM ({_HITS}) GROUP BY primer HAVING count(CASE WHEN tm >= 60 THEN 1 END) > 10 OR count(CASE WHEN tm >= 50 AND tm < 60 THEN 1 END) > 12) SELECT 'p' || p_partkey AS primer FROM part WHERE 'p' || p_partkey NOT IN (SELECT primer FROM b)")
def offtarget_tm_filter(spark, sf):
    return K.offtarget_tm_filter(rows(spark, sf, "SELECT 'p' || p_partkey AS primer FROM part"), rows(spark, sf, _HITS), 50, 60, 10, 12)


_PLACED = "SELECT DISTINCT 'p' || l_partkey AS primer, 'chr' || (l_suppkey % 14 + 1) AS chrom, l_partkey * 100 AS start, l_partkey * 100 + 20 AS stop, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand FROM lineitem"
_INTENDED = "SELECT 'p' || p_partkey AS primer, 'chr' || (p_size % 14 + 1) AS chrom, p_partkey * 100 AS start, p_partkey * 100 + 20 AS stop, '+' AS strand, 'C0' AS copy FROM part"


@query("intended_hit_match", f"SELECT h.*, i.copy FROM ({_PLACED}) AS h LEFT JOIN ({_INTENDED}) AS i ON h.primer = i.primer AND h.chrom = i.chrom AND h.start = i.start AND h.stop = i.stop AND h.strand = i.strand")
def intended_hit_match(spark, sf):
    return K.intended_hit_match(rows(spark, sf, _PLACED), rows(spark, sf, _INTENDED))


_ALTS = "SELECT 'p' || l_partkey AS primer, 'C' || l_linenumber AS copy, 'alt' || l_orderkey AS alternative, l_quantity AS tm, 25.0 AS reference_tm FROM lineitem"


@query("alternative_arm", f"WITH d AS (SELECT *, abs(tm - 25) AS distance FROM ({_ALTS})) SELECT primer, copy, min(ROW(distance, alternative))[2] AS alternative, min(distance) AS distance FROM d WHERE distance <= 8 GROUP BY primer, copy")
def alternative_arm(spark, sf):
    return K.alternative_arm(rows(spark, sf, _ALTS), 8)


_FEATURES = "SELECT 'p' || p_partkey AS primer, 'size' AS feature, cast(p_size AS double) AS value FROM part UNION ALL SELECT 'p' || p_partkey, 'price', p_retailprice / 1000 FROM part UNION ALL SELECT 'p' || p_partkey, 'none', 1 FROM part"
_COEF = "SELECT 'size' AS feature, 1 AS degree, 0.5 AS coefficient UNION ALL SELECT 'size', 2, 0.25 UNION ALL SELECT 'price', 3, 2.0"


@query("linear_feature_score", f"SELECT primer, round(sum(coefficient * pow(value, degree)) + 1.5, 6) AS score FROM ({_FEATURES}) AS f JOIN ({_COEF}) AS c ON f.feature = c.feature GROUP BY primer")
def linear_feature_score(spark, sf):
    return K.linear_feature_score(rows(spark, sf, _FEATURES), rows(spark, sf, f"SELECT feature, degree, cast(coefficient AS double) AS coefficient FROM ({_COEF})"), 1.5).withColumn("score", F.round("score", 6))


_PRIMERS = "SELECT 'p' || p_partkey AS primer, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 13 AS start, p_partkey * 13 + 20 AS stop, p_size AS score FROM part"


@query("top_n_per_bin", f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY strand, floor(CASE WHEN strand = '+' THEN stop ELSE start END / 100) ORDER BY score DESC, primer) AS place FROM ({_PRIMERS})) SELECT * FROM b WHERE place <= 2""")
def top_n_per_bin(spark, sf):
    return K.top_n_per_bin(rows(spark, sf, _PRIMERS), 2, 100)


_EXT = "SELECT 'e' || p_partkey AS primer, 'C' || c.k AS copy, 'chr' || (p_partkey % 3 + c.k) AS chrom, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 7 + c.k * p_size AS start, p_partkey * 7 + 20 + c.k * p_size AS stop FROM part CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS c"
_LIG = "SELECT 'l' || p_partkey AS primer, 'C' || c.k AS copy, 'chr' || (p_partkey % 3 + c.k) AS chrom, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 7 + 60 + c.k * p_size AS start, p_partkey * 7 + 80 + c.k * p_size AS stop FROM part CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS c"
_INS = "SELECT 'chr' || (p_partkey % 3) AS chrom, p_partkey * 11 AS pos, p_size % 4 AS size FROM part WHERE p_size % 4 > 0"


@query("pair_primers", f"""WITH p AS (SELECT e.primer AS e_primer, l.primer AS l_primer, e.copy, e.chrom, e.strand, least(e.start, l.start) AS start, greatest(e.stop, l.stop) AS stop FROM ({_EXT}) AS e JOIN ({_LIG}) AS l ON e.copy = l.copy AND e.chrom = l.chrom AND e.strand = l.strand
  WHERE (e.strand = '+' AND e.stop < l.start AND l.start <= e.stop + 300) OR (e.strand = '-' AND l.stop < e.start AND e.start <= l.stop + 300)),
n AS (SELECT DISTINCT p.chrom, p.start, p.stop FROM p), g AS (SELECT n.chrom, n.start, n.stop, sum(i.size)::BIGINT AS inserted FROM n JOIN ({_INS}) AS i ON i.chrom = n.chrom AND i.pos BETWEEN n.start AND n.stop GROUP BY n.chrom, n.start, n.stop),
s AS (SELECT p.*, coalesce(g.inserted, 0) AS inserted, p.stop - p.start + 1 AS size FROM p LEFT JOIN g ON g.chrom = p.chrom AND g.start = p.start AND g.stop = p.stop),
f AS (SELECT * FROM s WHERE size - inserted <= 200 AND (copy <> 'C0' OR size >= 120))
SELECT e_primer, l_primer, copy, chrom, strand, start, stop, inserted, size FROM f WHERE (e_primer, l_primer) IN (SELECT (e_primer, l_primer) FROM f WHERE copy = 'C0')""")
def pair_primers(spark, sf):
    out = K.pair_primers(rows(spark, sf, _EXT), rows(spark, sf, _LIG), rows(spark, sf, _INS), 120, 200, apart=300)
    return out.select("e_primer", "l_primer", "copy", "chrom", "strand", "start", "stop", "inserted", "size")


_PROBES = "SELECT 'm' || p_partkey AS probe, 'chr' || (p_partkey % 3) AS chrom, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 7 AS start, p_partkey * 7 + 100 + p_size AS stop, p_partkey * 7 + 20 AS left_stop, p_partkey * 7 + 80 + p_size AS right_start, p_size AS score, 'gene' || p_partkey % 20 AS gene FROM part"


@query("near_duplicate_filter", f"""WITH p AS ({_PROBES}) SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM p AS o WHERE o.chrom = p.chrom AND o.strand = p.strand AND abs(o.start - p.start) <= 30 AND abs(o.stop - p.stop) <= 30 AND (o.score > p.score OR (o.score = p.score AND o.probe < p.probe)))""")
def near_duplicate_filter(spark, sf):
    return K.near_duplicate_filter(rows(spark, sf, _PROBES), 30)


@query("probe_compatibility", f"""WITH p AS ({_PROBES}), j AS (SELECT a.probe, b.probe AS b_probe, least(a.stop, b.stop) - greatest(a.start, b.start) + 1 AS shared_span,
  greatest(0, least(a.left_stop, b.left_stop) - greatest(a.start, b.start) + 1, least(a.left_stop, b.stop) - greatest(a.start, b.right_start) + 1, least(a.stop, b.left_stop) - greatest(a.right_start, b.start) + 1, least(a.stop, b.stop) - greatest(a.right_start, b.right_start) + 1) AS shared_arm,
  a.strand = b.strand AS same FROM p AS a JOIN p AS b ON a.chrom = b.chrom AND a.start <= b.stop AND b.start <= a.stop AND a.probe < b.probe)
SELECT probe, b_probe, shared_span, shared_arm, CASE WHEN same THEN shared_span <= 50 ELSE shared_arm <= 5 END AS compatible FROM j""")
def probe_compatibility(spark, sf):
    return K.probe_compatibility(rows(spark, sf, _PROBES), 50, 5)


@query("bin_probes", f"SELECT probe, unnest(range(start // 64, stop // 64 + 1)) AS bin FROM ({_PROBES})")
def bin_probes(spark, sf):
    return K.bin_probes(rows(spark, sf, _PROBES), 64).select("probe", "bin")


_FULL = "SELECT 'm' || p_partkey AS probe, 'chr' || (p_partkey % 3) AS chrom, p_partkey * 7 + 20 AS capture_start, p_partkey * 7 + 260 AS capture_end, p_partkey * 7 AS ext_start, p_partkey * 7 + 19 AS ext_end, p_partkey * 7 + 261 AS lig_start, p_partkey * 7 + 285 AS lig_end FROM part"
_GOALS = "SELECT 't' || p_partkey AS name, 'chr' || (p_size % 3) AS chrom, p_partkey * 7 + 50 AS start, p_partkey * 7 + 53 AS stop, CASE WHEN p_size % 4 = 0 THEN 'must' ELSE 'snp' END AS kind FROM part"
_COVERED = f"""cv AS (SELECT p.probe, t.name, t.kind FROM ({_GOALS}) AS t JOIN ({_FULL}) AS p ON t.chrom = p.chrom AND ((t.start >= capture_start AND t.stop <= capture_end AND (t.stop < capture_start + 90 OR t.start > capture_end - 90))
  OR (t.start >= ext_start AND t.stop <= ext_end) OR (t.start >= lig_start AND t.stop <= lig_end)))"""


def _covered(spark, sf):
    return K.capture_targets(rows(spark, sf, _FULL), rows(spark, sf, _GOALS), "any", read_length=110, trim=10, barcode=10)


@query("capture_targets", f"WITH {_COVERED} SELECT * FROM cv")
def capture_targets(spark, sf):
    return _covered(spark, sf)


_CAPTURES = "SELECT 'm' || p_partkey % 500 AS probe, 'C' || p_partkey AS copy, p_brand AS sequence FROM part"


@query("unique_captures", f"SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY probe, sequence) AS n FROM ({_CAPTURES})) WHERE n = 1")
def unique_captures(spark, sf):
    return K.unique_captures(rows(spark, sf, _CAPTURES))


@query("probe_score", f"""WITH {_COVERED}, u AS (SELECT probe, copy FROM (SELECT *, count(*) OVER (PARTITION BY probe, sequence) AS n FROM ({_CAPTURES})) WHERE n = 1),
a AS (SELECT probe, sum(score * 0.5::DOUBLE) AS arms FROM ({_PROBES}) GROUP BY probe), g AS (SELECT probe, sum(CASE kind WHEN 'must' THEN 10 ELSE 3 END)::DOUBLE AS points FROM cv GROUP BY probe), c AS (SELECT probe, count(*) AS n FROM u GROUP BY probe), x AS (SELECT probe, count(*) AS n FROM ({_CAPTURES}) WHERE sequence < 'Brand#3' GROUP BY probe)
SELECT p.probe, round(2000 * (p.score + coalesce(arms, 0)), 0) AS technical, coalesce(points, 0) + 5 * coalesce(c.n, 0) - 2 * coalesce(x.n, 0) AS functional FROM ({_PROBES}) AS p LEFT JOIN a ON a.probe = p.probe LEFT JOIN g ON g.probe = p.probe LEFT JOIN c ON c.probe = p.probe LEFT JOIN x ON x.probe = p.probe""")
def probe_score(spark, sf):
    probes, captures = rows(spark, sf, _PROBES), rows(spark, sf, _CAPTURES)
    points = rows(spark, sf, "SELECT 'must' AS kind, cast(10 AS double) AS points UNION ALL SELECT 'snp', cast(3 AS double)")
    arms = probes.select("probe", (F.col("score") * 0.5).alias("score"))
    return K.probe_score(probes, arms, _covered(spark, sf), points, K.unique_captures(captures), 5.0, captures.where("sequence < 'Brand#3'"), 2.0)


_SETS = "SELECT 'set' || p_partkey % 40 AS set_id, 'm' || p_partkey AS probe FROM part"


@query("probe_set_score", f"""WITH {_COVERED}, s AS ({_SETS}), m AS (SELECT set_id, count(DISTINCT name) AS must FROM s JOIN cv ON s.probe = cv.probe WHERE kind = 'must' GROUP BY set_id), t AS (SELECT set_id, sum(score)::DOUBLE AS scores FROM s JOIN ({_PROBES}) AS p ON p.probe = s.probe GROUP BY set_id),
i AS (SELECT set_id, chrom, start, stop, CASE WHEN start - max(stop) OVER (PARTITION BY set_id, chrom ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 50 THEN 0 ELSE 1 END AS fresh FROM s JOIN ({_PROBES}) AS p ON p.probe = s.probe),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY set_id, chrom ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM i), l AS (SELECT set_id, max(stop) - min(start) + 1 AS n FROM k GROUP BY set_id, chrom, island), c AS (SELECT set_id, sum(n)::BIGINT AS covered FROM l GROUP BY set_id)
SELECT c.set_id, coalesce(must, 0) AS must, coalesce(scores, 0) AS scores, covered, 100 * coalesce(must, 0) + coalesce(scores, 0) AS score FROM c LEFT JOIN m ON m.set_id = c.set_id LEFT JOIN t ON t.set_id = c.set_id""")
def probe_set_score(spark, sf):
    probes = rows(spark, sf, _PROBES)
    scores = probes.select("probe", F.col("score").cast("double").alias("score"))
    return K.probe_set_score(rows(spark, sf, _SETS), _covered(spark, sf), scores, probes.select("probe", "chrom", "start", "stop"), 100.0)


@query("design_summary", f"SELECT 0 AS step, 'all' AS name, count(*) AS rows FROM ({_PRIMERS}) UNION ALL SELECT 1, 'plus', count(*) FROM ({_PRIMERS}) WHERE strand = '+' UNION ALL SELECT 2, 'good', count(*) FROM ({_PRIMERS}) WHERE strand = '+' AND score > 25")
def design_summary(spark, sf):
    p = rows(spark, sf, _PRIMERS)
    return K.design_summary([("all", p), ("plus", p.where("strand = '+'")), ("good", p.where("strand = '+' AND score > 25"))])


# goals of up to 400 bases: a capture has 240
_LONG = _GOALS.replace("p_partkey * 7 + 53 AS stop", "p_partkey * 7 + 50 + p_size * 8 AS stop")


@query("missed_by_design", f"WITH {_COVERED.replace(_GOALS, _LONG)} SELECT * FROM ({_LONG}) WHERE name NOT IN (SELECT name FROM cv)")
def missed_by_design(spark, sf):
    goals = rows(spark, sf, _LONG)
    return K.missed_by_design(goals, K.capture_targets(rows(spark, sf, _FULL), goals, "any", read_length=110, trim=10, barcode=10))


@query("name_probes", f"SELECT probe, gene, start, gene || '_mip' || (row_number() OVER (PARTITION BY gene ORDER BY start, probe) - 1) AS mip_name FROM ({_PROBES})")
def name_probes(spark, sf):
    return K.name_probes(rows(spark, sf, _PROBES)).select("probe", "gene", "start", "mip_name")


@query("select_probes", f"SELECT probe, true AS kept FROM ({_PROBES}) WHERE probe IN (SELECT probe FROM ({_CAPTURES})) UNION ALL SELECT probe, false FROM ({_PROBES}) WHERE probe NOT IN (SELECT probe FROM ({_CAPTURES}))")
def select_probes(spark, sf):
    probes, listed = rows(spark, sf, _PROBES).select("probe"), rows(spark, sf, _CAPTURES)
    kept = K.select_probes(probes, listed).withColumn("kept", F.lit(True))
    return kept.unionByName(K.select_probes(probes, listed, keep=False).withColumn("kept", F.lit(False)))


# --- microhaplotype documents ---------------------------------------------------------------------------------------

_MH = "SELECT sample_id, mip AS locus, haplotype_sequence AS sequence, read_count, umi_count, ord * 100000 + read_count AS ord FROM calls"
_REPS = f"rp AS (SELECT locus, sequence, locus || '.' || (row_number() OVER (PARTITION BY locus ORDER BY min(ord), sequence) - 1) AS microhaplotype_id FROM ({_MH}) GROUP BY locus, sequence)"


_ARMS = "SELECT 'mip' || l_partkey % 40 AS target_id, 'gene' || l_partkey % 40 % 8 AS gene_id, 'F' || l_linenumber AS forward_primer, 'R' || l_suppkey % 3 AS reverse_primer FROM lineitem"


@query("pmo_representatives", f"WITH {_REPS} SELECT * FROM rp")
def pmo_representatives(spark, sf):
    return M.pmo_representatives(rows(spark, sf, _MH))


@query("pmo_detected", f"""WITH {_REPS}, l AS (SELECT sample_id, locus, sequence, max(ROW(ord, read_count, umi_count)) AS r FROM ({_MH}) GROUP BY sample_id, locus, sequence)
SELECT sample_id, l.locus, microhaplotype_id, r[2] AS read_count, r[3] AS umi_count FROM l JOIN rp ON rp.locus = l.locus AND rp.sequence = l.sequence""")
def pmo_detected(spark, sf):
    calls = rows(spark, sf, _MH)
    nested = M.pmo_detected(calls, M.pmo_representatives(calls), ["umi_count"])
    flat = nested.select("sample_id", F.explode("targets").alias("locus", "haplotypes")).select("sample_id", "locus", F.explode("haplotypes").alias("microhaplotype_id", "v"))
    return flat.select("sample_id", "locus", "microhaplotype_id", "v.read_count", "v.umi_count")


@query("write_pmo", f"""WITH {_REPS}, l AS (SELECT sample_id, locus, sequence, max(ROW(ord, read_count, umi_count)) AS r FROM ({_MH}) GROUP BY sample_id, locus, sequence)
SELECT 'detected' AS kind, sample_id || '/' || l.locus || '/' || microhaplotype_id AS name, r[2]::BIGINT AS number FROM l JOIN rp ON rp.locus = l.locus AND rp.sequence = l.sequence
UNION ALL SELECT 'panel', target_id || '/' || min(gene_id), count(DISTINCT forward_primer) * 100 + count(DISTINCT reverse_primer) FROM ({_ARMS}) GROUP BY target_id
UNION ALL SELECT 'representative', microhaplotype_id || '/' || sequence, length(sequence) FROM rp""")
def write_pmo(spark, sf):
    calls, path = rows(spark, sf, _MH), scratch_path(spark, "pmo")
    representatives = M.pmo_representatives(calls)
    detected = M.pmo_detected(calls, representatives, ["umi_count"])
    W.write_pmo(M.pmo_document(M.pmo_panel(rows(spark, sf, _ARMS)), detected, representatives, "panel-1", "run-1"), path)
    long = lambda c: c.cast("long").alias("number")
    found = R.read_pmo(spark, path, "detected", "sample_id string, targets map<string, map<string, struct<read_count: bigint, umi_count: bigint>>>")
    found = found.select("sample_id", F.explode("targets").alias("locus", "haplotypes")).select("sample_id", "locus", F.explode("haplotypes").alias("id", "v"))
    out = found.select(F.lit("detected").alias("kind"), F.concat_ws("/", "sample_id", "locus", "id").alias("name"), long(F.col("v.read_count")))
    panel = R.read_pmo(spark, path, "panel", "target_id string, gene_id string, forward_primers array<string>, reverse_primers array<string>")
    out = out.unionByName(panel.select(F.lit("panel").alias("kind"), F.concat_ws("/", "target_id", "gene_id").alias("name"), long(F.size("forward_primers") * 100 + F.size("reverse_primers"))))
    names = R.read_pmo(spark, path, "representative", "locus string, sequence string, microhaplotype_id string")
    return out.unionByName(names.select(F.lit("representative").alias("kind"), F.concat_ws("/", "microhaplotype_id", "sequence").alias("name"), long(F.length("sequence"))))


@query("pmo_panel", f"SELECT target_id, min(gene_id) AS gene_id, list_sort(list(DISTINCT forward_primer)) AS forward_primers, list_sort(list(DISTINCT reverse_primer)) AS reverse_primers FROM ({_ARMS}) GROUP BY target_id")
def pmo_panel(spark, sf):
    return M.pmo_panel(rows(spark, sf, _ARMS))


@query("pmo_checks", f"SELECT target_id, 'reverse_primer' AS attribute, count(DISTINCT reverse_primer) AS \"values\" FROM ({_ARMS}) GROUP BY target_id HAVING count(DISTINCT reverse_primer) > 1")
def pmo_checks(spark, sf):
    return M.pmo_checks(rows(spark, sf, _ARMS), ["gene_id", "reverse_primer"], ["chrom", "start"], ["target_id"])
