"""Queries for operators/intervals.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from .registry import query, rows


def _islands(source: str, spacer: int, name: str, keys: str = "chrom") -> str:
    return f"""{name}_f AS (SELECT *, CASE WHEN start - max(stop) OVER (PARTITION BY {keys} ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {spacer} THEN 0 ELSE 1 END AS fresh FROM {source}),
{name}_i AS (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM {name}_f),
{name} AS (SELECT {keys}, min(start) AS start, max(stop) AS stop, count(*) AS n FROM {name}_i GROUP BY {keys}, island)"""


_PROBES = "SELECT mip || copy AS name, chrom, capture_start AS start, capture_end AS stop FROM probe_copies"
_T = "SELECT name, chrom, start, stop FROM targets"


@query("merge_intervals", f"WITH {_islands('intervals', 20, 'm')} SELECT * FROM m")
def merge_intervals(spark, sf):
    return I.merge_intervals(rows(spark, sf, "intervals"), 20, bin_size=50_000)


_PAIRS = "SELECT t.chrom, t.name, t.start, t.stop, i.start AS b_start, i.stop AS b_stop FROM targets AS t JOIN intervals AS i ON t.chrom = i.chrom AND t.start <= i.stop + {p} AND i.start - {p} <= t.stop"


@query("overlap_join", _PAIRS.format(p=5))
def overlap_join(spark, sf):
    return I.overlap_join(rows(spark, sf, _T), rows(spark, sf, "intervals"), padding=5, bin_size=500)


@query("intersect_intervals", f"SELECT *, greatest(start, b_start) AS common_start, least(stop, b_stop) AS common_stop FROM ({_PAIRS.format(p=0)})")
def intersect_intervals(spark, sf):
    return I.intersect_intervals(rows(spark, sf, _T), rows(spark, sf, "intervals"), bin_size=500)


@query("remove_overlap", f"""WITH p AS ({_PAIRS.format(p=0)}), x AS (SELECT *, least(start, b_start) AS part_start, greatest(start, b_start) - 1 AS part_stop FROM p UNION ALL SELECT *, least(stop, b_stop) + 1, greatest(stop, b_stop) FROM p)
SELECT * FROM x WHERE part_start <= part_stop""")
def remove_overlap(spark, sf):
    return I.remove_overlap(I.overlap_join(rows(spark, sf, _T), rows(spark, sf, "intervals"), bin_size=500))


@query("contains", f"SELECT *, (start <= b_start AND stop >= b_stop) OR (b_start <= start AND b_stop >= stop) AS contained, ((start <= b_start AND stop >= b_stop) OR (b_start <= start AND b_stop >= stop)) OR abs(start - b_start) + abs(stop - b_stop) <= 15 AS redundant FROM ({_PAIRS.format(p=0)})")
def contains(spark, sf):
    pairs = I.overlap_join(rows(spark, sf, _T), rows(spark, sf, "intervals"), bin_size=500)
    return pairs.withColumns({"contained": I.contains(), "redundant": I.redundant(15)})


# the first halves of all intervals, so that parts of targets stay open
_COVERED = "SELECT chrom, start, cast(floor((start + stop) / 2) AS bigint) AS stop FROM intervals"
_SUBTRACT = f"""c0 AS ({_COVERED}), {_islands('targets', 1, 'u')}, {_islands('c0', 1, 'c')},
k AS (SELECT u.chrom, u.start AS ws, u.stop AS we, c.start AS cut, c.stop AS resume FROM u JOIN c ON u.chrom = c.chrom AND u.start <= c.stop AND c.start <= u.stop UNION ALL SELECT chrom, start, stop, start - 1, start - 1 FROM u),
sb AS (SELECT chrom, resume + 1 AS start, coalesce(lead(cut) OVER (PARTITION BY chrom, ws ORDER BY cut, resume), we + 1) - 1 AS stop FROM k)"""


@query("subtract_intervals", f"WITH {_SUBTRACT} SELECT * FROM sb WHERE stop - start > 3")
def subtract_intervals(spark, sf):
    return I.subtract_intervals(rows(spark, sf, _T), rows(spark, sf, _COVERED), 3, bin_size=500)


@query("missed_targets", f"""WITH {_SUBTRACT}, l AS (SELECT * FROM sb WHERE stop - start > 0 AND stop - start + 1 >= 10)
SELECT l.chrom, l.start, l.stop, string_agg(DISTINCT t.name, ',' ORDER BY t.name) AS names FROM l JOIN targets AS t ON l.chrom = t.chrom AND l.start <= t.stop AND t.start <= l.stop GROUP BY l.chrom, l.start, l.stop""")
def missed_targets(spark, sf):
    return I.missed_targets(rows(spark, sf, _T), rows(spark, sf, _COVERED), 10)


_ALL = "SELECT chrom, start, stop FROM intervals"
_SUBTRACT_ALL = _SUBTRACT.replace(_COVERED, _ALL)


@query("subtract_intervals_whole", f"WITH {_SUBTRACT_ALL} SELECT * FROM sb WHERE stop - start > 3")
def subtract_intervals_whole(spark, sf):
    return I.subtract_intervals(rows(spark, sf, _T), rows(spark, sf, _ALL), 3, bin_size=500)


@query("missed_targets_whole", f"""WITH {_SUBTRACT_ALL}, l AS (SELECT * FROM sb WHERE stop - start > 0 AND stop - start + 1 >= 10)
SELECT l.chrom, l.start, l.stop, string_agg(DISTINCT t.name, ',' ORDER BY t.name) AS names FROM l JOIN targets AS t ON l.chrom = t.chrom AND l.start <= t.stop AND t.start <= l.stop GROUP BY l.chrom, l.start, l.stop""")
def missed_targets_whole(spark, sf):
    return I.missed_targets(rows(spark, sf, _T), rows(spark, sf, _ALL), 10)


@query("trim_overlaps", None)
def trim_overlaps(spark, sf):
    return I.trim_overlaps(rows(spark, sf, "intervals"), bin_size=500)


@query("region_string", "SELECT name, chrom || ':' || start || '-' || stop AS region FROM targets")
def region_string(spark, sf):
    return rows(spark, sf, "targets").select("name", I.region_string(F.col("chrom"), F.col("start"), F.col("stop")).alias("region"))


@query("parse_region", "SELECT name, chrom, start, stop FROM targets")
def parse_region(spark, sf):
    text = rows(spark, sf, "SELECT name, chrom || ':' || start || '-' || stop AS region FROM targets")
    return text.select("name", I.parse_region(F.col("region")).alias("r")).select("name", "r.*")


_POINTS = "SELECT DISTINCT chrom, start AS pos, 'rs' || start AS id, CASE WHEN start % 4 = 0 THEN '.' ELSE '0.' || start % 10 END AS af FROM intervals"


@query("query_region_sites", f"SELECT p.chrom, pos, id, coalesce(try_cast(af AS DOUBLE), 0) AS af, t.name AS b_name, t.start AS b_start, t.stop AS b_stop FROM ({_POINTS}) AS p JOIN targets AS t ON p.chrom = t.chrom AND pos BETWEEN t.start AND t.stop")
def query_region_sites(spark, sf):
    return I.query_region_sites(rows(spark, sf, _POINTS), rows(spark, sf, _T))


@query("ucsc_snp_frequencies", "SELECT p_partkey, p_partkey * 10 + 1 AS pos, CASE WHEN p_partkey % 2 = 0 THEN ['T', 'C'] ELSE ['A', 'G'] END AS alleles, (p_size + 7.0::DOUBLE - CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size END) / (p_size + 7.0::DOUBLE) AS maf FROM part")
def ucsc_snp_frequencies(spark, sf):
    snps = rows(spark, sf, "SELECT p_partkey, p_size, p_partkey * 10 AS chrom_start, CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE '+' END AS strand FROM part")
    snps = snps.withColumns({"ref": F.lit("A"), "alleles": F.array(F.lit("A"), F.lit("G")), "counts": F.array(F.col("p_size").cast("double"), F.lit(7.0))})
    return I.ucsc_snp_frequencies(snps).select("p_partkey", "pos", "alleles", "maf")


def _transcripts(spark, sf):
    return rows(spark, sf, "transcripts").withColumns({"exon_starts": F.array("e0", "e1", "e2"), "exon_ends": F.array("f0", "f1", "f2")})


_EXONS = f"""s AS (SELECT * FROM exon_rows WHERE length(chrom) < 6), o AS (SELECT gene FROM s GROUP BY gene HAVING count(DISTINCT chrom) = 1),
e0 AS (SELECT gene, chrom, strand, start, stop FROM s WHERE gene IN (SELECT gene FROM o)), {_islands('e0', 0, 'ex', 'gene, chrom, strand')}"""


@query("gene_exons", f"WITH {_EXONS} SELECT gene, chrom, strand, start, stop FROM ex")
def gene_exons(spark, sf):
    return I.gene_exons(_transcripts(spark, sf))


@query("gene_targets", f"WITH {_EXONS} SELECT gene, chrom, min(start) AS start, max(stop) AS stop FROM ex GROUP BY gene, chrom")
def gene_targets(spark, sf):
    return I.gene_targets(_transcripts(spark, sf))


@query("exon_targets", f"WITH {_EXONS} SELECT gene || '-exon-' || (row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -stop ELSE start END) - 1) AS name, gene, chrom, start, stop FROM ex")
def exon_targets(spark, sf):
    return I.exon_targets(_transcripts(spark, sf))


@query("genes_in_region", "SELECT DISTINCT g.name, gene FROM transcripts AS t JOIN targets AS g ON g.chrom = t.chrom AND tx_start + 1 <= g.stop AND g.start <= tx_end")
def genes_in_region(spark, sf):
    return I.genes_in_region(_transcripts(spark, sf), rows(spark, sf, _T))


_CDS = f"""{_EXONS}, b AS (SELECT gene, min(ROW(name, cds_start, cds_end))[2] + 1 AS lo, min(ROW(name, cds_start, cds_end))[3] AS hi FROM transcripts GROUP BY gene),
q AS (SELECT ex.gene, chrom, strand, unnest(range(greatest(start, lo), least(stop, hi) + 1)) AS pos FROM ex JOIN b ON ex.gene = b.gene),
cds AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -pos ELSE pos END) - 1 AS cds_pos FROM q)"""


@query("cds_positions", f"WITH {_CDS} SELECT * FROM cds")
def cds_positions(spark, sf):
    return I.cds_positions(_transcripts(spark, sf))


@query("aa_to_coordinate", f"""WITH {_CDS}, r AS (SELECT DISTINCT gene, cast(length(gene) * 10 AS bigint) AS aa_start, cast(length(gene) * 10 + 1 AS bigint) AS aa_stop FROM transcripts)
SELECT r.gene, aa_start, aa_stop, f.chrom, f.strand, least(f.pos, l.pos) AS start, greatest(f.pos, l.pos) AS stop FROM r LEFT JOIN cds AS f ON f.gene = r.gene AND f.cds_pos = aa_start * 3 - 3 LEFT JOIN cds AS l ON l.gene = r.gene AND l.cds_pos = aa_stop * 3 - 1""")
def aa_to_coordinate(spark, sf):
    ranges = rows(spark, sf, "SELECT DISTINCT gene, cast(length(gene) * 10 AS bigint) AS aa_start, cast(length(gene) * 10 + 1 AS bigint) AS aa_stop FROM transcripts")
    return I.aa_to_coordinate(ranges, I.cds_positions(_transcripts(spark, sf)))


_PRIOR = "SELECT name, chrom, start, stop, CASE WHEN start % 3 = 0 THEN 0 ELSE 1 END AS priority FROM targets"


@query("merge_targets", f"""WITH t AS ({_PRIOR}), {_islands('t', 400, 'm')}
SELECT regexp_replace(min(ROW(priority, t.start, name))[3], '[^A-Za-z0-9-]', '-', 'g') AS label, m.chrom, m.start, m.stop, string_agg(DISTINCT name, ',' ORDER BY name) AS names
FROM m JOIN t ON m.chrom = t.chrom AND m.start <= t.stop AND t.start <= m.stop GROUP BY m.chrom, m.start, m.stop""")
def merge_targets(spark, sf):
    return I.merge_targets(rows(spark, sf, _PRIOR), 200)


_SNPS = "SELECT 'rs' || l_partkey % 500 AS rsid, CASE WHEN l_linenumber = 1 THEN 'chr1_alt' ELSE 'chr' || l_linenumber END AS chrom, l_partkey % 500 * 10 AS pos, 'A' AS ref, CASE WHEN l_suppkey % 2 = 0 THEN 'C' ELSE 'G' END AS alt FROM lineitem"


@query("snp_targets", f"""WITH a AS (SELECT rsid, chrom, pos, ref, string_agg(DISTINCT alt, ',' ORDER BY alt) AS alts FROM ({_SNPS}) GROUP BY rsid, chrom, pos, ref)
SELECT *, row_number() OVER (PARTITION BY rsid ORDER BY contains(chrom, '_'), chrom, pos) - 1 AS location FROM a""")
def snp_targets(spark, sf):
    return I.snp_targets(rows(spark, sf, _SNPS))


@query("unresolved_snps", f"SELECT DISTINCT 'rs' || p_partkey AS rsid FROM part WHERE 'rs' || p_partkey NOT IN (SELECT rsid FROM ({_SNPS}) WHERE NOT contains(chrom, '_'))")
def unresolved_snps(spark, sf):
    return I.unresolved_snps(rows(spark, sf, "SELECT 'rs' || p_partkey AS rsid FROM part"), rows(spark, sf, _SNPS))


@query("snp_region_targets", f"SELECT DISTINCT rsid, chrom, pos, greatest(1, pos - 50) AS start, pos + 50 AS stop FROM ({_SNPS})")
def snp_region_targets(spark, sf):
    return I.snp_region_targets(rows(spark, sf, _SNPS).select("rsid", "chrom", "pos").distinct(), 50)


_REGIONS = "SELECT l_partkey AS number, 'target' || l_partkey AS name, 'chr' || (l_suppkey % 14 + 1) AS chrom, l_partkey * 100 + l_linenumber * 7 AS start, l_partkey * 100 + l_linenumber * 7 + cast(l_quantity AS bigint) + 12 AS stop FROM lineitem"


@query("group_overlapping_targets", f"""WITH RECURSIVE r AS (SELECT DISTINCT number, chrom, start, stop FROM ({_REGIONS})),
e AS (SELECT DISTINCT a.number AS a, b.number AS b FROM r AS a JOIN r AS b ON a.chrom = b.chrom AND a.start <= b.stop AND b.start <= a.stop AND a.number <> b.number),
w AS (SELECT number AS root, number AS node FROM (SELECT DISTINCT number FROM r) UNION SELECT root, e.b FROM w JOIN e ON w.node = e.a)
SELECT root AS number, 'target' || root AS name, min(node) AS group_id FROM w GROUP BY root""")
def group_overlapping_targets(spark, sf):
    return I.group_overlapping_targets(rows(spark, sf, _REGIONS))


_COPYROWS = "SELECT 'g' || p_partkey % 50 AS group_name, 'C' || p_size % 20 AS copy, 'chr1' AS chrom, p_partkey * 10 AS start, p_partkey * 10 + 5 AS stop FROM part"


@query("split_multi_aligned_copies", f"""SELECT *, CASE WHEN count(*) OVER w > 1 THEN copy || '-' || (row_number() OVER (PARTITION BY group_name, copy ORDER BY chrom, start, stop) - 1) ELSE copy END AS copy_name
FROM ({_COPYROWS}) WINDOW w AS (PARTITION BY group_name, copy)""")
def split_multi_aligned_copies(spark, sf):
    return I.split_multi_aligned_copies(rows(spark, sf, _COPYROWS))


_EXPECT = "SELECT DISTINCT 'g' || p_partkey % 50 AS group_name, 'C' || p_partkey % 23 AS copy FROM part"


@query("missing_copies", f"SELECT * FROM ({_EXPECT}) AS e WHERE NOT EXISTS (SELECT 1 FROM ({_COPYROWS}) AS c WHERE c.group_name = e.group_name AND c.copy = e.copy)")
def missing_copies(spark, sf):
    return I.missing_copies(rows(spark, sf, _EXPECT), rows(spark, sf, _COPYROWS))


_ALIGNED = "SELECT 'aln' || p_partkey AS name, p_partkey * 7 AS a_start, p_partkey * 9 AS b_start, translate(cast(p_partkey * 1234567 AS string), '0123456789', 'AC-TA-GGTC') AS a_aligned, translate(cast(p_partkey * 1234567 AS string), '0123456789', 'A-GTACG-TC') AS b_aligned FROM part"
_CELLS = f"z AS (SELECT *, unnest(range(length(a_aligned))) AS \"column\" FROM ({_ALIGNED})), y AS (SELECT name, \"column\", a_start, b_start, substr(a_aligned, \"column\" + 1, 1) AS a, substr(b_aligned, \"column\" + 1, 1) AS b FROM z)"


@query("msa_position_map", f"""WITH {_CELLS} SELECT name, "column"::INT AS "column", a AS base, CASE WHEN a <> '-' THEN a_start + sum((a <> '-')::INT) OVER (PARTITION BY name ORDER BY "column")::BIGINT - 1 END AS pos FROM y""")
def msa_position_map(spark, sf):
    table = rows(spark, sf, _ALIGNED).select("name", F.col("a_start").alias("start"), F.col("a_aligned").alias("aligned"))
    return I.msa_position_map(table)


_MAP = f"""{_CELLS}, pm AS (SELECT name, "column"::INT AS "column", CASE WHEN a <> '-' THEN a_start + sum((a <> '-')::INT) OVER w::BIGINT - 1 END AS a_pos,
  CASE WHEN b <> '-' THEN b_start + sum((b <> '-')::INT) OVER w::BIGINT - 1 END AS b_pos, a <> b AS differs FROM y WINDOW w AS (PARTITION BY name ORDER BY "column"))"""


@query("paralog_coordinate_map", f"WITH {_MAP} SELECT * FROM pm")
def paralog_coordinate_map(spark, sf):
    return I.paralog_coordinate_map(rows(spark, sf, _ALIGNED))


@query("projected_exons", f"""WITH {_MAP}, h AS (SELECT pm.name, a_pos AS start, a_pos AS stop FROM pm JOIN ({_ALIGNED}) AS x ON pm.name = x.name WHERE a_pos IS NOT NULL AND b_pos BETWEEN x.b_start + 2 AND x.b_start + 6),
{_islands('h', 1, 'm', 'name')} SELECT name, start, stop FROM m""")
def projected_exons(spark, sf):
    table = rows(spark, sf, _ALIGNED)
    exons = table.select("name", (F.col("b_start") + 2).alias("start"), (F.col("b_start") + 6).alias("stop"))
    return I.projected_exons(exons, I.paralog_coordinate_map(table))


@query("contig_regions", f"""WITH p AS ({_PROBES}), {_islands('p', 1000, 'm')}, c AS (SELECT m.chrom, start, stop, m.chrom || '_' || (row_number() OVER (PARTITION BY m.chrom ORDER BY start) - 1) AS contig_name FROM m)
SELECT contig_name, chrom, start, stop, chrom || ':' || greatest(1, start - 500) || '-' || least(stop + 500, 85000) AS region,
  EXISTS (SELECT 1 FROM p WHERE p.chrom = c.chrom AND p.name LIKE '%3C0' AND p.start + 5 BETWEEN c.start AND c.stop) AS contains_targets FROM c""")
def contig_regions(spark, sf):
    probes = rows(spark, sf, _PROBES)
    lengths = probes.select("chrom", F.lit(85000).cast("bigint").alias("length")).distinct()
    return I.contig_regions(probes, lengths, probes.where("name LIKE '%3C0'").select("chrom", (F.col("start") + 5).alias("pos")))


@query("padded_bed", f"SELECT chrom, start - 200 AS start, stop + 200 AS stop, name FROM ({_PROBES})")
def padded_bed(spark, sf):
    return I.padded_bed(rows(spark, sf, _PROBES))


_CHUNK = "translate(cast(100000 + k AS string), '0123456789', 'ACGTTGCAAC') || translate(cast(900000 - k AS string), '0123456789', 'CAAGTTGCAA') || 'ACGTACGT'"
_GENOME = f"SELECT 'chr' || c.c AS chrom, k AS chunk, {_CHUNK} AS seq FROM (SELECT DISTINCT p_partkey AS k FROM part) AS p CROSS JOIN (SELECT DISTINCT l_linenumber AS c FROM lineitem) AS c"
_WHERE = "SELECT 'r' || p_partkey AS name, 'chr' || (p_partkey % 7 + 1) AS chrom, p_partkey * 10 + 5 AS start, p_partkey * 10 + 5 + p_size AS stop FROM part"


@query("region_sequences", f"""WITH g AS ({_GENOME}), w AS ({_WHERE}), x AS (SELECT w.*, unnest(range((start - 1) // 20, (stop - 1) // 20 + 1)) AS chunk FROM w)
SELECT name, x.chrom, start, stop, string_agg(substr(seq, greatest(start - x.chunk * 20, 1)::INT, (least(stop - x.chunk * 20, 20) - greatest(start - x.chunk * 20, 1) + 1)::INT), '' ORDER BY x.chunk) AS sequence
FROM x JOIN g ON x.chrom = g.chrom AND x.chunk = g.chunk GROUP BY name, x.chrom, start, stop""")
def region_sequences(spark, sf):
    return I.region_sequences(rows(spark, sf, _WHERE), rows(spark, sf, _GENOME), 20)


_VAR1 = "SELECT DISTINCT chrom, start AS pos, CASE WHEN start % 2 = 0 THEN 'AC' ELSE 'A' END AS ref, CASE WHEN start % 2 = 0 THEN 'GC' ELSE 'T' END AS alt, 'b-snp' AS source FROM intervals"
_VAR2 = "SELECT DISTINCT chrom, start AS pos, 'A' AS ref, CASE WHEN start % 3 = 0 THEN 'G' ELSE 'AT' END AS alt, 'a-paralog' AS source FROM targets"


@query("locus_variants", f"""WITH v AS (SELECT * FROM ({_VAR1}) UNION ALL SELECT * FROM ({_VAR2})), s AS (SELECT chrom, pos, substr(ref, 1, 1) AS ref, substr(alt, 1, 1) AS alt, source FROM v WHERE length(ref) = 2
UNION ALL SELECT chrom, pos, ref, alt, source FROM v WHERE length(ref) = 1) SELECT chrom, pos, ref, alt, min(source) AS source FROM s WHERE ref <> alt GROUP BY chrom, pos, ref, alt""")
def locus_variants(spark, sf):
    return I.locus_variants(rows(spark, sf, _VAR1), rows(spark, sf, _VAR2))


_SUBT = "SELECT 'reg' || start % 5 AS region, chrom, start, stop, capture_type FROM targets"
_SUBE = "SELECT 'reg' || start % 5 AS region, chrom, start, stop FROM intervals"


@query("subregions", f"""WITH t AS ({_SUBT}), e AS ({_SUBE}), a AS (SELECT region, capture_type, chrom, start, stop FROM t WHERE capture_type <> 'exons'
UNION ALL SELECT region, 'exons', chrom, start, stop FROM e WHERE region IN (SELECT region FROM t WHERE capture_type = 'exons')
UNION ALL SELECT region, capture_type, chrom, start, stop FROM t WHERE capture_type = 'exons' AND NOT EXISTS (SELECT 1 FROM e WHERE e.region = t.region AND e.chrom = t.chrom AND e.start <= t.stop AND t.start <= e.stop)),
{_islands('a', 60, 'm', 'region, capture_type, chrom')} SELECT region, capture_type, chrom, start, stop FROM m""")
def subregions(spark, sf):
    return I.subregions(rows(spark, sf, _SUBT), rows(spark, sf, _SUBE), 30)


_TEMPLATES = "SELECT 'r' || p_partkey AS name, 'chr' || (p_partkey % 14 + 1) AS chrom, p_partkey * 100 AS start, repeat('ACGTTGCA', 10) AS sequence FROM part"


@query("mask_positions", f"""WITH t AS ({_TEMPLATES}), b AS (SELECT name, chrom, unnest(range(80)) AS i, start, sequence FROM t),
m AS (SELECT DISTINCT chrom, start AS pos FROM intervals)
SELECT name, string_agg(CASE WHEN m.pos IS NULL THEN substr(sequence, i + 1, 1) ELSE lower(substr(sequence, i + 1, 1)) END, '' ORDER BY i) AS masked FROM b LEFT JOIN m ON m.chrom = b.chrom AND m.pos = b.start + i GROUP BY name""")
def mask_positions(spark, sf):
    return I.mask_positions(rows(spark, sf, _TEMPLATES), rows(spark, sf, "SELECT chrom, start AS pos FROM intervals"))


@query("excluded_ranges", f"""WITH t AS ({_TEMPLATES}), h AS (SELECT DISTINCT t.name, t.chrom, i.start AS start, i.start AS stop FROM t JOIN intervals AS i ON i.chrom = t.chrom AND i.start BETWEEN t.start AND t.start + 79),
{_islands('h', 17, 'm', 'name, chrom')} SELECT name, chrom, start, stop FROM m""")
def excluded_ranges(spark, sf):
    return I.excluded_ranges(rows(spark, sf, _TEMPLATES), rows(spark, sf, "SELECT chrom, start AS pos FROM intervals"))
