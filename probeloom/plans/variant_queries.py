"""Queries for operators/variants.py and operators/genotypes.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import genotypes as G
from ..operators import variants as V
from ..scratch import scratch_path
from ..sources import readers as R
from ..sources import writers as W
from ..sources.region_index import read_region, write_indexed
from .registry import query, rows

_VARIANTS = "SELECT DISTINCT variant FROM depths"


@query("split_multiallelic", """
WITH s AS (SELECT *, unnest(string_split(alt, ',')) AS a, generate_subscripts(string_split(alt, ','), 1) AS i FROM site_calls),
x AS (SELECT *, string_split(ao, ',')[i]::DOUBLE AS ao1, string_split(qa, ',')[i]::DOUBLE AS qa1, CASE WHEN gt LIKE '%.%' THEN NULL ELSE len(list_filter(string_split(gt, '/'), lambda g: g = i::VARCHAR)) END AS genotype FROM s)
SELECT chrom, CASE WHEN ref = 'AC' THEN pos ELSE pos END AS pos, CASE WHEN ref = 'AGT' THEN 'AGT' ELSE ref END AS ref, a AS alt, sample_id, ao1 AS ao, qa1 AS qa, genotype::INT AS genotype FROM x""")
def split_multiallelic(spark, sf):
    return V.split_multiallelic(rows(spark, sf, "site_calls")).select("chrom", "pos", "ref", "alt", "sample_id", "ao", "qa", "genotype")


# a genome of pieces of 100 bases that repeat a word of four, and a site in the middle of each: an insertion or deletion of a word, or a substitution
_WORD = "translate(lpad(cast({c} AS string), 4, '0'), '0123456789', 'ACGTTGCAAC')"
_INDELS = f"""SELECT chrom, start + 50 AS pos, substr(w, 2, CASE WHEN k = 0 THEN 5 ELSE 1 END) AS ref, CASE k WHEN 0 THEN substr(w, 2, 1) WHEN 1 THEN substr(w, 2, 5) ELSE 'N' END AS alt
FROM (SELECT chrom, start, repeat({_WORD.format(c='cast(floor(start / 100) AS bigint) % 10000')}, 4) AS w, cast(start / 100 AS bigint) % 3 AS k FROM targets)"""
_BASE = f"substr({_WORD.format(c='((p - 1) // 100) % 10000')}, ((p - 1) % 100 % 4 + 1)::INT, 1)"


@query("left_align", f"""WITH RECURSIVE s AS ({_INDELS}), m AS (
SELECT chrom, pos, ref, alt, pos AS p, substr(ref || alt, CASE WHEN length(ref) > 1 THEN 2 ELSE 3 END, 4) AS x FROM s WHERE length(ref) <> length(alt)
UNION ALL SELECT chrom, pos, ref, alt, p - 1, {_BASE} || substr(x, 1, 3) FROM m WHERE p > 1 AND {_BASE} = substr(x, 4, 1)),
e AS (SELECT chrom, pos, ref, alt, arg_min(ROW(p, x, {_BASE}), p) AS r FROM m GROUP BY chrom, pos, ref, alt)
SELECT chrom, pos, ref, alt, r[1]::BIGINT AS new_pos, CASE WHEN length(ref) > 1 THEN r[3] || r[2] ELSE r[3] END AS new_ref, CASE WHEN length(ref) > 1 THEN r[3] ELSE r[3] || r[2] END AS new_alt FROM e
UNION ALL SELECT DISTINCT chrom, pos, ref, alt, pos, ref, alt FROM s WHERE length(ref) = length(alt)""")
def left_align(spark, sf):
    places = rows(spark, sf, "SELECT chrom, cast(max(floor(start / 100)) AS bigint) + 2 AS n FROM targets GROUP BY chrom")
    contigs = places.select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("chunk")).withColumn("seq", F.repeat(F.expr(_WORD.format(c="chunk % 10000")), 25))
    return V.left_align(rows(spark, sf, _INDELS), contigs, 100, window=30)


@query("drop_reference_blocks", "SELECT chrom, pos, sample_id FROM site_calls WHERE alt <> 'A'")
def drop_reference_blocks(spark, sf):
    sites = rows(spark, sf, "site_calls").withColumn("alt", F.when(F.col("alt") == "A", "<*>").otherwise(F.col("alt")))
    return V.drop_reference_blocks(sites).select("chrom", "pos", "sample_id")


_SITES = "SELECT DISTINCT chrom, pos, ref, string_split(alt, ',')[1] AS alt, CAST(pos % 11 AS BIGINT) AS ac, CAST(pos % 11 + 20 AS BIGINT) AS an FROM site_calls"


def _sites(spark, sf):
    return rows(spark, sf, "SELECT DISTINCT chrom, pos, ref, split(alt, ',')[0] AS alt, CAST(pos % 11 AS BIGINT) AS ac, CAST(pos % 11 + 20 AS BIGINT) AS an FROM site_calls")


_POSITIONS = f"""v AS ({_SITES}),
p AS (SELECT chrom, pos, ref, alt, 'malformed' AS kind, ac, an FROM v WHERE length(ref) = 2
UNION ALL SELECT chrom, pos, ref, alt, 'substitution', ac, an FROM v WHERE length(ref) = 1 AND length(alt) = 1
UNION ALL SELECT chrom, pos + unnest([0, 1]), '-', alt[2:], 'insertion', ac, an FROM v WHERE length(ref) = 1 AND length(alt) = 3
UNION ALL SELECT chrom, pos + unnest([1, 2]), unnest([ref[2], ref[3]]), '-', 'deletion', ac, an FROM v WHERE length(ref) = 3)"""


@query("variant_positions", f"WITH {_POSITIONS} SELECT * FROM p")
def variant_positions(spark, sf):
    return V.variant_positions(_sites(spark, sf))


@query("collapse_positions", f"WITH {_POSITIONS} SELECT chrom, pos, sum(ac)::BIGINT AS ac, max(an) AS an, min(ROW(ref, alt))[1] AS ref, min(ROW(ref, alt))[2] AS alt FROM p GROUP BY chrom, pos")
def collapse_positions(spark, sf):
    return V.collapse_positions(V.variant_positions(_sites(spark, sf)))


@query("allele_count_strings", f"WITH v AS ({_SITES}) SELECT *, pos - 1 AS start, ref || ',' || alt || ',' AS alleles, (an - ac) || ',' || ac || ',' AS counts FROM v")
def allele_count_strings(spark, sf):
    return V.allele_count_strings(_sites(spark, sf))


@query("write_ucsc_table", f"""WITH v AS ({_SITES}) SELECT 585 AS bin, chrom, pos - 1 AS "chromStart", pos AS "chromEnd", chrom || ':' || pos AS name, 0 AS score, '+' AS strand, ref AS "refNCBI", ref AS "refUCSC",
  ref || '/' || alt AS observed, 'genomic' AS "molType", 'single' AS class, 'unknown' AS valid, 0 AS "avHet", 0 AS "avHetSE", 'unknown' AS func, 'exact' AS "locType", 1 AS weight, '' AS exceptions,
  1 AS "submitterCount", '' AS submitters, 2 AS "alleleFreqCount", ref || ',' || alt || ',' AS alleles, (an - ac) || ',' || ac || ',' AS "alleleNs" FROM v""")
def write_ucsc_table(spark, sf):
    return V.ucsc_table(_sites(spark, sf))


@query("ucsc_region", f"""WITH v AS ({_SITES}) SELECT chrom, pos - 1 AS "chromStart", pos AS "chromEnd", chrom || ':' || pos AS name, ref || '/' || alt AS observed, ref || ',' || alt || ',' AS alleles, (an - ac) || ',' || ac || ',' AS "alleleNs"
FROM v WHERE chrom = 'chr5' AND pos BETWEEN 1501 AND 4500""")
def ucsc_region(spark, sf):
    """The whole table written sorted and indexed, and one region of it read back."""
    table, path = V.ucsc_table(_sites(spark, sf)), scratch_path(spark, "ucsc")
    write_indexed(table, path, "chrom", "chromStart", "chromEnd")
    back = read_region(spark, path, dict(table.dtypes), "chrom", "chromStart", "chromEnd", ("chr5", 1500, 4500))
    return back.select("chrom", "chromStart", "chromEnd", "name", "observed", "alleles", "alleleNs")


@query("filter_vcf", "SELECT chrom, pos, sample_id, filter FROM site_calls WHERE NOT filter LIKE '%LowQual%'")
def filter_vcf(spark, sf):
    return V.filter_vcf(rows(spark, sf, "site_calls"), ["LowQual", "Other"]).select("chrom", "pos", "sample_id", "filter")


@query("info_site_filter", "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE (l_quantity >= 20 AND l_discount >= 0.05 AND l_tax >= 0.03) OR l_returnflag <> 'N'")
def info_site_filter(spark, sf):
    sites = rows(spark, sf, "SELECT *, CASE WHEN l_returnflag = 'N' THEN '.' ELSE l_returnflag END AS ot FROM lineitem")
    return V.info_site_filter(sites, {"l_quantity": 20, "l_discount": 0.05, "l_tax": 0.03}).select("l_orderkey", "l_partkey", "l_linenumber")


@query("parse_annotation", """
SELECT chrom, pos, sample_id, string_split(ann, '|')[2] AS effect, string_split(ann, '|')[5] AS gene_id, CASE WHEN string_split(ann, '|')[5] < 'ID5' THEN 'gene' || string_split(ann, '|')[5] ELSE string_split(ann, '|')[5] END AS gene,
  regexp_replace(string_split(ann, '|')[11], '^p\\.', '') AS aa_change FROM site_calls""")
def parse_annotation(spark, sf):
    genes = spark.range(5).select(F.concat(F.lit("ID"), "id").alias("gene_id")).withColumn("gene_name", F.concat(F.lit("gene"), "gene_id"))
    return V.parse_annotation(rows(spark, sf, "site_calls"), genes).select("chrom", "pos", "sample_id", "effect", "gene_id", "gene", "aa_change")


@query("allele_depths", "SELECT sample_id, variant, CASE WHEN coverage % 2 = 0 THEN ref + 1 ELSE ref END::DOUBLE AS ro, CASE WHEN coverage % 2 = 0 THEN alt + 1 ELSE alt END::DOUBLE AS ao FROM depths")
def allele_depths(spark, sf):
    table = rows(spark, sf, "SELECT sample_id, variant, (ref + 1) || ',' || (alt + 1) AS ad, CASE WHEN coverage % 2 = 1 THEN cast(ref AS double) END AS ro, CASE WHEN coverage % 2 = 1 THEN cast(alt AS double) END AS ao FROM depths")
    return V.allele_depths(table).select("sample_id", "variant", "ro", "ao")


_SPLIT = """p AS (SELECT *, regexp_extract(aa_change, '^([A-Za-z]+)([0-9]+)', 1) AS b, regexp_extract(aa_change, '([0-9]+)', 1)::INT AS loc, regexp_extract(aa_change, '[0-9]+([A-Za-z]+)$', 1) AS a FROM allele_calls),
sp AS (SELECT p.*, substr(b, 3 * j + 1, 3) || (loc + j) || substr(a, 3 * j + 1, 3) AS change, substr(b, 3 * j + 1, 3) = substr(a, 3 * j + 1, 3) AS same FROM p, (SELECT unnest(range(2)) AS j) WHERE effect = 'missense_variant' AND 3 * j < length(b)
  UNION ALL SELECT p.*, aa_change, effect = 'synonymous_variant' FROM p WHERE effect <> 'missense_variant')"""


@query("split_aa_changes", f"WITH {_SPLIT} SELECT chrom, pos, sample_id, change, same FROM sp")
def split_aa_changes(spark, sf):
    return V.split_aa_changes(rows(spark, sf, "allele_calls")).select("chrom", "pos", "sample_id", "change", "same")


_TARGETS_AA = "t AS (SELECT DISTINCT gene, change, 'known-' || change AS mutation_name FROM sp WHERE change LIKE 'Asp%' OR gene = 'gene2')"
_LABELLED = f"""{_SPLIT}, {_TARGETS_AA},
lb AS (SELECT sp.*, coalesce(t.mutation_name, sp.gene || '-' || sp.change) AS mutation_name, CASE WHEN t.gene IS NULL THEN 'No' ELSE 'Yes' END AS targeted,
  CASE WHEN t.gene IS NOT NULL AND qual < 10 THEN 0 ELSE ao END AS ao2 FROM sp LEFT JOIN t ON sp.gene = t.gene AND sp.change = t.change
  WHERE t.gene IS NOT NULL OR (qual >= 20 AND NOT same))"""


def _labelled(spark, sf):
    split = V.split_aa_changes(rows(spark, sf, "allele_calls"))
    targets = split.where("change LIKE 'Asp%' OR gene = 'gene2'").select("gene", "change", F.concat(F.lit("known-"), "change").alias("mutation_name")).distinct()
    return V.label_targets_aa(split, targets, 20, 10)


@query("label_targets_aa", f"WITH {_LABELLED} SELECT sample_id, chrom, pos, gene, change, mutation_name, targeted, ao2 AS ao FROM lb")
def label_targets_aa(spark, sf):
    return _labelled(spark, sf).select("sample_id", "chrom", "pos", "gene", "change", "mutation_name", "targeted", "ao")


@query("label_targets_nt", """
SELECT sample_id, chrom, pos, ref, alt, CASE WHEN pos % 3 = 1 THEN 'nt' || pos ELSE chrom || ':' || pos || ':' || ref || ':' || alt END AS mutation_name, CASE WHEN pos % 3 = 1 THEN 'Yes' ELSE 'No' END AS targeted,
  CASE WHEN pos % 3 = 1 AND qual < 10 THEN 0 ELSE ao END AS ao FROM allele_calls WHERE pos % 3 = 1 OR qual >= 20""")
def label_targets_nt(spark, sf):
    calls = rows(spark, sf, "allele_calls")
    targets = calls.where("pos % 3 = 1").select("chrom", "pos", "ref", "alt", F.concat(F.lit("nt"), "pos").alias("mutation_name")).distinct()
    return V.label_targets_nt(calls, targets, 20, 10).select("sample_id", "chrom", "pos", "ref", "alt", "mutation_name", "targeted", "ao")


@query("mask_low_quality_calls", """
SELECT sample_id, chrom, pos, CASE WHEN gq < 20 THEN 0 ELSE dp END AS dp, CASE WHEN gq < 20 THEN NULL ELSE genotype END AS genotype,
  CASE WHEN qa < 100 OR (ao <> 0 AND qa / nullif(ao, 0) < 10) THEN 0 ELSE ao END AS ao, CASE WHEN qr < 100 OR (ro <> 0 AND qr / nullif(ro, 0) < 10) THEN 0 ELSE ro END AS ro FROM allele_calls""")
def mask_low_quality_calls(spark, sf):
    return V.mask_low_quality_calls(rows(spark, sf, "allele_calls"), 20, 100, 100, 10, 10).select("sample_id", "chrom", "pos", "dp", "genotype", "ao", "ro")


@query("min_gq_genotypes", "SELECT sample_id, chrom, pos, CASE WHEN gq >= 30 THEN genotype END AS genotype FROM allele_calls")
def min_gq_genotypes(spark, sf):
    return V.min_gq_genotypes(rows(spark, sf, "allele_calls"), 30).select("sample_id", "chrom", "pos", "genotype")


_GT = "CASE WHEN coalesce(bool_or(genotype = 1), false) OR (coalesce(bool_or(genotype = 0), false) AND coalesce(bool_or(genotype = 2), false)) THEN 1 WHEN bool_or(genotype = 0) THEN 0 WHEN bool_or(genotype = 2) THEN 2 ELSE -1 END"


@query("combine_genotypes", f"SELECT sample_id, gene, {_GT} AS genotype FROM allele_calls GROUP BY sample_id, gene")
def combine_genotypes(spark, sf):
    return V.combine_genotypes(rows(spark, sf, "allele_calls"), ["sample_id", "gene"])


_AGG = f"""{_LABELLED}, ag AS (SELECT gene_id, gene, mutation_name, effect, change, targeted, sample_id, sum(ao2) AS alt, min(ro) AS ref0, max(dp) AS coverage, {_GT} AS genotype FROM lb
GROUP BY gene_id, gene, mutation_name, effect, change, targeted, sample_id)"""


@query("aggregate_aa", f"WITH {_AGG} SELECT gene_id, gene, mutation_name, effect, change, targeted, sample_id, alt, least(ref0, coverage - alt) AS ref, coverage, genotype FROM ag")
def aggregate_aa(spark, sf):
    return V.aggregate_aa(_labelled(spark, sf))


@query("aggregate_aa_sample_cap", f"""WITH {_AGG} SELECT gene_id, gene, mutation_name, effect, change, targeted, sample_id, alt,
  CASE WHEN bool_or(ref0 > coverage - alt) OVER (PARTITION BY sample_id) THEN coverage - alt ELSE ref0 END AS ref, coverage, genotype FROM ag""")
def aggregate_aa_sample_cap(spark, sf):
    return V.aggregate_aa(_labelled(spark, sf), cap="sample")


@query("swap_reference_resistant", f"""WITH {_AGG}, c AS (SELECT *, least(ref0, coverage - alt) AS ref, mutation_name = 'known-Asp20His' AND targeted = 'Yes' AS sw FROM ag)
SELECT gene, CASE WHEN sw THEN 'known-His20Asp' ELSE mutation_name END AS mutation_name, CASE WHEN sw THEN 'His20Asp' ELSE change END AS change, targeted, sample_id,
  CASE WHEN sw THEN ref ELSE alt END AS alt, CASE WHEN sw THEN alt ELSE ref END AS ref, coverage, CASE WHEN sw AND genotype = 0 THEN 2 WHEN sw AND genotype = 2 THEN 0 ELSE genotype END AS genotype FROM c""")
def swap_reference_resistant(spark, sf):
    rules = spark.range(1).select(F.lit("known-Asp20His").alias("mutation_name"), F.lit("Asp20His").alias("change"), F.lit("known-His20Asp").alias("new_name"), F.lit("His20Asp").alias("new_change"))
    out = V.swap_reference_resistant(V.aggregate_aa(_labelled(spark, sf)), rules)
    return out.select("gene", "mutation_name", "change", "targeted", "sample_id", "alt", "ref", "coverage", "genotype")


_BLOCKS = f"""v AS ({_SITES}), d AS (SELECT chrom, pos + j AS pos, ref[j + 1] AS ref, alt[j + 1] AS alt, ac FROM v, (SELECT unnest(range(2)) AS j) WHERE length(ref) = 2 AND ref[j + 1] <> alt[j + 1]
UNION ALL SELECT chrom, pos, ref, alt, ac FROM v WHERE length(ref) <> 2)"""


@query("decompose_blocks", f"WITH {_BLOCKS} SELECT * FROM d")
def decompose_blocks(spark, sf):
    return V.decompose_blocks(_sites(spark, sf)).select("chrom", "pos", "ref", "alt", "ac")


@query("decompose_blocks_aligned", None)
def decompose_blocks_aligned(spark, sf):
    """Every allele of two haplotypes' sequences at a probe, of unequal lengths too."""
    sites = rows(spark, sf, "SELECT DISTINCT mip AS chrom, cast(l AS bigint) AS pos, s AS ref, substr(s, 1, k) || 'G' || substr(s, k + 3) AS alt FROM (SELECT mip, haplotype_sequence AS s, length(haplotype_sequence) AS l, 1 + umi_count % 9 AS k FROM calls)")
    return V.decompose_blocks(sites, align=True).select("chrom", "pos", "ref", "alt")


@query("aggregate_nt", f"""
WITH s AS (SELECT *, unnest(string_split(alt, ',')) AS a, generate_subscripts(string_split(alt, ','), 1) AS i FROM site_calls),
x AS (SELECT chrom, pos, ref, a AS alt, sample_id, string_split(ao, ',')[i]::DOUBLE AS ao, ro, dp, CASE WHEN gt LIKE '%.%' THEN NULL ELSE len(list_filter(string_split(gt, '/'), lambda g: g = i::VARCHAR)) END AS genotype FROM s),
d AS (SELECT chrom, pos + j AS pos, ref[j + 1] AS ref_base, alt[j + 1] AS alt_base, sample_id, ao, ro, dp, genotype FROM x, (SELECT unnest(range(2)) AS j) WHERE length(ref) = length(alt) AND j < length(ref) AND (length(ref) = 1 OR ref[j + 1] <> alt[j + 1])
UNION ALL SELECT chrom, pos, ref, alt, sample_id, ao, ro, dp, genotype FROM x WHERE length(ref) <> length(alt))
SELECT chrom, pos, ref_base, alt_base, chrom || ':' || pos AS mutation_name, 'No' AS targeted, sample_id, sum(ao) AS alt, least(min(ro), max(dp) - sum(ao)) AS ref, max(dp) AS coverage, {_GT} AS genotype
FROM d GROUP BY chrom, pos, ref_base, alt_base, sample_id""")
def aggregate_nt(spark, sf):
    single = V.decompose_blocks(V.split_multiallelic(rows(spark, sf, "site_calls"))).withColumns({"mutation_name": F.concat_ws(":", "chrom", "pos"), "targeted": F.lit("No")})
    return V.aggregate_nt(single.withColumnsRenamed({"ref": "ref_base", "alt": "alt_base"}))


@query("unaggregated_tables", """
SELECT sample_id, chrom, pos, CASE WHEN gene = 'gene3' THEN '.' ELSE gene END AS gene, aa_change, ao, ro, dp, coalesce(genotype, -1) AS genotype FROM allele_calls WHERE qual >= 15""")
def unaggregated_tables(spark, sf):
    calls = rows(spark, sf, "allele_calls").withColumn("gene", F.when(F.col("gene") == "gene3", "").otherwise(F.col("gene")))
    return V.unaggregated_tables(calls, 15).select("sample_id", "chrom", "pos", "gene", "aa_change", "ao", "ro", "dp", "genotype")


@query("force_targets", f"""WITH {_AGG}, tg AS (SELECT DISTINCT gene, change || 'x' AS change, 'new-' || change AS mutation_name FROM t UNION SELECT gene, change, mutation_name FROM t),
u AS (SELECT gene, change, sample_id, sum(alt) AS alt, max(coverage) AS coverage FROM ag GROUP BY gene, change, sample_id)
SELECT tg.gene, tg.change, m.sample_id, tg.mutation_name, coalesce(u.alt, 0) AS alt, coalesce(u.coverage, 0) AS coverage FROM tg CROSS JOIN (SELECT sample_id FROM sample_meta) AS m
LEFT JOIN u ON u.gene = tg.gene AND u.change = tg.change AND u.sample_id = m.sample_id""")
def force_targets(spark, sf):
    split = V.split_aa_changes(rows(spark, sf, "allele_calls")).where("change LIKE 'Asp%' OR gene = 'gene2'").select("gene", "change").distinct()
    known = split.select("gene", "change", F.concat(F.lit("known-"), "change").alias("mutation_name"))
    new = split.select("gene", F.concat("change", F.lit("x")).alias("change"), F.concat(F.lit("new-"), "change").alias("mutation_name"))
    return V.force_targets(V.aggregate_aa(_labelled(spark, sf)), known.unionByName(new), rows(spark, sf, "sample_meta"))


@query("merge_codon_snps", """
WITH c AS (SELECT haplotype_id, 'C0' AS copy, ord % 50 AS aa_pos, min(cast(ord % 3 AS int)) AS lo, count(DISTINCT ord % 3) AS n, bool_or(ord % 3 = 0) AS b0, bool_or(ord % 3 = 1) AS b1, bool_or(ord % 3 = 2) AS b2 FROM calls GROUP BY ALL),
m AS (SELECT *, CASE WHEN b0 THEN 'T' ELSE 'G' END || CASE WHEN b1 THEN 'T' ELSE 'C' END || CASE WHEN b2 THEN 'T' ELSE 'A' END AS alt_codon FROM c WHERE n > 1),
k AS (SELECT *, CASE alt_codon WHEN 'TTA' THEN 'L' WHEN 'TCT' THEN 'S' WHEN 'GTT' THEN 'V' WHEN 'TTT' THEN 'F' END AS alt_aa FROM m)
SELECT haplotype_id, copy, aa_pos, 'GCA' AS ref_codon, n AS changes, alt_codon, 'A' AS ref_aa, alt_aa, 'A' || aa_pos || alt_aa AS aa_change, false AS synonymous FROM k""")
def merge_codon_snps(spark, sf):
    from ..functions.seq import codon_map

    snps = rows(spark, sf, "calls").select("haplotype_id", F.lit("C0").alias("copy"), (F.col("ord") % 50).alias("aa_pos"), (F.col("ord") % 3).cast("int").alias("codon_pos"), F.lit("GCA").alias("ref_codon")).distinct()
    snps = snps.withColumns({"ref_base": F.substring("ref_codon", F.col("codon_pos") + 1, F.lit(1)), "alt_base": F.lit("T")})
    return V.merge_codon_snps(snps, codon_map())


_CALLED = """f AS (SELECT *, CASE WHEN alt < 5 THEN 0 ELSE alt END AS fa, CASE WHEN coverage < 20 THEN 0 ELSE coverage END AS fc FROM depths),
cl AS (SELECT *, fa / nullif(fc::DOUBLE, 0) AS wsaf FROM f),
gt AS (SELECT *, CASE WHEN wsaf IS NULL THEN NULL WHEN wsaf = 0 OR wsaf < 0.1 THEN 0 WHEN wsaf < 0.9 THEN 1 ELSE 2 END AS genotype, CASE WHEN wsaf IS NULL THEN NULL WHEN wsaf = 0 OR wsaf < 0.1 THEN 0 ELSE 1 END AS prevalence FROM cl)"""


def _called(spark, sf):
    return G.call_genotypes(rows(spark, sf, "depths"), 5, 20, 0.1)


@query("call_genotypes", f"WITH {_CALLED} SELECT sample_id, variant, fa AS filtered_alt, fc AS filtered_coverage, round(wsaf, 9) AS wsaf, genotype, prevalence FROM gt")
def call_genotypes(spark, sf):
    return _called(spark, sf).select("sample_id", "variant", "filtered_alt", "filtered_coverage", F.round("wsaf", 9).alias("wsaf"), "genotype", "prevalence")


@query("genotype_label", "SELECT sample_id, variant, CASE WHEN coverage = 0 THEN NULL WHEN alt / coverage::DOUBLE >= 0.2 THEN CASE WHEN alt / coverage::DOUBLE > 1 - 0.2::DOUBLE THEN 'MUT' ELSE 'MIX' END ELSE 'WT' END AS label FROM depths")
def genotype_label(spark, sf):
    return G.genotype_label(rows(spark, sf, "depths"), 0.2).select("sample_id", "variant", "label")


_KEEP = f"{_CALLED}, kp AS (SELECT variant FROM gt GROUP BY variant HAVING bool_or(targeted = 'Yes') OR (count(CASE WHEN wsaf > 0.4 THEN 1 END) >= 28 AND count(CASE WHEN fa >= 60 THEN 1 END) > 30))"


@query("keep_variants", f"WITH {_KEEP} SELECT sample_id, variant, genotype FROM gt WHERE variant IN (SELECT variant FROM kp)")
def keep_variants(spark, sf):
    return G.keep_variants(_called(spark, sf), 0.4, 28, 60, 30).select("sample_id", "variant", "genotype")


_SPARSE = f"""{_CALLED}, sg AS (SELECT sample_id, variant, CASE WHEN alt % 4 = 0 OR (ref % 3 = 0 AND length(sample_id) = 3) THEN NULL ELSE genotype END AS genotype FROM gt),
z AS (SELECT * FROM sg WHERE variant IN (SELECT variant FROM sg GROUP BY variant HAVING sum(genotype) > 0)),
ss AS (SELECT sample_id FROM z GROUP BY sample_id HAVING count(genotype) >= (SELECT count(DISTINCT variant) FROM z) * (1 - 0.4::DOUBLE)),
z2 AS (SELECT * FROM z WHERE sample_id IN (SELECT sample_id FROM ss)),
fm AS (SELECT * FROM z2 WHERE variant IN (SELECT variant FROM z2 GROUP BY variant HAVING count(genotype) >= (SELECT count(DISTINCT sample_id) FROM z2) * (1 - 0.35::DOUBLE)))"""


def _sparse(spark, sf):
    gone = (F.col("alt") % 4 == 0) | ((F.col("ref") % 3 == 0) & (F.length("sample_id") == 3))
    table = _called(spark, sf).withColumn("genotype", F.when(~gone, F.col("genotype"))).select("sample_id", "variant", "genotype")
    return G.filter_by_missingness(table, "genotype", 0.4, 0.35, remove_zero=True)


@query("filter_by_missingness", f"WITH {_SPARSE} SELECT * FROM fm")
def filter_by_missingness(spark, sf):
    return _sparse(spark, sf)


@query("impute_mode", f"""WITH {_SPARSE}, c AS (SELECT variant, genotype, count(*) AS n FROM fm WHERE genotype IS NOT NULL GROUP BY variant, genotype), m AS (SELECT variant, min(ROW(-n, genotype))[2] AS mode FROM c GROUP BY variant)
SELECT fm.variant, sample_id, genotype, coalesce(genotype, mode)::DOUBLE AS imputed FROM fm JOIN m ON fm.variant = m.variant""")
def impute_mode(spark, sf):
    return G.impute(_sparse(spark, sf), "mode")


@query("impute_mean", f"WITH {_SPARSE} SELECT variant, sample_id, genotype, round(coalesce(genotype, avg(genotype) OVER (PARTITION BY variant)), 9) AS imputed FROM fm")
def impute_mean(spark, sf):
    return G.impute(_sparse(spark, sf), "mean").withColumn("imputed", F.round("imputed", 9))


@query("impute_median", f"WITH {_SPARSE}, m AS (SELECT variant, quantile_cont(genotype, 0.5) AS q FROM fm GROUP BY variant) SELECT fm.variant, sample_id, genotype, coalesce(genotype, q)::DOUBLE AS imputed FROM fm JOIN m ON fm.variant = m.variant")
def impute_median(spark, sf):
    return G.impute(_sparse(spark, sf), "median")


@query("presence_matrix", f"""WITH {_CALLED}, s AS (SELECT sample_id, variant, CASE WHEN wsaf > 0.3 THEN 1 WHEN wsaf IS NOT NULL THEN 0 END AS present FROM gt),
z AS (SELECT * FROM s WHERE variant IN (SELECT variant FROM s GROUP BY variant HAVING sum(present) > 0)),
z1 AS (SELECT * FROM z WHERE sample_id IN (SELECT sample_id FROM z GROUP BY sample_id HAVING count(present) >= (SELECT count(DISTINCT variant) FROM z) * (1 - (1 - 0.5::DOUBLE)))),
z2 AS (SELECT * FROM z1 WHERE variant IN (SELECT variant FROM z1 GROUP BY variant HAVING count(present) >= (SELECT count(DISTINCT sample_id) FROM z1) * (1 - (1 - 0.5::DOUBLE)))),
m AS (SELECT variant, min(ROW(-n, present))[2] AS mode FROM (SELECT variant, present, count(*) AS n FROM z2 WHERE present IS NOT NULL GROUP BY variant, present) GROUP BY variant)
SELECT z2.variant, sample_id, present, coalesce(present, mode)::DOUBLE AS imputed FROM z2 JOIN m ON z2.variant = m.variant""")
def presence_matrix(spark, sf):
    return G.presence_matrix(_called(spark, sf).select("sample_id", "variant", "wsaf"), "wsaf", 0.3, 0.5, 0.5).drop("wsaf")


@query("pca", None)
def pca(spark, sf):
    return G.pca(G.impute(_called(spark, sf), "mean"), 3)


_PREV = f"""{_CALLED}, j AS (SELECT gt.variant, gt.prevalence, m.* FROM gt JOIN sample_meta AS m ON gt.sample_id = m.sample_id),
pv AS (SELECT CASE WHEN grouping(site) = 1 THEN 'overall' ELSE site END AS site, variant, count(CASE WHEN prevalence > 0 THEN 1 END) AS alt, count(prevalence) AS coverage, round(avg(latitude), 7) AS latitude, round(avg(longitude), 7) AS longitude,
  round(count(CASE WHEN prevalence > 0 THEN 1 END) / nullif(count(prevalence)::DOUBLE, 0), 4) AS prevalence FROM j GROUP BY GROUPING SETS ((site, variant), (variant)))"""


@query("prevalence_by_site", f"WITH {_PREV} SELECT * FROM pv")
def prevalence_by_site(spark, sf):
    return G.prevalence_by_site(_called(spark, sf), rows(spark, sf, "sample_meta"))


@query("prevalence_text_parse", f"WITH {_PREV} SELECT site, variant, prevalence AS value FROM pv")
def prevalence_text_parse(spark, sf):
    out = G.prevalence_text(G.prevalence_by_site(_called(spark, sf), rows(spark, sf, "sample_meta")))
    return G.prevalence_text_parse(out).select("site", "variant", "value")


@query("prevalence_matrix", f"""WITH {_CALLED} SELECT year, site, avg(CASE WHEN variant = 'gene0-Ala0Val' THEN prevalence END) AS "gene0-Ala0Val", avg(CASE WHEN variant = 'gene1-Ala7Val' THEN prevalence END) AS "gene1-Ala7Val"
FROM gt JOIN sample_meta AS m ON gt.sample_id = m.sample_id GROUP BY year, site""")
def prevalence_matrix(spark, sf):
    return G.prevalence_matrix(_called(spark, sf), rows(spark, sf, "sample_meta"), ["gene0-Ala0Val", "gene1-Ala7Val"])


@query("duplicate_mutations", "SELECT gene AS variant, count(*) AS count FROM (SELECT DISTINCT gene, variant FROM depths) GROUP BY gene HAVING count(*) > 1")
def duplicate_mutations(spark, sf):
    return G.duplicate_mutations(rows(spark, sf, "depths").select("gene", "variant").distinct().select(F.col("gene").alias("variant")))


@query("mutation_sort_key", "SELECT variant, regexp_extract(variant, '^(.*)-', 1) AS gene_part, regexp_extract(variant, '-[A-Za-z]+([0-9]+)', 1)::INT AS position FROM (SELECT DISTINCT variant FROM depths)")
def mutation_sort_key(spark, sf):
    return G.mutation_sort_key(rows(spark, sf, _VARIANTS))


_PROBES = """pr AS (SELECT p.chrom, p.capture_start, p.capture_end, m.sample_id, m.umi_count AS umi FROM mapped AS m JOIN probe_copies AS p ON m.mip = p.mip AND m.copy = p.copy),
tg AS (SELECT DISTINCT 't' || mip || copy AS name, chrom, capture_start + 20 AS start, capture_start + 40 AS stop FROM probe_copies)"""


@query("position_coverage", f"WITH {_PROBES} SELECT name, sample_id, sum(umi)::BIGINT AS coverage FROM tg JOIN pr ON pr.chrom = tg.chrom AND pr.capture_start <= tg.start AND pr.capture_end >= tg.stop GROUP BY name, sample_id")
def position_coverage(spark, sf):
    probes = rows(spark, sf, "mapped").join(rows(spark, sf, "probe_copies").drop("gene"), ["mip", "copy"]).select("gene", "chrom", "capture_start", "capture_end", "sample_id", F.col("umi_count").alias("umi"))
    copies = rows(spark, sf, "probe_copies")
    targets = copies.select(F.concat(F.lit("t"), "mip", "copy").alias("name"), "chrom", (F.col("capture_start") + 20).alias("start"), (F.col("capture_start") + 40).alias("stop")).distinct()
    return G.position_coverage(targets, probes)


@query("complete_known_targets", """
WITH k AS (SELECT DISTINCT variant, 'chr1' AS chrom, length(variant) AS pos FROM depths WHERE targeted = 'Yes'), g AS (SELECT k.*, m.sample_id FROM k CROSS JOIN (SELECT sample_id FROM sample_meta) AS m), d AS (SELECT * FROM depths WHERE alt > 0)
SELECT coalesce(d.variant, g.variant) AS variant, coalesce(d.sample_id, g.sample_id) AS sample_id, coalesce(d.alt, 0) AS alt, g.chrom, g.pos FROM d FULL OUTER JOIN g ON d.variant = g.variant AND d.sample_id = g.sample_id""")
def complete_known_targets(spark, sf):
    depths = rows(spark, sf, "depths")
    known = depths.where("targeted = 'Yes'").select("variant", F.lit("chr1").alias("chrom"), F.length("variant").cast("bigint").alias("pos"))
    return G.complete_known_targets(depths.where("alt > 0"), known, rows(spark, sf, "sample_meta"))


@query("reference_total", "SELECT sample_id, gene, max(coverage) AS coverage, coalesce(sum(CASE WHEN targeted = 'Yes' THEN alt END), 0)::BIGINT AS changed, (max(coverage) - coalesce(sum(CASE WHEN targeted = 'Yes' THEN alt END), 0))::BIGINT AS reference FROM depths GROUP BY sample_id, gene")
def reference_total(spark, sf):
    return G.reference_total(rows(spark, sf, "depths").withColumn("nonsynonymous", F.col("targeted") == "Yes"))


@query("parse_call_string", "SELECT sample_id, variant, gt AS gen, alt AS count, coverage AS total, CASE WHEN gt = './.' THEN NULL ELSE (coverage % 3)::INT END AS alleles FROM (SELECT *, CASE coverage % 4 WHEN 3 THEN './.' ELSE CASE coverage % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END END AS gt FROM depths)")
def parse_call_string(spark, sf):
    table = rows(spark, sf, "SELECT sample_id, variant, CASE coverage % 4 WHEN 3 THEN './.' ELSE CASE coverage % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END END || ':' || alt || ':' || coverage AS call FROM depths")
    return G.parse_call_string(table).drop("call")


@query("noncoding_name", "SELECT gene, variant AS vkey, gene || '-' || variant AS name FROM (SELECT DISTINCT gene, variant FROM depths)")
def noncoding_name(spark, sf):
    return G.noncoding_name(rows(spark, sf, "SELECT DISTINCT gene, variant AS vkey FROM depths"))


# calls of a tenth of the cells are missing altogether, and those of some samples by more
_PLINK = f"""{_CALLED}, gs AS (SELECT * FROM gt WHERE (length(variant) * 7 + substr(sample_id, 2)::BIGINT + regexp_extract(variant, '([0-9]+)Val', 1)::BIGINT) % 10 > 0), st AS (SELECT DISTINCT variant, gene, 'chr' || length(variant) % 3 AS chrom, regexp_extract(variant, '([0-9]+)Val', 1)::BIGINT AS pos, 'A' AS ref, 'G' AS alt FROM depths),
cells AS (SELECT p.sample_id, affected, genotype, chrom, pos, st.variant FROM phenotype AS p JOIN (SELECT DISTINCT sample_id FROM gs) AS h ON h.sample_id = p.sample_id CROSS JOIN st LEFT JOIN gs ON gs.sample_id = p.sample_id AND gs.variant = st.variant)"""
_PED = "sample_id || ' ' || sample_id || ' 0 0 0 ' || CASE WHEN affected THEN '2' ELSE '1' END || ' ' || string_agg(CASE genotype WHEN 0 THEN 'A A' WHEN 1 THEN 'A G' WHEN 2 THEN 'G G' ELSE '0 0' END, ' ' ORDER BY chrom, pos, variant) AS line FROM cells GROUP BY sample_id, affected"
_GENO = "sample_id || chr(9) || string_agg(coalesce(genotype::VARCHAR, '.'), chr(9) ORDER BY chrom, pos, variant) AS line FROM cells GROUP BY sample_id"


def _plink(spark, sf):
    sites = rows(spark, sf, "depths").select("variant", "gene", F.concat(F.lit("chr"), (F.length("variant") % 3).cast("string")).alias("chrom"), F.regexp_extract("variant", "([0-9]+)Val", 1).cast("bigint").alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt")).distinct()
    seen = (F.length("variant") * 7 + F.substring("sample_id", 2, 20).cast("bigint") + F.regexp_extract("variant", "([0-9]+)Val", 1).cast("bigint")) % 10 > 0
    return G.plink_tables(_called(spark, sf).select("sample_id", "variant", "genotype").where(seen), sites, rows(spark, sf, "phenotype"))


@query("plink_ped", f"WITH {_PLINK} SELECT sample_id, {_PED}")
def plink_ped(spark, sf):
    return _plink(spark, sf)[0]


@query("plink_map", f"WITH {_PLINK} SELECT variant, chrom || chr(9) || variant || chr(9) || '0' || chr(9) || pos AS line FROM st")
def plink_map(spark, sf):
    return _plink(spark, sf)[1].select("variant", "line")


@query("plink_geno", f"WITH {_PLINK} SELECT sample_id, {_GENO}")
def plink_geno(spark, sf):
    return _plink(spark, sf)[2]


@query("plink_genes", f"WITH {_PLINK} SELECT gene, string_agg(DISTINCT variant, ' ' ORDER BY variant) AS line FROM st GROUP BY gene")
def plink_genes(spark, sf):
    return _plink(spark, sf)[3]


@query("write_plink", f"""WITH {_PLINK} SELECT 'ped' AS kind, {_PED}
UNION ALL SELECT 'map', chrom || chr(9) || variant || chr(9) || '0' || chr(9) || pos FROM st
UNION ALL SELECT 'geno', {_GENO}
UNION ALL SELECT 'hlist', string_agg(DISTINCT variant, ' ' ORDER BY variant) FROM st GROUP BY gene""")
def write_plink(spark, sf):
    path = scratch_path(spark, "plink")
    W.write_plink(_plink(spark, sf), path)
    return R.read_plink(spark, path)


@query("coi_encoding", f"WITH {_CALLED} SELECT sample_id, variant, coalesce(genotype / 2.0::DOUBLE, -1) AS coi FROM gt")
def coi_encoding(spark, sf):
    return G.coi_encoding(_called(spark, sf)).select("sample_id", "variant", "coi")


# the chi-square tail with one degree of freedom is 1 less the normal density's integral, here by Simpson's rule
_CHI = "1 - sqrt(chi) / 3000 * list_sum(list_transform(range(1001), lambda i: CASE WHEN i % 1000 = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * sqrt(2 / pi()) * exp(-chi * i * i / 2000000)))"


@query("contingency_tests", f"""
WITH {_CALLED}, c AS (SELECT variant, affected, count(CASE WHEN genotype = 2 THEN 1 END) AS hom, count(CASE WHEN genotype = 1 THEN 1 END) AS het, count(CASE WHEN genotype > 0 THEN 1 END) AS either, count(CASE WHEN genotype = 0 THEN 1 END) AS wild
  FROM gt JOIN phenotype AS p ON gt.sample_id = p.sample_id WHERE genotype IS NOT NULL GROUP BY variant, affected),
l AS (SELECT variant, affected, wild, unnest(['hom', 'het', 'any']) AS kind, unnest([hom, het, either]) AS alt FROM c),
t AS (SELECT variant, kind, coalesce(sum(CASE WHEN affected THEN alt END), 0)::BIGINT AS a, coalesce(sum(CASE WHEN NOT affected THEN alt END), 0)::BIGINT AS b,
  coalesce(sum(CASE WHEN affected THEN wild END), 0)::BIGINT AS c, coalesce(sum(CASE WHEN NOT affected THEN wild END), 0)::BIGINT AS d FROM l GROUP BY variant, kind),
m AS (SELECT *, a + b + c + d AS n, lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) AS fixed,
  (a + b + c + d) * pow(greatest(0, abs(a * d - b * c) - (a + b + c + d) / 2), 2) / nullif((a + b)::DOUBLE * (c + d) * (a + c) * (b + d), 0) AS chi FROM t),
o AS (SELECT *, list_transform(range(greatest(0, a + b + a + c - n), least(a + b, a + c) + 1), lambda x: fixed - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(n - a - b - a - c + x + 1)) AS ps,
  fixed - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1) AS own FROM m)
SELECT variant, kind, a AS case_alt, b AS control_alt, c AS case_wild, d AS control_wild, round(a * d / nullif(b::DOUBLE * c, 0), 9) AS odds_ratio,
  round(CASE WHEN n = 0 THEN 1 ELSE least(1, list_sum(list_transform(list_filter(ps, lambda p: p <= own + 1e-7), lambda p: exp(p)))) END, 7) AS fisher_p, round(coalesce({_CHI}, 1), 7) AS chi_square_p FROM o""")
def contingency_tests(spark, sf):
    out = G.contingency_tests(_called(spark, sf), rows(spark, sf, "phenotype"))
    return out.withColumns({"odds_ratio": F.round("odds_ratio", 9), "fisher_p": F.round("fisher_p", 7), "chi_square_p": F.round("chi_square_p", 7)})


_CELLS = "x AS (SELECT sample_id, gene, CASE WHEN ref > alt THEN 0 ELSE 1 END AS expected, CASE WHEN coverage % 10 = 0 THEN NULL WHEN alt > 20 THEN 1 ELSE 0 END AS observed FROM depths)"


@query("call_concordance", f"""WITH {_CELLS}, c AS (SELECT gene, count(CASE WHEN expected = 1 AND observed = 1 THEN 1 END) AS tp, count(CASE WHEN expected = 0 AND observed = 0 THEN 1 END) AS tn,
  count(CASE WHEN expected = 0 AND observed = 1 THEN 1 END) AS fp, count(CASE WHEN expected = 1 AND observed = 0 THEN 1 END) AS fn, count(*) AS cells FROM x GROUP BY gene)
SELECT *, (tp + tn) / nullif((tp + tn + fp + fn)::DOUBLE, 0) AS accuracy, tp / nullif((tp + fp)::DOUBLE, 0) AS precision, tp / nullif((tp + fn)::DOUBLE, 0) AS recall, (tp + tn + fp + fn) / nullif(cells::DOUBLE, 0) AS call_rate FROM c""")
def call_concordance(spark, sf):
    cells = rows(spark, sf, "SELECT sample_id, gene, CASE WHEN ref > alt THEN 0 ELSE 1 END AS expected, CASE WHEN coverage % 10 = 0 THEN NULL WHEN alt > 20 THEN 1 ELSE 0 END AS observed FROM depths")
    return G.call_concordance(cells, ["gene"])


@query("frequency_r2", "SELECT round(pow(corr(alt, ref), 2), 9) AS r2, round(pow(corr(CASE WHEN alt > 0 THEN alt END, CASE WHEN alt > 0 THEN ref END), 2), 9) AS r2_expected FROM depths")
def frequency_r2(spark, sf):
    out = G.frequency_r2(rows(spark, sf, "depths"), F.col("alt"), F.col("ref"))
    return out.select(F.round("r2", 9).alias("r2"), F.round("r2_expected", 9).alias("r2_expected"))
