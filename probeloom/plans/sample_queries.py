"""Queries for operators/samples.py and functions/seq.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as Q
from ..operators import samples as S
from .registry import query, rows

_CAPTURE = "SELECT DISTINCT 'P' || o_custkey % 40 AS sample_plate, o_orderpriority AS sample_set, cast(o_custkey % 4 AS int) AS quadrant, cast(o_custkey % 7 AS int) AS fw FROM orders"
_SAMPLES = "SELECT 'N' || c_custkey AS sample_name, 'P' || (c_custkey % 43 + 2) AS sample_plate, cast(c_custkey % 12 AS int) AS well_column FROM customer"
_QUADRANTS = "SELECT DISTINCT cast(o_custkey % 4 AS int) AS quadrant, cast(o_custkey % 12 AS int) AS well_column, cast(o_custkey % 12 * 2 + o_custkey % 4 AS int) AS rev FROM orders"


@query("build_sample_sheet", f"SELECT DISTINCT c.sample_plate, sample_set, c.quadrant, fw, sample_name, s.well_column, rev FROM ({_CAPTURE}) AS c JOIN ({_SAMPLES}) AS s ON c.sample_plate = s.sample_plate JOIN ({_QUADRANTS}) AS q ON q.quadrant = c.quadrant AND q.well_column = s.well_column")
def build_sample_sheet(spark, sf):
    return S.build_sample_sheet(rows(spark, sf, _CAPTURE), rows(spark, sf, _SAMPLES), rows(spark, sf, _QUADRANTS))


@query("plate_orphans", f"WITH a AS (SELECT DISTINCT sample_plate FROM ({_CAPTURE})), b AS (SELECT DISTINCT sample_plate FROM ({_SAMPLES})) SELECT *, 'missing' AS kind FROM a WHERE sample_plate NOT IN (SELECT * FROM b) UNION ALL SELECT *, 'unused' FROM b WHERE sample_plate NOT IN (SELECT * FROM a)")
def plate_orphans(spark, sf):
    return S.plate_orphans(rows(spark, sf, _CAPTURE), rows(spark, sf, _SAMPLES))


@query("assign_replicates", """
WITH k AS (SELECT *, replicate IS NOT NULL AND row_number() OVER (PARTITION BY sample_name, sample_set, replicate ORDER BY ord) = 1 AS keeps, count(*) OVER g AS n FROM requests WINDOW g AS (PARTITION BY sample_name, sample_set)),
q AS (SELECT sample_name, sample_set, max(n) AS n, coalesce(list(DISTINCT replicate) FILTER (WHERE replicate IS NOT NULL), []) AS asked FROM k GROUP BY sample_name, sample_set),
f AS (SELECT sample_name, sample_set, list_filter(range(1, n + 1), lambda x: NOT list_contains(asked, x::INT)) AS free FROM q),
r AS (SELECT k.*, row_number() OVER (PARTITION BY k.sample_name, k.sample_set, keeps ORDER BY ord) AS i FROM k)
SELECT r.sample_name, r.sample_set, r.ord, r.replicate, (CASE WHEN keeps THEN replicate ELSE free[i] END)::INT AS assigned FROM r JOIN f ON r.sample_name = f.sample_name AND r.sample_set = f.sample_set""")
def assign_replicates(spark, sf):
    return S.assign_replicates(rows(spark, sf, "requests")).select("sample_name", "sample_set", "ord", "replicate", "assigned")


@query("validate_sample_ids", "SELECT c_custkey, c_name AS sample_name FROM customer WHERE NOT regexp_full_match(c_name, '[0-9A-Za-z-]+')")
def validate_sample_ids(spark, sf):
    return S.validate_sample_ids(rows(spark, sf, "SELECT c_custkey, c_name AS sample_name FROM customer"))


@query("required_columns_check", "SELECT 'replicate' AS column_name, bool_or(replicate IS NULL) AS has_nulls FROM requests UNION ALL SELECT 'fw', bool_or(fw IS NULL) FROM requests")
def required_columns_check(spark, sf):
    return S.required_columns_check(rows(spark, sf, "requests"), ["replicate", "fw"])


@query("duplicate_primer_pairs", "SELECT * FROM (SELECT fw, rev, sample_name, ord, count(*) OVER (PARTITION BY fw, rev) AS uses FROM requests) WHERE uses > 1")
def duplicate_primer_pairs(spark, sf):
    return S.duplicate_primer_pairs(rows(spark, sf, "requests").select("fw", "rev", "sample_name", "ord"))


@query("split_by_probe_set", "WITH x AS (SELECT ord, fw, rev, unnest(string_split(probe_set, ',')) AS probe_set FROM requests) SELECT *, count(*) OVER (PARTITION BY probe_set, fw, rev) > 1 AS repeats FROM x")
def split_by_probe_set(spark, sf):
    return S.split_by_probe_set(rows(spark, sf, "requests").select("ord", "fw", "rev", "probe_set"))


_PRIMERS = "SELECT DISTINCT cast(o_orderkey % 96 AS int) AS primer, translate(cast(o_orderkey % 96 + 12345600 AS string), '0123456789', 'ACGTTGCAAC') AS sequence, translate(cast(o_orderkey % 96 + 98765400 AS string), '0123456789', 'ACGTTGCAAC') AS index_sequence FROM orders"


def _indexed(spark, sf):
    sheet = rows(spark, sf, "requests").withColumn("sample_id", F.concat_ws("-", "sample_name", "ord"))
    return S.attach_index_sequences(sheet, rows(spark, sf, _PRIMERS), "nextseq")


_INDEXED = f"ix AS (SELECT r.*, r.sample_name || '-' || r.ord AS sample_id, a.index_sequence AS i7, b.index_sequence AS i5 FROM requests AS r LEFT JOIN ({_PRIMERS}) AS a ON a.primer = r.rev LEFT JOIN ({_PRIMERS}) AS b ON b.primer = r.fw)"


@query("attach_index_sequences", f"WITH {_INDEXED} SELECT ord, fw, rev, i7, i5 FROM ix")
def attach_index_sequences(spark, sf):
    return _indexed(spark, sf).select("ord", "fw", "rev", "i7", "i5")


@query("instrument_sheet", f"""WITH {_INDEXED} SELECT sample_id AS "Sample_ID", sample_id AS "Sample_Name", '' AS "Sample_Plate", '' AS "Sample_Well", 'N' || rev AS "I7_Index_ID", i7 AS "index", 'S' || fw AS "I5_Index_ID", i5 AS index2, '' AS "Sample_Project" FROM ix""")
def instrument_sheet(spark, sf):
    return S.instrument_sheet(_indexed(spark, sf))


_LIBS = "SELECT 'S' || o_custkey AS sample_id, o_orderkey AS ord, o_orderpriority AS sample_set, CASE WHEN o_orderkey % 3 = 0 THEN 'DR1,VAR4' WHEN o_orderkey % 3 = 1 THEN 'dr1' ELSE 'IBC' END AS probe_set FROM orders"


@query("select_samples", f"SELECT * FROM ({_LIBS}) WHERE ord % 3 IN (0, 1) AND sample_set = '1-URGENT' AND sample_id IN (SELECT sample_id FROM calls)")
def select_samples(spark, sf):
    return S.select_samples(rows(spark, sf, _LIBS), ["DR1"], ["1-urgent"], rows(spark, sf, "calls"))


@query("select_samples_regex", f"SELECT * FROM ({_LIBS}) WHERE ord % 3 = 0 AND (sample_set LIKE '1-%' OR sample_set LIKE '2-%')")
def select_samples_regex(spark, sf):
    return S.select_samples_regex(rows(spark, sf, _LIBS), "DR1", "1-|2-")


@query("collapse_run_meta", "SELECT 'N' || o_custkey AS sample_id, o_orderpriority AS library_prep, arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'F') AS status, arg_min(o_orderkey % 7, o_orderkey) AS lane FROM orders GROUP BY o_custkey, o_orderpriority")
def collapse_run_meta(spark, sf):
    return S.collapse_run_meta(rows(spark, sf, "SELECT 'N' || o_custkey AS sample_id, o_orderpriority AS library_prep, o_orderkey AS ord, nullif(o_orderstatus, 'F') AS status, o_orderkey % 7 AS lane FROM orders"))


@query("merge_sample_sheets", f"SELECT DISTINCT sample_id, sample_set, probe_set FROM ({_LIBS})")
def merge_sample_sheets(spark, sf):
    libs = rows(spark, sf, _LIBS).select("sample_id", "sample_set", "probe_set")
    return S.merge_sample_sheets(libs.where("sample_set < '3'"), libs.where("sample_set >= '2'"))


_ARMS = "SELECT 'm' || l_partkey % 300 AS mip_id, 'mip' || l_partkey % 40 AS mip_family, l_orderkey * 10 + l_linenumber AS ord, CASE WHEN l_linenumber > 1 THEN 'A' || l_orderkey || l_linenumber || '.' || l_partkey || '.' || l_suppkey || '.' || l_extendedprice END AS extension_arm FROM lineitem"


@query("select_panel_arms", f"WITH a AS (SELECT * FROM ({_ARMS}) WHERE extension_arm IS NOT NULL AND mip_family IN (SELECT mip FROM probe_copies WHERE copy = 'C1')) SELECT mip_id, min(ROW(ord, extension_arm))[2] AS extension_arm FROM a GROUP BY mip_id")
def select_panel_arms(spark, sf):
    panel = rows(spark, sf, "SELECT DISTINCT mip AS mip_family FROM probe_copies WHERE copy = 'C1'")
    arms = rows(spark, sf, _ARMS).withColumn("key", F.struct("ord", "extension_arm"))
    return S.select_panel_arms(arms, panel, ["mip_id", "extension_arm"], "key")


_DESIGN = "SELECT p_partkey, translate(cast(p_partkey + 1000 AS string), '0123456789', 'ACGTTGCAAC') || repeat('N', p_size % 5 + 1) || 'CCTTAA' || repeat('N', p_size % 3 + 1) || 'GATTACA' || CASE WHEN p_size % 9 = 0 THEN 'NA' ELSE '' END AS sequence, 'gene' || p_partkey % 30 AS gene, 'mip' || p_partkey % 900 AS mip, cast(p_partkey % 900 AS int) AS number FROM part"


@query("derive_mip_arms", f"""SELECT p_partkey, p_size % 9 <> 0 AS well_formed, CASE WHEN p_size % 9 = 0 THEN '' ELSE reverse(translate(translate(cast(p_partkey + 1000 AS string), '0123456789', 'ACGTTGCAAC'), 'ACGT', 'TGCA')) END AS ligation_arm,
  CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_size % 5 + 1 END::INT AS ligation_barcode_length, CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_size % 3 + 1 END::INT AS extension_barcode_length, CASE WHEN p_size % 9 = 0 THEN '' ELSE 'GATTACA' END AS extension_arm FROM part""")
def derive_mip_arms(spark, sf):
    return S.derive_mip_arms(rows(spark, sf, _DESIGN)).select("p_partkey", "well_formed", "ligation_arm", "ligation_barcode_length", "extension_barcode_length", "extension_arm")


@query("plate_layout", f"""WITH d AS (SELECT DISTINCT sequence, mip, gene, number FROM ({_DESIGN})), r AS (SELECT *, row_number() OVER (ORDER BY gene, number, mip, sequence) - 1 AS p FROM d)
SELECT sequence, mip, gene, (p // 96)::INT AS plate, substr('ABCDEFGH', (p % 96 // 12 + 1)::INT, 1) || (p % 12 + 1) AS well, regexp_replace(sequence, '^([^N]*)N+', '\\1(N)') AS order_sequence FROM r""")
def plate_layout(spark, sf):
    return S.plate_layout(rows(spark, sf, _DESIGN)).select("sequence", "mip", "gene", "plate", "well", "order_sequence")


@query("probe_info_table", """
WITH t AS (SELECT 't' || mip || copy AS name, chrom, capture_start + 20 AS start, capture_start + 30 AS stop FROM probe_copies),
h AS (SELECT p.mip, p.copy, string_agg(DISTINCT t.name, ',' ORDER BY t.name) AS targets FROM probe_copies AS p JOIN t ON p.chrom = t.chrom AND t.start >= p.capture_start AND t.stop <= p.capture_end GROUP BY p.mip, p.copy)
SELECT p.mip, p.copy, p.chrom, coalesce(targets, '') AS targets FROM probe_copies AS p LEFT JOIN h ON p.mip = h.mip AND p.copy = h.copy""")
def probe_info_table(spark, sf):
    copies = rows(spark, sf, "probe_copies")
    targets = copies.select(F.concat(F.lit("t"), "mip", "copy").alias("name"), "chrom", (F.col("capture_start") + 20).alias("start"), (F.col("capture_start") + 30).alias("stop"))
    return S.probe_info_table(copies, targets).select("mip", "copy", "chrom", "targets")


@query("filter_probe_catalogue", "SELECT * FROM probe_copies WHERE mip IN (SELECT mip FROM calls WHERE umi_count > 49)")
def filter_probe_catalogue(spark, sf):
    return S.filter_probe_catalogue(rows(spark, sf, "probe_copies"), rows(spark, sf, "calls").where("umi_count > 49"))


@query("probe_sets_long", "SELECT 'name' AS probe_set, p_name AS mip FROM part UNION ALL SELECT 'brand', p_brand FROM part WHERE p_size > 10")
def probe_sets_long(spark, sf):
    return S.probe_sets_long(rows(spark, sf, "SELECT p_name AS name, CASE WHEN p_size > 10 THEN p_brand END AS brand FROM part"), ["name", "brand"])


@query("sheet_combinations", f"SELECT sample_set, probe_set, min(ord) AS ord FROM ({_LIBS}) GROUP BY sample_set, probe_set")
def sheet_combinations(spark, sf):
    return S.sheet_combinations(rows(spark, sf, _LIBS)).select("sample_set", "probe_set", "ord")


_STATS = "SELECT l_suppkey AS sample_number, cast(l_linenumber % 4 AS int) AS lane, cast(l_quantity AS bigint) * 100 AS reads_raw, cast(l_quantity AS bigint) * 90 AS reads_pf FROM lineitem"


@query("demux_read_summary", f"WITH s AS (SELECT sample_number, lane, sum(reads_raw)::BIGINT AS reads_raw, sum(reads_pf)::BIGINT AS reads_pf FROM ({_STATS}) GROUP BY sample_number, lane) SELECT sample_number, s_name AS sample_name, lane, reads_raw, reads_pf, round(reads_pf / (sum(reads_pf) OVER (PARTITION BY lane))::DOUBLE, 9) AS lane_share FROM s JOIN supplier ON s_suppkey = sample_number")
def demux_read_summary(spark, sf):
    sheet = rows(spark, sf, "SELECT s_suppkey AS sample_number, s_name AS sample_name FROM supplier")
    return S.demux_read_summary(rows(spark, sf, _STATS), sheet).withColumn("lane_share", F.round("lane_share", 9))




@query("decode_undetermined", f"""WITH p AS ({_PRIMERS}), h AS (SELECT DISTINCT o_orderkey % 120 AS a, o_orderkey % 130 AS b FROM orders), u AS (SELECT DISTINCT fw, rev FROM requests)
SELECT (CASE WHEN a < 96 THEN a ELSE 999 END)::INT AS rev, (CASE WHEN b < 96 THEN b ELSE 999 END)::INT AS fw, EXISTS (SELECT 1 FROM u WHERE u.fw = CASE WHEN b < 96 THEN b ELSE 999 END AND u.rev = CASE WHEN a < 96 THEN a ELSE 999 END) AS caught FROM h""")
def decode_undetermined(spark, sf):
    code = lambda n: F.translate(F.lpad(F.conv(n.cast("string"), 10, 4), 5, "0"), "0123", "ACGT")
    numbers = rows(spark, sf, "SELECT DISTINCT o_orderkey % 120 AS a, o_orderkey % 130 AS b FROM orders")
    headers = numbers.select("a", "b", F.concat(Q.reverse_complement(code(F.col("a"))), F.lit("+"), Q.reverse_complement(code(F.col("b")))).alias("header"))
    primers = rows(spark, sf, "SELECT DISTINCT cast(o_orderkey % 96 AS int) AS primer FROM orders")
    return S.decode_undetermined(headers, primers.withColumn("sequence", code(F.col("primer"))), rows(spark, sf, "requests"), "nextseq").select("rev", "fw", "caught")


@query("extraction_stats", """
SELECT event_type, sum(user_id)::BIGINT AS total, sum(user_id // 2)::BIGINT AS good, round(sum(user_id // 2) / nullif(sum(user_id)::DOUBLE, 0), 9) AS good_share FROM events GROUP BY event_type""")
def extraction_stats(spark, sf):
    table = rows(spark, sf, "SELECT event_type, user_id || '(100%)' AS total, floor(user_id / 2) || '(' || event_id % 100 || '.5%)' AS good FROM events")
    return S.extraction_stats(table, ["total", "good"], "total", "event_type").withColumn("good_share", F.round("good_share", 9))


@query("stitch_log_summary", "SELECT 'S' || event_id AS sample, user_id AS total, user_id // 2 AS combined FROM events")
def stitch_log_summary(spark, sf):
    events = rows(spark, sf, "SELECT 'S' || event_id AS sample, user_id AS total, floor(user_id / 2) AS combined FROM events")
    logs = events.select(F.to_json(F.struct("sample", F.struct("total", "combined").alias("stitched"))).alias("line"))
    return S.stitch_log_summary(logs)


@query("good_samples", "SELECT 'S' || l_suppkey AS sample_id FROM lineitem GROUP BY l_suppkey HAVING sum(l_quantity) % 5 > 0")
def good_samples(spark, sf):
    reports = rows(spark, sf, "SELECT 'S' || l_suppkey AS sample_id, cast(sum(l_quantity) AS bigint) % 5 AS good_reads FROM lineitem GROUP BY l_suppkey")
    return S.good_samples(reports, rows(spark, sf, "sample_meta"))


_ARCHIVED = "SELECT DISTINCT 'L' || l_orderkey AS library_id, 'L' || l_orderkey || '_' || l_linenumber || '.fastq.gz' AS file FROM lineitem"


@query("archive_file_table", f"WITH f AS (SELECT library_id, list(file ORDER BY file) AS f FROM ({_ARCHIVED}) GROUP BY library_id) SELECT library_id, f[1] AS filename, {', '.join(f'f[{i}] AS filename{i}' for i in range(2, 8))}, 'AMPLICON' AS strategy FROM f")
def archive_file_table(spark, sf):
    return S.archive_file_table(rows(spark, sf, _ARCHIVED), spark.range(1).select(F.lit("AMPLICON").alias("strategy")), 7)


@query("biosample_table", "SELECT m.sample_id, 'Plasmodium' AS organism, CASE WHEN year = 2017 THEN 'not collected' ELSE site END AS geo_loc_name, year AS collection_date, 'blood' AS isolation_source, CASE WHEN length(m.sample_id) > 2 THEN 'ACC' || m.sample_id END AS accession FROM sample_meta AS m WHERE year <> 2016")
def biosample_table(spark, sf):
    meta = rows(spark, sf, "sample_meta").withColumns({"control": F.when(F.col("year") == 2016, True), "site": F.when(F.col("year") != 2017, F.col("site"))})
    return S.biosample_table(meta, meta.where("length(sample_id) > 2").select("sample_id", F.concat(F.lit("ACC"), "sample_id").alias("accession")))


# --- sequence expressions -------------------------------------------------------------------------------------------

_SEQ = "SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '') AS seq FROM documents"
_SEQ_SQL = "SELECT doc_id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS seq FROM documents"


def _seqs(spark, sf):
    return rows(spark, sf, _SEQ)


@query("reverse_complement", f"SELECT doc_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM ({_SEQ_SQL})")
def reverse_complement(spark, sf):
    return _seqs(spark, sf).select("doc_id", Q.reverse_complement(F.col("seq")).alias("rc"))


@query("gc_percent", f"SELECT doc_id, floor(length(translate(seq, 'AT', '')) * 100 / nullif(length(seq), 0))::INT AS gc FROM ({_SEQ_SQL})")
def gc_percent(spark, sf):
    return _seqs(spark, sf).select("doc_id", Q.gc_percent(F.col("seq")).alias("gc"))


_CODE = "'" + Q.GENETIC_CODE + "'"
_AT = "(position(substr(seq, 3 * i + 1, 1) IN 'TCAG') - 1) * 16 + (position(substr(seq, 3 * i + 2, 1) IN 'TCAG') - 1) * 4 + position(substr(seq, 3 * i + 3, 1) IN 'TCAG')"


@query("translate_codons", f"SELECT doc_id, array_to_string(list_transform(range(length(seq) // 3), lambda i: substr({_CODE}, ({_AT})::INT, 1)), '') AS protein FROM ({_SEQ_SQL})")
def translate_codons(spark, sf):
    return _seqs(spark, sf).select("doc_id", Q.translate_codons(F.col("seq")).alias("protein"))


@query("aa_code", "SELECT p_partkey, substr('AlaArgAsnAspCysGlnGlu', p_size % 7 * 3 + 1, 3) AS three, substr('ARNDCQE', p_size % 7 + 1, 1) AS one FROM part")
def aa_code(spark, sf):
    table = rows(spark, sf, "SELECT p_partkey, substr('ARNDCQE', p_size % 7 + 1, 1) AS a, substr('AlaArgAsnAspCysGlnGlu', p_size % 7 * 3 + 1, 3) AS b FROM part")
    return table.select("p_partkey", Q.aa_code(F.col("a")).alias("three"), Q.aa_code(F.col("b")).alias("one"))


@query("iupac_expand", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN unnest(['AAT', 'AGT']) ELSE unnest(['CGT', 'TGT']) END AS seq FROM part")
def iupac_expand(spark, sf):
    table = rows(spark, sf, "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'ART' ELSE 'YGT' END AS code FROM part")
    return table.select("p_partkey", F.explode(Q.iupac_expand(F.col("code"))).alias("seq"))


@query("degenerate_code", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'N' ELSE NULL END AS code FROM part")
def degenerate_code(spark, sf):
    table = rows(spark, sf, "SELECT p_partkey, split(CASE p_size % 3 WHEN 0 THEN 'g,A,A' WHEN 1 THEN 'T,G,C,A' ELSE 'Z' END, ',') AS bases FROM part")
    return table.select("p_partkey", Q.degenerate_code(F.col("bases")).alias("code"))


@query("cigar_lengths", "SELECT p_partkey, p_size + 20 + 7::BIGINT AS m, 2::BIGINT AS s, (p_size + 34)::BIGINT AS reference_length FROM part")
def cigar_lengths(spark, sf):
    table = rows(spark, sf, "SELECT p_partkey, '2S' || (p_size + 20) || 'M1I5D7M' AS cigar FROM part")
    return table.select("p_partkey", Q.cigar_lengths(F.col("cigar"))["M"].alias("m"), Q.cigar_lengths(F.col("cigar"))["S"].alias("s"), Q.reference_length(F.col("cigar")).alias("reference_length"))


# published values, per pair of neighbours: enthalpy (cal/mol) and entropy (cal/mol K)
_TM_H = "CASE WHEN d IN ('AA', 'TT') THEN -7900 WHEN d IN ('AT', 'TA') THEN -7200 WHEN d IN ('CA', 'TG') THEN -8500 WHEN d IN ('GT', 'AC') THEN -8400 WHEN d IN ('CT', 'AG') THEN -7800 WHEN d IN ('GA', 'TC') THEN -8200 WHEN d = 'CG' THEN -10600 WHEN d = 'GC' THEN -9800 WHEN d IN ('GG', 'CC') THEN -8000 END"
_TM_S = "CASE WHEN d IN ('AA', 'TT') THEN -22.2 WHEN d = 'AT' THEN -20.4 WHEN d = 'TA' THEN -21.3 WHEN d IN ('CA', 'TG') THEN -22.7 WHEN d IN ('GT', 'AC') THEN -22.4 WHEN d IN ('CT', 'AG') THEN -21.0 WHEN d IN ('GA', 'TC') THEN -22.2 WHEN d = 'CG' THEN -27.2 WHEN d = 'GC' THEN -24.4 WHEN d IN ('GG', 'CC') THEN -19.9 END"
_TM_SEQ = "SELECT p_partkey, 'ACG' || translate(cast(p_partkey * 7654321 AS string), '0123456789', 'ACGTTGCAAC') || 'TTGC' AS seq FROM part"


@query("nearest_neighbor_tm", f"""
WITH q AS ({_TM_SEQ}), x AS (SELECT *, list_transform(range(1, length(seq)), lambda i: substr(seq, i::INT, 2)) AS ds, floor(100.0 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq)) / 100 AS gc FROM q),
e AS (SELECT *, list_sum(list_transform(ds, lambda d: ({_TM_H})::DOUBLE)) + list_sum(list_transform([left(seq, 1), right(seq, 1)], lambda c: CASE WHEN c IN ('G', 'C') THEN 100.0 ELSE 2300.0 END)) AS h,
  list_sum(list_transform(ds, lambda d: ({_TM_S})::DOUBLE)) + list_sum(list_transform([left(seq, 1), right(seq, 1)], lambda c: CASE WHEN c IN ('G', 'C') THEN -2.8 ELSE 4.1 END)) AS s FROM x),
k AS (SELECT *, h / (s + 1.987::DOUBLE * ln(0.25e-9::DOUBLE)) AS dry, ln(0.05::DOUBLE) AS na, 0.0015::DOUBLE AS mg0 FROM e),
f AS (SELECT *, (-(1 - 30000 * mg0) + sqrt(pow(1 - 30000 * mg0, 2) + 4 * 30000 * mg0)) / 60000 AS mg FROM k),
g AS (SELECT *, 3.92 * (0.843 - 0.352 * sqrt(0.05::DOUBLE) * na) AS a, 1.42 * (1.279 - 4.03e-3 * na - 8.03e-3 * na * na) AS b, 8.31 * (0.486 - 0.258 * na + 5.25e-3 * na * na * na) AS c FROM f)
SELECT p_partkey, round(dry / (dry * 1e-5 * (a - 0.911 * ln(mg) + gc * (6.26 + b * ln(mg)) + (-48.2 + 52.5 * ln(mg) + c * ln(mg) * ln(mg)) / (2 * (length(seq) - 1))) + 1) - 273.15, 6) AS tm FROM g""")
def nearest_neighbor_tm(spark, sf):
    return rows(spark, sf, _TM_SEQ).select("p_partkey", F.round(Q.nearest_neighbor_tm(F.col("seq"), 0.25, 50, 1.5), 6).alias("tm"))



@query("chromosome_alias", "SELECT p_partkey, 'Pf3D7_' || lpad((p_size % 14 + 1)::VARCHAR, 2, '0') || '_v3' AS assembly FROM part")
def chromosome_alias(spark, sf):
    return rows(spark, sf, "SELECT p_partkey, 'chr' || (p_size % 14 + 1) AS c FROM part").select("p_partkey", Q.chromosome_alias(F.col("c"), to_standard=False).alias("assembly"))


@query("unmask", "SELECT p_partkey, upper(p_name) AS seq FROM part")
def unmask(spark, sf):
    return rows(spark, sf, "SELECT p_partkey, p_name FROM part").select("p_partkey", Q.unmask(F.col("p_name")).alias("seq"))


@query("alphanumerize", "SELECT p_partkey, regexp_replace(p_type || '_x', '[^A-Za-z0-9-]', '-', 'g') AS name FROM part")
def alphanumerize(spark, sf):
    return rows(spark, sf, "SELECT p_partkey, p_type || '_x' AS t FROM part").select("p_partkey", Q.alphanumerize(F.col("t")).alias("name"))


@query("fasta_to_fastq", f"SELECT doc_id, '@' || doc_id || chr(10) || seq || chr(10) || '+' || chr(10) || repeat('H', length(seq)) AS record FROM ({_SEQ_SQL})")
def fasta_to_fastq(spark, sf):
    return _seqs(spark, sf).select("doc_id", Q.fasta_to_fastq(F.col("doc_id").cast("string"), F.col("seq")).alias("record"))
