"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Views that play the part of sequencing tables, in SQL that Spark and other engines read alike.
VIEWS: dict[str, str] = {
    # haplotype calls: one row per sample, probe, haplotype and library
    "calls": """
        SELECT 'S' || l_suppkey AS sample_id, 'gene' || (l_partkey % 40) % 8 AS gene, 'mip' || l_partkey % 40 AS mip,
          'mip' || l_partkey % 40 || '.' || l_linenumber AS haplotype_id,
          'ACGTTGCA' || translate(cast((l_partkey % 40) * 10 + l_linenumber AS string), '0123456789', 'ACGTTGCAAC') || 'TTGACA' AS haplotype_sequence,
          'q' || l_linestatus || l_linenumber AS sequence_quality, cast(l_quantity AS bigint) * (1 + l_linenumber) AS read_count,
          cast(l_quantity AS bigint) AS umi_count, 'lib' || l_returnflag AS library_prep, l_orderkey AS ord
        FROM lineitem""",
    "probe_copies": """
        SELECT DISTINCT 'gene' || (l_partkey % 40) % 8 AS gene, 'mip' || l_partkey % 40 AS mip, 'C' || c.k AS copy,
          'chr' || ((l_partkey % 40) % 5 + 1 + c.k) AS chrom, (l_partkey % 40) * 1000 + c.k * 50000 AS capture_start,
          (l_partkey % 40) * 1000 + c.k * 50000 + 160 + l_partkey % 40 AS capture_end,
          CASE WHEN (l_partkey % 40) % 2 = 0 THEN 'forward' ELSE 'reverse' END AS orientation
        FROM lineitem JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS c ON c.k = 0 OR (l_partkey % 40) % 3 = 0""",
    # haplotypes placed on copies, as an aligner reports them
    "alignments": """
        SELECT DISTINCT 'mip' || l_partkey % 40 || '.' || l_linenumber AS haplotype_id, 'mip' || l_partkey % 40 AS mip,
          'chr' || ((l_partkey % 40) % 5 + 1 + c.k) AS chrom,
          (l_partkey % 40) * 1000 + c.k * 50000 + (l_linenumber * 37) % 300 AS pos,
          200 - (l_linenumber * (1 + c.k)) % 9 AS alignment_score
        FROM lineitem JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS c ON c.k = 0 OR l_linenumber % 3 = 0""",
    "mapped": """
        SELECT 'S' || l_suppkey AS sample_id, 'gene' || (l_partkey % 40) % 8 AS gene, 'mip' || l_partkey % 40 AS mip,
          'mip' || l_partkey % 40 || '.' || l_linenumber AS haplotype_id, 'C' || c.k AS copy,
          CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE 1 END AS mapped_copy_number,
          cast(l_quantity AS bigint) AS umi_count, cast(l_quantity AS bigint) * (1 + l_linenumber) AS read_count
        FROM (SELECT l_suppkey, l_partkey, l_linenumber, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY l_suppkey, l_partkey, l_linenumber) AS l
        JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS c ON c.k = 0 OR l_linenumber % 3 = 0""",
    # allele depths: one row per sample and variant
    "depths": """
        SELECT 'S' || l_suppkey AS sample_id, 'gene' || (l_partkey % 60) % 6 || '-Ala' || l_partkey % 60 || 'Val' AS variant,
          'gene' || (l_partkey % 60) % 6 AS gene, CASE WHEN (l_partkey % 60) % 7 = 0 THEN 'Yes' ELSE 'No' END AS targeted,
          cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS bigint) AS alt,
          cast(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS bigint) AS ref,
          cast(sum(l_quantity) AS bigint) AS coverage
        FROM lineitem GROUP BY l_suppkey, l_partkey % 60""",
    # sites with several alternate alleles, as a caller reports them: one row per site and sample
    "site_calls": """
        SELECT 'chr' || (v % 14 + 1) AS chrom, v * 100 + 7 AS pos, CASE v % 4 WHEN 0 THEN 'AC' WHEN 1 THEN 'A' WHEN 2 THEN 'AGT' ELSE 'G' END AS ref,
          CASE v % 4 WHEN 0 THEN 'GT' WHEN 1 THEN 'G,T' WHEN 2 THEN 'A' ELSE 'GCC' END AS alt, cast(v % 50 + 1 AS double) AS qual,
          CASE WHEN v % 5 = 0 THEN 'LowQual;Bias' WHEN v % 5 = 1 THEN 'Bias' ELSE 'PASS' END AS filter, 'S' || s AS sample_id,
          CASE WHEN v % 4 = 1 THEN a || ',' || b ELSE cast(a AS string) END AS ao, CASE WHEN v % 4 = 1 THEN a * 30 || ',' || b * 20 ELSE cast(a * 25 AS string) END AS qa,
          cast(r AS double) AS ro, cast(r * 28 AS double) AS qr, cast(a + b + r AS double) AS dp, cast((v * 7 + s) % 99 AS double) AS gq,
          CASE WHEN (v + s) % 5 = 0 THEN '0/0' WHEN (v + s) % 5 = 1 THEN '0/1' WHEN (v + s) % 5 = 2 THEN '1/1' WHEN (v + s) % 5 = 3 THEN './.' ELSE '1/2' END AS gt,
          'X|' || CASE WHEN v % 3 = 2 THEN 'synonymous_variant' ELSE 'missense_variant' END || '|M|n|ID' || v % 8 || '|t|f|b|1|c|p.' ||
            CASE WHEN v % 3 = 0 THEN 'AspGlu' || (v + 10) || 'HisGln' WHEN v % 3 = 1 THEN 'LysAsp' || (v + 10) || 'ThrAsp' ELSE 'Ala' || (v + 10) || 'Ala' END || '|x,Y|other|' AS ann
        FROM (SELECT l_suppkey AS s, l_partkey % 60 AS v, cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS bigint) AS a,
          cast(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS bigint) AS b, cast(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS bigint) AS r
          FROM lineitem GROUP BY l_suppkey, l_partkey % 60)""",
    # the same after splitting, with annotation: one row per site, allele and sample
    "allele_calls": """
        SELECT 'chr' || (v % 14 + 1) AS chrom, v * 100 + 7 AS pos, 'A' AS ref, 'G' AS alt, cast(v % 50 + 1 AS double) AS qual, 'ID' || v % 8 AS gene_id,
          'gene' || v % 8 AS gene, CASE WHEN v % 3 = 2 THEN 'synonymous_variant' ELSE 'missense_variant' END AS effect,
          CASE WHEN v % 3 = 0 THEN 'AspGlu' || (v % 16 + 10) || 'HisGln' WHEN v % 3 = 1 THEN 'LysAsp' || (v % 16 + 10) || 'ThrAsp' ELSE 'Ala' || (v + 10) || 'Ala' END AS aa_change,
          'S' || s AS sample_id, cast(a AS double) AS ao, cast(r AS double) AS ro, cast(a + r AS double) AS dp, cast(a * ((v + s) % 40) AS double) AS qa,
          cast(r * ((v * 3 + s) % 40) AS double) AS qr, cast((v * 7 + s) % 99 AS double) AS gq, CASE WHEN (v + s) % 4 < 3 THEN cast((v + s) % 4 AS int) END AS genotype
        FROM (SELECT l_suppkey AS s, l_partkey % 60 AS v, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS a,
          sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS r FROM lineitem GROUP BY l_suppkey, l_partkey % 60)""",
    "transcripts": """
        SELECT 'NM' || p_partkey AS name, 'gene' || p_partkey % 700 AS gene, CASE WHEN p_partkey % 97 = 5 THEN 'chr1_alt' ELSE 'chr' || (p_partkey % 700 % 14 + 1) END AS chrom,
          CASE WHEN p_partkey % 700 % 2 = 0 THEN '+' ELSE '-' END AS strand, b AS tx_start, b + 900 AS tx_end, b + 120 AS cds_start, b + 720 AS cds_end,
          b AS e0, b + 200 + p_size AS f0, b + 300 AS e1, b + 380 + p_size AS f1, b + 600 AS e2, b + 900 AS f2
        FROM (SELECT p_partkey, p_size, cast(p_partkey % 700 * 1000 + 1000 AS bigint) AS b FROM part)""",
    "exon_rows": """
        SELECT name, gene, chrom, strand, e0 + 1 AS start, f0 AS stop FROM transcripts UNION ALL SELECT name, gene, chrom, strand, e1 + 1, f1 FROM transcripts
        UNION ALL SELECT name, gene, chrom, strand, e2 + 1, f2 FROM transcripts""",
    "phenotype": "SELECT 'S' || s_suppkey AS sample_id, s_suppkey % 3 = 0 AS affected FROM supplier WHERE s_suppkey % 5 <> 4",
    "sample_meta": """
        SELECT 'S' || s_suppkey AS sample_id, n_name AS site, r_name AS region, cast(s_nationkey * 2.5 - 30 AS double) AS latitude, cast(s_nationkey * 3.25 AS double) AS longitude,
          2015 + s_suppkey % 5 AS year
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "intervals": """
        SELECT 'chr' || (l_suppkey % 14 + 1) AS chrom, l_partkey * 100 + l_linenumber * 7 AS start,
          l_partkey * 100 + l_linenumber * 7 + cast(l_quantity AS bigint) AS stop
        FROM lineitem""",
    "targets": """
        SELECT 'target' || p_partkey AS name, 'chr' || (p_partkey % 14 + 1) AS chrom, p_partkey * 100 AS start, p_partkey * 100 + p_size * 4 AS stop,
          CASE WHEN p_size % 3 = 0 THEN 'whole' WHEN p_size % 3 = 1 THEN 'exons' ELSE 'targets' END AS capture_type
        FROM part""",
    "requests": """
        SELECT 'N' || o_custkey AS sample_name, o_orderpriority AS sample_set, nullif(cast(o_orderkey % 4 AS int), 0) AS replicate, o_orderkey AS ord,
          CASE WHEN o_orderkey % 3 = 0 THEN 'DR1,VAR4' WHEN o_orderkey % 3 = 1 THEN 'dr1' ELSE 'IBC' END AS probe_set,
          cast(o_orderkey % 96 AS int) AS fw, cast(o_orderkey % 89 AS int) AS rev
        FROM orders""",
}


def _expand(sql: str, seen: tuple[str, ...] = ()) -> list[str]:
    """Views that a statement needs, in order of use."""
    out: list[str] = []
    for name in VIEWS:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            for x in [*_expand(VIEWS[name], (*seen, name)), name]:
                if x not in out:
                    out.append(x)
    return out


def with_views(sql: str) -> str:
    """A statement with the views that it names in front."""
    ctes = [f"{v} AS ({VIEWS[v]})" for v in _expand(sql)]
    body = sql.strip()
    if not ctes:
        return body
    if re.match(r"WITH RECURSIVE\b", body, re.I):
        return "WITH RECURSIVE " + ", ".join(ctes) + ", " + body[len("WITH RECURSIVE") :]
    return "WITH " + ", ".join(ctes) + (", " + body[4:] if re.match(r"WITH\b", body, re.I) else " " + body)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The result of a statement over tables and views of this module, lazily."""
    full = with_views(sql if re.match(r"\s*(SELECT|WITH)\b", sql, re.I) else f"SELECT * FROM {sql}")
    used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN|,)\s+{t}\b", full)]
    return spark.sql(re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(used)})\b", r"\1 {\2}", full), **{t: table(spark, sf_dir, t) for t in used})


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL unless SQL can't express it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return f

    return add
