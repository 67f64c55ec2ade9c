"""Writers of the suite's files. All write folders of part files, as many as there are tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import ranked, spread_join
from .readers import PLINK_KINDS


def write_long(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def wide_matrix(df: DataFrame, row: str, column: str, values: Sequence[str], value: str) -> DataFrame:
    """One column for each named value; wide tables are for export only."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.first(value))


def _cell(c: Column) -> Column:
    """A cell of a comma-separated file: quoted where it has to be."""
    text = c.cast("string")
    return F.when(text.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def matrix_lines(df: DataFrame, row: str, levels: Sequence[str], value: str, names: Sequence[str] | None = None) -> DataFrame:
    """Comma-separated lines of a matrix, column line: first a header line for each level, then one line for each row's name, without a pivot.

    df: row, the levels and value. The columns of the matrix are the different tuples of levels, in order; each gets a
    place, and a row's line is made of its values by place, with commas for those that it lacks. Of repeated cells the
    greatest value counts. names: what the header lines begin with, the levels' names unless given. A line has to fit in
    memory, nothing else does.
    """
    levels = list(levels)
    columns = ranked(df.select(*levels).distinct(), *levels)
    columns = materialize(columns.withColumn("_at", F.col("rank") + 1).drop("rank"), "columns")
    width = columns.count()
    heads = columns.select("_at", F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.coalesce(_cell(F.col(c)), F.lit("")).alias("cell")) for i, c in enumerate(levels)])).alias("h"))
    begins = F.element_at(F.array(*map(F.lit, names or levels)), F.col("level") + 1)
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("_at", c.alias("v")))), lambda x: x["v"])
    header = heads.select("_at", "h.*").groupBy("level").agg(in_order(F.col("cell")).alias("cells")).select(F.lit(0).alias("kind"), F.col("level").cast("string").alias("order"), F.concat_ws(",", _cell(begins), F.array_join("cells", ",")).alias("line"))
    cells = df.where(F.col(value).isNotNull()).groupBy(row, *levels).agg(F.max(value).alias("_v"))
    own = [cells[c].eqNullSafe(columns[c]) for c in levels]
    placed = cells.join(columns, own).select(row, "_at", _cell(F.col("_v")).alias("_v"))
    named = placed.unionByName(df.select(row).distinct(), allowMissingColumns=True)  # a row without values has its line
    filled = F.sort_array(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_v"))))
    rows = named.groupBy(row).agg(filled.alias("c"))
    gap = F.transform("c", lambda x, i: F.concat(F.repeat(F.lit(","), (x["_at"] - F.coalesce(F.get(F.col("c"), i - 1)["_at"], F.lit(0))).cast("int")), x["_v"]))
    end = F.repeat(F.lit(","), (F.lit(width) - F.coalesce(F.get(F.col("c"), F.size("c") - 1)["_at"], F.lit(0))).cast("int"))
    body = rows.select(F.lit(1).alias("kind"), F.col(row).cast("string").alias("order"), F.concat(F.coalesce(_cell(F.col(row)), F.lit("")), F.array_join(gap, ""), end).alias("line"))
    return header.unionByName(body).orderBy("kind", "order").select("line")


def write_wide_matrix(df: DataFrame, path: str, row: str, column: str, value: str) -> None:
    """A comma-separated table with one column for each value of column: its names, then rows. The first part file has the header."""
    write_lines(matrix_lines(df, row, [column], value, [row]), path)


def write_header_matrix(df: DataFrame, path: str, row: str, levels: Sequence[str], value: str) -> None:
    """A matrix under header lines of several levels, as read_wide_matrix() reads it."""
    write_lines(matrix_lines(df, row, levels, value), path)


def fastq_record(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), name), seq, F.lit("+"), qual)


def write_fastq_per_sample(reads: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """A folder per sample of gzipped files of about per_file records. reads: sample_id, name, seq, qual."""
    out = reads.select("sample_id", fastq_record(F.col("name"), F.col("seq"), F.col("qual")).alias("value"))
    parts = out.groupBy("sample_id").agg(F.count("*").alias("n")).select("sample_id", "n", F.ceil(F.col("n") / per_file).alias("_parts"))
    dealt = spread_join(out, parts, ["sample_id"]).repartition("sample_id", F.pmod(F.xxhash64("value"), F.col("_parts"))).drop("_parts")
    dealt.write.partitionBy("sample_id").text(path, compression="gzip")


def fasta_record(name: Column, seq: Column, width: int = 60) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n")))


def write_fasta(df: DataFrame, path: str) -> None:
    df.select(fasta_record(F.col("id"), F.col("seq")).alias("value")).write.text(path)


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """One text line per row: PLINK tables, VCF lines, JSON parts."""
    df.select(F.col(column).alias("value")).write.text(path)


def write_plink(tables: Sequence[DataFrame], path: str) -> None:
    """The ped, map, geno and hlist tables (column line, and for the map chrom, pos and variant) as folders of text.

    The map's lines are in the order of the ped's columns, over all of its part files.
    """
    ped, places, geno, genes = tables
    for kind, table in zip(PLINK_KINDS, (ped, places.orderBy("chrom", "pos", "variant"), geno, genes), strict=True):
        write_lines(table, f"{path}/{kind}")


def write_pmo(parts: DataFrame, path: str) -> None:
    """The parts of a portable microhaplotype document (kind, panel_id, run_id, json) as JSON lines, a folder for each kind."""
    parts.write.partitionBy("kind").json(path)


def filter_vcf_lines(lines: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Header lines, and the raw lines of sites whose FILTER names none of the tags."""
    named = F.arrays_overlap(F.split(F.get(F.split("value", "\t"), F.lit(6)), ";"), F.array(*map(F.lit, tags)))
    return lines.where(F.col("value").startswith("#") | ~F.coalesce(named, F.lit(False)))


def target_vcf(targets: DataFrame) -> DataFrame:
    """Sites-only lines of a target list (chrom, pos, ref, alt), in order of place within each chromosome."""
    dot = F.lit(".")
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), dot, "ref", "alt", dot, dot, dot)
    return targets.select("chrom", "pos", line.alias("line")).orderBy("chrom", "pos")
