"""Genotypes, prevalences and what is computed from them. Long tables with sample_id, variant, alt, ref, coverage."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .intervals import overlap_join

#: A matrix with more columns than this doesn't go through the covariance, which is built on one machine.
MAX_PCA_COLUMNS = 4000


def call_genotypes(depths: DataFrame, min_count: int, min_coverage: int, min_freq: float) -> DataFrame:
    """wsaf, genotype (0, 1, 2) and prevalence (0, 1); null without coverage.

    Counts and coverages below their minima are 0; a frequency below min_freq is no call of the allele, and one of
    1 - min_freq or more is a call of it alone.
    """
    alt = F.when(F.col("alt") < min_count, 0).otherwise(F.col("alt"))
    cov = F.when(F.col("coverage") < min_coverage, 0).otherwise(F.col("coverage"))
    w = F.try_divide(alt.cast("double"), cov)
    zero = (F.col("wsaf") == 0) | (F.col("wsaf") < min_freq)
    out = depths.withColumns({"filtered_alt": alt, "filtered_coverage": cov, "wsaf": w})
    genotype = F.when(F.col("wsaf").isNull(), None).when(zero, 0).when(F.col("wsaf") < 1 - min_freq, 1).otherwise(2)
    return out.withColumns({"genotype": genotype, "prevalence": F.when(F.col("wsaf").isNull(), None).when(zero, 0).otherwise(1)})


def genotype_label(depths: DataFrame, cutoff: float) -> DataFrame:
    """WT, MIX or MUT by the allele's share; null without coverage."""
    share = F.try_divide(F.col("alt").cast("double"), F.col("coverage"))
    return depths.withColumn("label", F.when(share.isNull(), None).when(share >= cutoff, F.when(share > 1 - cutoff, "MUT").otherwise("MIX")).otherwise("WT"))


def keep_variants(called: DataFrame, min_wsaf: float, samples_wsaf: int, min_umi: int, samples_umi: int) -> DataFrame:
    """Rows of variants that are targeted, or are frequent in at least, and deep in more than, so many samples."""
    stats = called.groupBy("variant").agg(F.max(F.col("targeted") == "Yes").alias("t"), F.count(F.when(F.col("wsaf") > min_wsaf, 1)).alias("w"), F.count(F.when(F.col("filtered_alt") >= min_umi, 1)).alias("u"))
    kept = stats.where(F.col("t") | ((F.col("w") >= samples_wsaf) & (F.col("u") > samples_umi)))
    return called.join(kept.select("variant"), "variant", "left_semi")


def filter_by_missingness(table: DataFrame, value: str = "genotype", sample_drop: float | None = None, variant_drop: float | None = None, remove_zero: bool = False) -> DataFrame:
    """Drop variants without any allele, then samples, then variants with too large a share of missing values.

    A cell without a row is missing. The second share counts surviving samples only.
    """
    if remove_zero:
        some = table.groupBy("variant").agg(F.sum(value).alias("s")).where("s > 0")
        table = table.join(some.select("variant"), "variant", "left_semi")
    if sample_drop is not None:
        width = table.agg(F.countDistinct("variant").alias("_w"))
        called = table.groupBy("sample_id").agg(F.count(value).alias("n")).crossJoin(F.broadcast(width))  # one row on the right
        table = table.join(called.where(F.col("n") >= F.col("_w") * (1 - sample_drop)).select("sample_id"), "sample_id", "left_semi")
    if variant_drop is not None:
        height = table.agg(F.countDistinct("sample_id").alias("_h"))
        called = table.groupBy("variant").agg(F.count(value).alias("n")).crossJoin(F.broadcast(height))  # one row on the right
        table = table.join(called.where(F.col("n") >= F.col("_h") * (1 - variant_drop)).select("variant"), "variant", "left_semi")
    return table


def impute(table: DataFrame, how: str, value: str = "genotype") -> DataFrame:
    """Missing values become the variant's mode (the least of ties), mean or median."""
    if how == "mode":
        counts = table.where(F.col(value).isNotNull()).groupBy("variant", value).agg(F.count("*").alias("n"))
        fill = counts.groupBy("variant").agg(F.min(F.struct(-F.col("n"), F.col(value)))[value].cast("double").alias("_fill"))
    else:
        fill = table.groupBy("variant").agg((F.avg(value) if how == "mean" else F.expr(f"percentile({value}, 0.5)")).alias("_fill"))
    return table.join(fill, "variant").withColumn("imputed", F.coalesce(F.col(value).cast("double"), "_fill")).drop("_fill")


def presence_matrix(table: DataFrame, value: str, minimum: float, sample_present: float, variant_present: float) -> DataFrame:
    """1 above the minimum, else 0; variants without any 1 go; samples and variants need a share of known values; gaps get the mode."""
    seen = table.withColumn("present", F.when(F.col(value) > minimum, 1).when(F.col(value).isNotNull(), 0))
    kept = filter_by_missingness(seen, "present", 1 - sample_present, 1 - variant_present, remove_zero=True)
    return impute(kept, "mode", "present")


def _rows(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column.flatten()) else np.zeros((len(column), 0))


def _listed(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _products(rows: DataFrame, known: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows (y, w): the sums of y's columns times w's, and of w's times w's. A few numbers for each column leave a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((known + width, width))
        for batch in batches:
            y, w = _rows(batch.column("y")), _rows(batch.column("w"))
            if len(w):
                total += np.concatenate([y.reshape(len(w), known), w], axis=1).T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    sums = rows.select("y", "w").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # (known + width) * width rows
    total = np.zeros((known + width) * width)
    for r in sums:
        total[r["at"]] = r["v"]
    total = total.reshape(known + width, width)
    return total[:known], total[known:]


def _combined(rows: DataFrame, away: np.ndarray, mixed: np.ndarray, append: bool) -> DataFrame:
    """Rows (sample_id, y, w) with (w - y @ away) @ mixed for w, or appended to y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = _rows(batch.column("w"))
                y = _rows(batch.column("y")).reshape(len(w), len(away))
                new = (w - y @ away) @ mixed
                y, w = (np.concatenate([y, new], axis=1), new) if append else (y, new)
                yield pa.RecordBatch.from_arrays([batch.column("sample_id"), _listed(y), _listed(w)], names=["sample_id", "y", "w"])

    return materialize(rows.select("sample_id", "y", "w").mapInArrow(run, rows.select("sample_id", "y", "w").schema), "basis")


def _wide_pca(centred: DataFrame, k: int, extra: int = 6, steps: int = 40) -> DataFrame:
    """Principal components of a long centred table (sample_id, variant, _c), by blocks of products with it.

    Random starts, the same ones on every run, are multiplied by the table and its transpose in turn; what comes out is
    made orthonormal to all before, in small matrices, and the best components within all of it are taken. It ends when
    they stay the same, or nothing new comes out. The table only meets thin blocks of k + extra numbers for a sample or
    a variant; no sample's row is put together.
    """
    width = k + extra
    summed = lambda name: [F.sum(F.col("_c") * F.col(name)[i]) for i in range(width)]
    start = [F.sum(F.col("_c") * (F.xxhash64("variant", F.lit(i)) / float(1 << 63))) for i in range(width)]
    whole = centred.agg(F.sum(F.col("_c") * F.col("_c"))).first()[0] or 0.0
    block = centred.groupBy("sample_id").agg(F.array(*start).alias("w"))
    rows = materialize(block.select("sample_id", F.array().cast("array<double>").alias("y"), "w"), "basis")
    known, products, values, vectors = 0, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0))
    for step in range(steps + 1):
        first, _ = _products(rows, known, width)
        if step:  # the last block's products with the table and its transpose, in terms of all blocks
            new = known - len(products)
            products = np.pad(products, (0, new))
            products[:, -new:], products[-new:, :] = first[:, :new], first[:, :new].T
            before = values[:k]
            values, vectors = np.linalg.eigh((products + products.T) / 2)
            values, vectors = values[::-1], vectors[:, ::-1]
            if len(before) == len(values[:k]) and np.allclose(before, values[:k], rtol=1e-13, atol=0):
                break
        rows = _combined(rows, first, np.eye(width), False)
        again, gram = _products(rows, known, width)
        sizes, axes = np.linalg.eigh(gram - again.T @ again)
        fresh = sizes > 1e-12 * max(float(np.trace(gram)) if step == 0 else whole, 1e-300)
        if not fresh.any() or step == steps:
            break
        rows = _combined(rows, again, axes[:, fresh] / np.sqrt(sizes[fresh]), True)
        size = int(fresh.sum())
        known += size
        # what is appended is multiplied by the transposed table, then by the table; columns beyond it are zero
        last = rows.select("sample_id", F.concat("w", F.array_repeat(F.lit(0.0), width - size)).alias("q"))
        by_variant = centred.join(last, "sample_id").groupBy("variant").agg(F.array(*summed("q")).alias("z"))
        block = centred.join(by_variant, "variant").groupBy("sample_id").agg(F.array(*summed("z")).alias("w"))
        rows = materialize(rows.select("sample_id", "y").join(block, "sample_id"), "basis")
    top = min(k, len(values))
    weights = np.zeros((known, k))
    weights[: len(vectors), :top] = vectors[:, :top] * np.sqrt(np.maximum(values[:top], 0))
    share = [float(max(values[i], 0) / whole) if i < top and whole else 0.0 for i in range(k)]
    parts = F.array(*[F.aggregate(F.zip_with("y", F.array(*map(F.lit, weights[:, i].tolist())).cast("array<double>"), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x) for i in range(k)])
    return rows.select("sample_id", parts.alias("components"), F.array(*map(F.lit, share)).alias("explained"))


def pca(table: DataFrame, k: int, value: str = "imputed") -> DataFrame:
    """sample_id, components (array) and explained (array): principal components of the centred samples x variants matrix.

    A sample without a row or value of a variant counts as the variant's mean. Up to MAX_PCA_COLUMNS variants by the
    covariance matrix on one machine; wider matrices by products of the long table with thin blocks. Signs are arbitrary.
    """
    width = table.select("variant").distinct().count()
    centred = table.withColumn("_c", F.coalesce(F.col(value) - F.avg(value).over(Window.partitionBy("variant")), F.lit(0.0)))
    if width > MAX_PCA_COLUMNS:
        return _wide_pca(materialize(centred.select("sample_id", "variant", "_c"), "centred"), k)
    cells = centred.select("sample_id").distinct().crossJoin(F.broadcast(centred.select("variant").distinct()))  # MAX_PCA_COLUMNS names at most
    cells = cells.join(centred.select("sample_id", "variant", "_c"), ["sample_id", "variant"], "left").na.fill(0.0, ["_c"])
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("variant", "_c"))), lambda x: x["_c"])
    vectors = cells.groupBy("sample_id").agg(ordered.alias("v")).select("sample_id", array_to_vector("v").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="components").fit(vectors)
    share = [float(x) for x in model.explainedVariance.toArray()]
    return model.transform(vectors).select("sample_id", vector_to_array("components").alias("components"), F.array(*map(F.lit, share)).alias("explained"))


def prevalence_by_site(called: DataFrame, meta: DataFrame, mutations: DataFrame | None = None) -> DataFrame:
    """Per site and mutation, and over all sites ('overall'): alt, coverage, prevalence, mean coordinates."""
    rows = called.join(meta.select("sample_id", "site", "latitude", "longitude"), "sample_id")
    if mutations is not None:
        rows = rows.join(mutations.select("variant").distinct(), "variant", "left_semi")
    out = rows.groupingSets([("site", "variant"), ("variant",)], "site", "variant").agg(
        F.grouping("site").alias("_all"), F.coalesce(F.sum(F.when(F.col("prevalence") > 0, 1)), F.lit(0)).alias("alt"), F.count("prevalence").alias("coverage"), F.round(F.avg("latitude"), 7).alias("latitude"), F.round(F.avg("longitude"), 7).alias("longitude")
    )
    share = F.round(F.try_divide(F.col("alt").cast("double"), F.col("coverage")), 4)
    return out.withColumns({"site": F.when(F.col("_all") == 1, "overall").otherwise(F.col("site")), "prevalence": share}).drop("_all")


def duplicate_mutations(names: DataFrame) -> DataFrame:
    """Mutation names that stand for more than one column."""
    return names.groupBy("variant").count().where("count > 1")


def prevalence_text(table: DataFrame) -> DataFrame:
    """The text form 'p (alt/coverage)'."""
    return table.withColumn("text", F.concat(F.col("prevalence").cast("string"), F.lit(" ("), F.col("alt").cast("string"), F.lit("/"), F.col("coverage").cast("string"), F.lit(")")))


def prevalence_text_parse(table: DataFrame, text: str = "text") -> DataFrame:
    return table.withColumn("value", F.split(text, " ")[0].cast("double"))


def prevalence_matrix(called: DataFrame, meta: DataFrame, mutations: Sequence[str]) -> DataFrame:
    """Mean prevalence by year and site, one column for each named mutation."""
    rows = called.join(meta.select("sample_id", "site", "year"), "sample_id")
    return rows.groupBy("year", "site").pivot("variant", list(mutations)).agg(F.avg("prevalence"))


def mutation_sort_key(names: DataFrame, name: str = "variant") -> DataFrame:
    """gene and residue position of names like gene-Ala12Val; insertions, deletions and duplications are left out."""
    out = names.where(~F.col(name).rlike("ins|del|dup"))
    return out.withColumns({"gene_part": F.regexp_extract(name, "^(.*)-", 1), "position": F.regexp_extract(name, "-[A-Za-z]+(\\d+)", 1).try_cast("int")}).orderBy("gene_part", "position", name)


def position_coverage(targets: DataFrame, probes: DataFrame) -> DataFrame:
    """UMIs of a sample's probes that span each target."""
    spans = probes.select("chrom", F.col("capture_start").alias("start"), F.col("capture_end").alias("stop"), "sample_id", "umi")
    over = overlap_join(targets.select("chrom", "name", "start", "stop"), spans, bin_size=1000).where("b_start <= start and b_stop >= stop")
    joined = over.select("name", F.col("b_sample_id").alias("sample_id"), F.col("b_umi").alias("umi"))
    return joined.groupBy("name", "sample_id").agg(F.sum("umi").alias("coverage"))


def complete_known_targets(calls: DataFrame, known: DataFrame, samples: DataFrame) -> DataFrame:
    """Calls with every known target of every sample; coordinates from the known list, counts 0 where there is no call."""
    grid = known.select("variant", "chrom", "pos").distinct().crossJoin(samples.select("sample_id").distinct())
    return calls.select("variant", "sample_id", "alt").join(grid, ["variant", "sample_id"], "full_outer").withColumn("alt", F.coalesce("alt", F.lit(0)))


def reference_total(depths: DataFrame, group: Sequence[str] = ("sample_id", "gene")) -> DataFrame:
    """Coverage less the counts of nonsynonymous alleles."""
    return depths.groupBy(*group).agg(F.max("coverage").alias("coverage"), F.coalesce(F.sum(F.when(F.col("nonsynonymous"), F.col("alt"))), F.lit(0)).alias("changed")).withColumn("reference", F.col("coverage") - F.col("changed"))


def parse_call_string(table: DataFrame, column: str = "call") -> DataFrame:
    """genotype, count and total of 'gen:count:total'; alleles is the number of alternate alleles, null if missing."""
    parts = F.split(column, ":")
    alleles = F.split(parts[0], "[/|]")
    number = F.when(F.array_contains(alleles, "."), None).otherwise(F.size(F.filter(alleles, lambda a: a != "0")))
    return table.withColumns({"gen": parts[0], "count": F.get(parts, F.lit(1)).try_cast("bigint"), "total": F.get(parts, F.lit(2)).try_cast("bigint"), "alleles": number})


def noncoding_name(table: DataFrame) -> DataFrame:
    return table.withColumn("name", F.concat_ws("-", "gene", "vkey"))


def plink_tables(genotypes: DataFrame, sites: DataFrame, phenotype: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """ped, map, geno and gene lists: text rows over the samples with a phenotype and a genotype, sites in the order of chrom and pos.

    Every line has every site: a sample without a row or with a null genotype at one has '0 0' there, and '.'. Of rows
    that repeat a sample and variant the greatest genotype counts.
    """
    called = genotypes.groupBy("sample_id", "variant").agg(F.max("genotype").alias("genotype"))
    people = phenotype.select("sample_id", "affected").join(called.select("sample_id").distinct(), "sample_id", "left_semi").distinct()
    # the files are samples x sites, whatever is known: both are dimension tables
    rows = people.crossJoin(sites.select("variant", "chrom", "pos", "ref", "alt").distinct()).join(called, ["sample_id", "variant"], "left")
    pair = F.when(F.col("genotype") == 0, F.concat_ws(" ", "ref", "ref")).when(F.col("genotype") == 1, F.concat_ws(" ", "ref", "alt")).when(F.col("genotype") == 2, F.concat_ws(" ", "alt", "alt")).otherwise("0 0")
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("chrom", "pos", "variant", c.alias("v")))), lambda x: x["v"])
    by_sample = rows.groupBy("sample_id", "affected").agg(F.array_join(in_order(pair), " ").alias("bases"), F.array_join(in_order(F.coalesce(F.col("genotype").cast("string"), F.lit("."))), "\t").alias("calls"))
    ped = by_sample.select("sample_id", F.concat_ws(" ", "sample_id", "sample_id", F.lit("0 0 0"), F.when(F.col("affected"), "2").otherwise("1"), "bases").alias("line"))
    geno = by_sample.select("sample_id", F.concat_ws("\t", "sample_id", "calls").alias("line"))
    places = sites.select("variant", "chrom", "pos", F.concat_ws("\t", "chrom", "variant", F.lit("0"), F.col("pos").cast("string")).alias("line"))
    genes = sites.groupBy("gene").agg(F.array_join(F.sort_array(F.collect_set("variant")), " ").alias("line"))
    return ped, places, geno, genes


def coi_encoding(called: DataFrame) -> DataFrame:
    """Half the genotype; -1 where it is missing."""
    return called.withColumn("coi", F.coalesce(F.col("genotype") / 2.0, F.lit(-1.0)))


def _tail(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """Two-sided Fisher p and chi-square p with Yates' correction of a 2x2 table."""
    n, row, col = a + b + c + d, a + b, a + c
    if not n:
        return 1.0, 1.0
    lg = math.lgamma
    fixed = lg(row + 1) + lg(n - row + 1) + lg(col + 1) + lg(n - col + 1) - lg(n + 1)
    log_p = lambda x: fixed - lg(x + 1) - lg(row - x + 1) - lg(col - x + 1) - lg(n - row - col + x + 1)
    own = log_p(a)
    fisher = sum(math.exp(p) for x in range(max(0, row + col - n), min(row, col) + 1) if (p := log_p(x)) <= own + 1e-7)
    margins = row * (n - row) * col * (n - col)
    if not margins:
        return min(1.0, fisher), 1.0
    chi = n * max(0.0, abs(a * d - b * c) - n / 2) ** 2 / margins
    return min(1.0, fisher), math.erfc(math.sqrt(chi / 2))


def _tests(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_tail(*map(int, x)) for x in zip(a, b, c, d, strict=True)], columns=["fisher_p", "chi_square_p"])


def contingency_tests(called: DataFrame, phenotype: DataFrame, key: Sequence[str] = ("variant",)) -> DataFrame:
    """Cases against controls for homozygous, heterozygous and any change against wild type: odds ratio and p values.

    Spark counts; the tests run once for each counted row.
    """
    rows = called.where("genotype is not null").join(phenotype, "sample_id")
    kinds = {"hom": F.col("genotype") == 2, "het": F.col("genotype") == 1, "any": F.col("genotype") > 0}
    cells = {f"{k}_{s}": F.count(F.when(c & (F.col("affected") == (s == "case")), 1)) for k, c in {**kinds, "wild": F.col("genotype") == 0}.items() for s in ("case", "control")}
    counts = rows.groupBy(*key).agg(*[v.alias(k) for k, v in cells.items()])
    tests = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_case").alias("case_alt"), F.col(f"{k}_control").alias("control_alt"), F.col("wild_case").alias("case_wild"), F.col("wild_control").alias("control_wild")) for k in kinds]))
    out = counts.select(*key, tests.alias("t")).select(*key, "t.*")
    odds = F.try_divide((F.col("case_alt") * F.col("control_wild")).cast("double"), F.col("control_alt") * F.col("case_wild"))
    out = out.withColumn("odds_ratio", odds).withColumn("_p", F.pandas_udf(_tests, "fisher_p double, chi_square_p double")("case_alt", "control_alt", "case_wild", "control_wild"))
    return out.select(*key, "kind", "case_alt", "control_alt", "case_wild", "control_wild", "odds_ratio", "_p.fisher_p", "_p.chi_square_p")


def call_concordance(calls: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Observed against expected presence: counts of the four outcomes, accuracy, precision, recall and call rate."""
    hit = lambda e, o: F.count(F.when((F.col("expected") == e) & (F.col("observed") == o), 1))
    out = calls.groupBy(*group).agg(hit(1, 1).alias("tp"), hit(0, 0).alias("tn"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), F.count("*").alias("cells"))
    ratio = lambda a, b: F.try_divide(a.cast("double"), b)
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return out.withColumns({"accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "call_rate": ratio(tp + tn + fp + fn, F.col("cells"))})


def frequency_r2(table: DataFrame, expected: Column, observed: Column) -> DataFrame:
    """Squared correlation over all cells, and over those that were expected."""
    pairs = table.select(expected.cast("double").alias("e"), observed.cast("double").alias("o"))
    return pairs.agg(F.pow(F.corr("e", "o"), 2).alias("r2"), F.pow(F.corr(F.when(F.col("e") > 0, F.col("e")), F.when(F.col("e") > 0, F.col("o"))), 2).alias("r2_expected"))
