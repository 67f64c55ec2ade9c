"""From called sites to amino-acid and nucleotide tables, in long form: one row per site, allele and sample."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import spread_join

MISSENSE = "missense_variant"


def _common(a: Column, b: Column, most: Column) -> Column:
    """How many first characters two texts share, most at most."""
    return F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), F.lit(0), lambda n, i: F.when((n == i - 1) & (i <= most) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))), i).otherwise(n))


def _trimmed(rows: DataFrame) -> DataFrame:
    """Bases that ref and alt share at their ends go, at the end first; at least one base stays."""
    least = F.least(F.length("ref"), F.length("alt")) - 1
    rows = rows.withColumn("_end", _common(F.reverse("ref"), F.reverse("alt"), least))
    rows = rows.withColumns({c: F.substring(c, F.lit(1), F.length(c) - F.col("_end")) for c in ("ref", "alt")})
    rows = rows.withColumn("_start", _common(F.col("ref"), F.col("alt"), least))
    rows = rows.withColumn("pos", F.col("pos") + F.col("_start"))
    return rows.withColumns({c: F.substring(c, F.col("_start") + 1, F.length(c)) for c in ("ref", "alt")}).drop("_end", "_start")


def split_multiallelic(calls: DataFrame, per_allele: Sequence[str] = ("ao", "qa"), contigs: DataFrame | None = None, chunk_size: int = 1000) -> DataFrame:
    """One row for each alternate allele, with its element of the comma lists; gt counts copies of that allele.

    Bases that ref and alt share at their ends are trimmed, at the end first; at least one base stays. contigs: the
    genome in pieces (chrom, chunk, seq), along which insertions and deletions are moved to the left.
    """
    rows = calls.select("*", F.posexplode(F.split("alt", ",")).alias("allele", "_alt")).drop("alt").withColumnRenamed("_alt", "alt")
    rows = rows.withColumns({c: F.get(F.split(c, ","), F.col("allele")).cast("double") for c in per_allele})
    alleles = F.split("gt", "[/|]")
    count = F.size(F.filter(alleles, lambda a: a == (F.col("allele") + 1).cast("string")))
    rows = rows.withColumn("genotype", F.when(F.array_contains(alleles, "."), F.lit(None)).otherwise(count)).drop("allele")
    if contigs is None:
        return _trimmed(rows)
    place = ["chrom", "pos", "ref", "alt"]
    rows = materialize(rows, "alleles")
    sites = materialize(rows.groupBy(*place).agg(F.count("*").alias("n")), "sites")
    moved = left_align(sites.select(*place), contigs, chunk_size).join(sites, place).select(*place, "n", F.col("new_pos").alias("_pos"), F.col("new_ref").alias("_ref"), F.col("new_alt").alias("_alt"))
    known = spread_join(rows, moved, place)  # a site has a row for each sample
    return known.withColumns({"pos": F.col("_pos"), "ref": F.col("_ref"), "alt": F.col("_alt")}).select(*rows.columns)


def _with_pieces(rows: DataFrame, contigs: DataFrame, chunk_size: int) -> DataFrame:
    """rows with the piece of their contig that holds _at (_chunk, _seq), and the piece before it (_earlier); places outside the contigs go.

    A row asks for both pieces, so the contigs are read once. They are never broadcast, whatever their estimated size: of
    pieces made by explode() Spark only knows how large the rows were before.
    """
    own = F.floor((F.col("_at") - 1) / chunk_size)
    asked = rows.withColumn("_own", own).withColumn("_chunk", F.explode(F.sequence(F.greatest(F.col("_own") - 1, F.lit(0)), F.col("_own"))))
    pieces = contigs.select("chrom", F.col("chunk").cast("long").alias("_chunk"), F.col("seq").alias("_seq"))
    found = asked.join(pieces.hint("merge"), ["chrom", "_chunk"])
    at = lambda back: F.max(F.when(F.col("_chunk") == F.col("_own") - back, F.col("_seq")))
    return found.groupBy(*rows.columns, F.col("_own")).agg(at(0).alias("_seq"), at(1).alias("_earlier")).where("_seq is not null").withColumnRenamed("_own", "_chunk")


def left_align(sites: DataFrame, contigs: DataFrame, chunk_size: int, window: int = 100) -> DataFrame:
    """chrom, pos, ref, alt of each different site, and new_pos, new_ref, new_alt: trimmed, insertions and deletions as far left as they can be.

    contigs: chrom, chunk (from 0) and seq of chunk_size bases, at least window; ref is taken to agree with them. In
    rounds, each insertion or deletion sees the window bases before it and moves by as many as its own text and they
    repeat; only those that reached the window's beginning go on. A base before it stays, so at a contig's start it
    stops at the second. Symbolic alleles, and places outside the contigs, are only trimmed or left as they are.
    """
    place = ["chrom", "pos", "ref", "alt"]
    plain = F.col("ref").rlike("^[ACGTNacgtn]+$") & F.col("alt").rlike("^[ACGTNacgtn]+$")
    rows = sites.select(*place).distinct()
    # shared ends are taken off whole: if nothing of one allele is left, it is an insertion or deletion of what is left of the other
    least = F.least(F.length("ref"), F.length("alt"))
    cut = rows.where(plain & (F.col("ref") != F.col("alt"))).withColumn("_e", _common(F.reverse("ref"), F.reverse("alt"), least))
    cut = cut.withColumns({f"_{c}": F.substring(c, F.lit(1), F.length(c) - F.col("_e")) for c in ("ref", "alt")})
    cut = cut.withColumn("_b", _common(F.col("_ref"), F.col("_alt"), F.least(F.length("_ref"), F.length("_alt"))))
    cut = cut.withColumns({f"_{c}": F.substring(f"_{c}", F.col("_b") + 1, F.length(f"_{c}")) for c in ("ref", "alt")})
    one = (F.length("_ref") == 0) | (F.length("_alt") == 0)
    # _at: the base before; _text: what is inserted or deleted
    moving = materialize(cut.where(one).select(*place, (F.col("pos") + F.col("_b") - 1).cast("long").alias("_at"), F.concat("_ref", "_alt").alias("_text"), (F.length("_ref") > 0).alias("_deleted")), "indels")
    done = None
    while not moving.isEmpty():
        seen = _with_pieces(moving.where("_at >= 1"), contigs, chunk_size)
        upto = F.concat(F.coalesce("_earlier", F.lit("")), F.substring("_seq", F.lit(1), (F.col("_at") - F.col("_chunk") * chunk_size).cast("int")))
        seen = seen.withColumn("_near", F.substring(upto, F.greatest(F.length(upto) - window + 1, F.lit(1)), F.lit(window)))
        both = F.reverse(F.concat("_near", "_text"))
        seen = seen.withColumn("_both", F.upper(both)).withColumn("_by", _common(F.col("_both"), F.expr("substring(_both, length(_text) + 1)"), F.length("_near") - 1))
        on = (F.col("_by") == F.length("_near") - 1) & (F.col("_at") > F.length("_near"))
        text = F.reverse(F.substring("_both", F.col("_by") + 1, F.length("_text")))
        step = seen.select(*place, (F.col("_at") - F.col("_by")).alias("_at"), F.when(F.col("_by") == 0, F.col("_text")).otherwise(text).alias("_text"), "_deleted", F.substring(F.reverse(F.concat("_near", "_text")), F.col("_by") + F.length("_text") + 1, F.lit(1)).alias("_base"), (on & (F.col("_by") > 0)).alias("_on"))
        step = materialize(step, "indels")
        finished = step.where("not _on").drop("_on")
        done = finished if done is None else done.unionByName(finished)
        moving = step.where("_on").drop("_on", "_base")
    trimmed = _trimmed(rows.withColumnsRenamed({"pos": "_pos", "ref": "_ref", "alt": "_alt"}).withColumns({"pos": F.col("_pos"), "ref": F.col("_ref"), "alt": F.col("_alt")}))
    other = trimmed.select("chrom", F.col("_pos").alias("pos"), F.col("_ref").alias("ref"), F.col("_alt").alias("alt"), F.col("pos").alias("_tp"), F.col("ref").alias("_tr"), F.col("alt").alias("_ta"))
    if done is None:
        return other.select(*place, F.col("_tp").alias("new_pos"), F.col("_tr").alias("new_ref"), F.col("_ta").alias("new_alt"))
    longer = F.concat("_base", "_text")
    found = done.select(*place, "_at", F.when(F.col("_deleted"), longer).otherwise(F.col("_base")).alias("_nr"), F.when(F.col("_deleted"), F.col("_base")).otherwise(longer).alias("_na"))
    both = other.join(found, place, "left")
    return both.select(*place, F.coalesce("_at", "_tp").alias("new_pos"), F.coalesce("_nr", "_tr").alias("new_ref"), F.coalesce("_na", "_ta").alias("new_alt"))


def drop_reference_blocks(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("alt") != "<*>")


def variant_positions(sites: DataFrame) -> DataFrame:
    """Rows per base: substitutions, insertions at both flanks with ref '-', deletions for each base with alt '-'.

    Sites of another shape have kind 'malformed' and keep their alleles.
    """
    ref, alt = F.length("ref"), F.length("alt")
    rest = F.expr("substring(alt, 2)")
    anchored = F.substring("ref", 1, 1) == F.substring("alt", 1, 1)
    item = lambda pos, r, a, kind: F.struct(pos.cast("bigint").alias("pos"), r.alias("ref"), a.alias("alt"), F.lit(kind).alias("kind"))
    pos = F.col("pos")
    dash = F.lit("-")
    deleted = F.transform(F.sequence(F.lit(1), F.greatest(ref - 1, F.lit(1))), lambda i: item(pos + i, F.substring("ref", i + 1, F.lit(1)), dash, "deletion"))
    made = (
        F.when((ref == 1) & (alt == 1), F.array(item(pos, F.col("ref"), F.col("alt"), "substitution")))
        .when((ref == 1) & anchored, F.array(item(pos, dash, rest, "insertion"), item(pos + 1, dash, rest, "insertion")))
        .when((alt == 1) & anchored, deleted)
        .otherwise(F.array(item(pos, F.col("ref"), F.col("alt"), "malformed")))
    )
    others = [c for c in sites.columns if c not in ("pos", "ref", "alt")]
    return sites.select(*others, F.explode(made).alias("_v")).select(*others, "_v.*")


def collapse_positions(rows: DataFrame) -> DataFrame:
    """One row per place: AC adds up, AN is the greatest, alleles are the first in order."""
    first = F.min(F.struct("ref", "alt"))
    return rows.groupBy("chrom", "pos").agg(F.sum("ac").alias("ac"), F.max("an").alias("an"), first["ref"].alias("ref"), first["alt"].alias("alt"))


def allele_count_strings(rows: DataFrame) -> DataFrame:
    """Columns start (0-offset), alleles 'REF,ALT,' and counts '(AN-AC),AC,'."""
    return rows.withColumns({"start": F.col("pos") - 1, "alleles": F.concat("ref", F.lit(","), "alt", F.lit(",")), "counts": F.concat((F.col("an") - F.col("ac")).cast("string"), F.lit(","), F.col("ac").cast("string"), F.lit(","))})


def ucsc_table(rows: DataFrame) -> DataFrame:
    """The 24 columns of a browser's SNP table."""
    s = allele_count_strings(rows)
    const = lambda v: F.lit(v)
    return s.select(
        const(585).alias("bin"), "chrom", F.col("start").alias("chromStart"), F.col("pos").alias("chromEnd"), F.concat_ws(":", "chrom", F.col("pos")).alias("name"), const(0).alias("score"), const("+").alias("strand"),
        F.col("ref").alias("refNCBI"), F.col("ref").alias("refUCSC"), F.concat_ws("/", "ref", "alt").alias("observed"), const("genomic").alias("molType"), const("single").alias("class"), const("unknown").alias("valid"),
        const(0).alias("avHet"), const(0).alias("avHetSE"), const("unknown").alias("func"), const("exact").alias("locType"), const(1).alias("weight"), const("").alias("exceptions"), const(1).alias("submitterCount"),
        const("").alias("submitters"), const(2).alias("alleleFreqCount"), F.col("alleles"), F.col("counts").alias("alleleNs"),
    )


def filter_vcf(sites: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Sites whose FILTER names none of the tags."""
    return sites.where(~F.coalesce(F.arrays_overlap(F.split("filter", ";"), F.array(*map(F.lit, tags))), F.lit(False)))


def info_site_filter(sites: DataFrame, minima: dict[str, float], targeted: str = "ot") -> DataFrame:
    """Sites that reach every minimum, or are targeted (not '.')."""
    ok = F.lit(True)
    for name, least in minima.items():
        ok = ok & (F.col(name) >= least)
    return sites.where(F.coalesce(ok, F.lit(False)) | (F.col(targeted) != "."))


def parse_annotation(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """effect, gene_id, gene and aa_change of the first entry of ann; a gene without a name keeps its id."""
    parts = F.split(F.element_at(F.split("ann", ","), 1), "\\|")
    out = rows.withColumns({"effect": F.get(parts, F.lit(1)), "gene_id": F.get(parts, F.lit(4)), "aa_change": F.regexp_replace(F.get(parts, F.lit(10)), "^p\\.", "")})
    return out.join(genes.select("gene_id", "gene_name"), "gene_id", "left").withColumn("gene", F.coalesce("gene_name", "gene_id")).drop("gene_name")


def allele_depths(rows: DataFrame) -> DataFrame:
    """ao and ro, taken from the list ad where they are missing."""
    ad = F.split("ad", ",")
    return rows.withColumns({"ro": F.coalesce("ro", F.get(ad, F.lit(0)).cast("double")), "ao": F.coalesce("ao", F.get(ad, F.lit(1)).cast("double"))})


def split_aa_changes(rows: DataFrame) -> DataFrame:
    """One row per residue of a missense change: three-letter residues before and after, counted from the position.

    Other effects, and changes of another shape, stay as they are. same tells residues that don't change.
    """
    pattern = "^(\\D+)(\\d+)(\\D+)$"
    before, at, after = (F.regexp_extract("aa_change", pattern, i) for i in (1, 2, 3))
    splits = (F.col("effect") == MISSENSE) & F.col("aa_change").rlike(pattern)
    part = lambda j: F.struct(F.concat(F.substring(before, j * 3 + 1, F.lit(3)), (at.cast("int") + j).cast("string"), F.substring(after, j * 3 + 1, F.lit(3))).alias("change"), (F.substring(before, j * 3 + 1, F.lit(3)) == F.substring(after, j * 3 + 1, F.lit(3))).alias("same"))
    many = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.length(before) - 1) / 3).cast("int"), F.lit(0))), part)
    one = F.array(F.struct(F.col("aa_change").alias("change"), (F.col("effect") == "synonymous_variant").alias("same")))
    out = rows.withColumn("_p", F.explode(F.when(splits, many).otherwise(one)))
    return out.withColumns({"change": F.col("_p.change"), "same": F.col("_p.same")}).drop("_p")


def _label(rows: DataFrame, targets: DataFrame, keys: Sequence[str], fallback: Column, min_qual: float, min_target_qual: float) -> DataFrame:
    named = targets.select(*keys, F.col("mutation_name").alias("_name"))
    out = rows.join(named, list(keys), "left").withColumn("targeted", F.when(F.col("_name").isNotNull(), "Yes").otherwise("No"))
    out = out.where((F.col("targeted") == "Yes") | ((F.col("qual") >= min_qual) & ~F.col("same")))
    alt = F.when((F.col("targeted") == "Yes") & (F.col("qual") < min_target_qual), F.lit(0.0)).otherwise(F.col("ao"))
    return out.withColumns({"mutation_name": F.coalesce("_name", fallback), "ao": alt}).drop("_name")


def label_targets_aa(rows: DataFrame, targets: DataFrame, min_qual: float = 1, min_target_qual: float = 0) -> DataFrame:
    """Name changes by (gene, change); untargeted ones of low quality, without a change or of unknown effect go; poor targets get alt 0."""
    return _label(rows, targets, ("gene", "change"), F.concat_ws("-", "gene", "change"), min_qual, min_target_qual)


def label_targets_nt(rows: DataFrame, targets: DataFrame, min_qual: float = 1, min_target_qual: float = 0) -> DataFrame:
    """The same by (chrom, pos, ref, alt)."""
    rows = rows.withColumn("same", F.col("ref") == F.col("alt"))
    return _label(rows, targets, ("chrom", "pos", "ref", "alt"), F.concat_ws(":", "chrom", "pos", "ref", "alt"), min_qual, min_target_qual)


def mask_low_quality_calls(rows: DataFrame, min_gq: float, min_alt: float, min_ref: float, min_mean_alt: float, min_mean_ref: float) -> DataFrame:
    """Poor genotype: no depth and no genotype. Poor alleles, in sum or on average: no count. Runs before any split."""
    bad = lambda c: F.coalesce(c, F.lit(False))
    gq = bad(F.col("gq") < min_gq)
    alt = bad(F.col("qa") < min_alt) | bad(F.try_divide("qa", "ao") < min_mean_alt)
    ref = bad(F.col("qr") < min_ref) | bad(F.try_divide("qr", "ro") < min_mean_ref)
    return rows.withColumns({"dp": F.when(gq, 0).otherwise(F.col("dp")), "genotype": F.when(gq, F.lit(None)).otherwise(F.col("genotype")), "ao": F.when(alt, 0).otherwise(F.col("ao")), "ro": F.when(ref, 0).otherwise(F.col("ro"))})


def min_gq_genotypes(rows: DataFrame, least: float) -> DataFrame:
    return rows.withColumn("genotype", F.when(F.col("gq") >= least, F.col("genotype")))


def combined_genotype(gt: str = "genotype") -> Column:
    """Of several genotypes: 1 if any is 1 or both 0 and 2 occur, else 0 or 2, else -1."""
    has = lambda v: F.coalesce(F.bool_or(F.col(gt) == v), F.lit(False))
    return F.when(has(1) | (has(0) & has(2)), 1).when(has(0), 0).when(has(2), 2).otherwise(-1)


def combine_genotypes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(combined_genotype().alias("genotype"))


def aggregate_changes(rows: DataFrame, keys: Sequence[str], cap: str = "cell") -> DataFrame:
    """Per change and sample: alt adds up, ref is the least, coverage the greatest, genotypes combine.

    ref can't exceed coverage - alt. cap: 'cell' limits each value, 'sample' resets all of a sample once one exceeds.
    """
    out = rows.groupBy(*keys, "sample_id").agg(F.sum(F.coalesce("ao", F.lit(0))).alias("alt"), F.min(F.coalesce("ro", F.lit(0))).alias("ref"), F.max(F.coalesce("dp", F.lit(0))).alias("coverage"), combined_genotype().alias("genotype"))
    most = F.col("coverage") - F.col("alt")
    if cap == "cell":
        return out.withColumn("ref", F.least("ref", most))
    over = out.groupBy("sample_id").agg(F.max(F.col("ref") > most).alias("_over"))
    return out.join(over, "sample_id").withColumn("ref", F.when(F.col("_over"), most).otherwise(F.col("ref"))).drop("_over")


def aggregate_aa(rows: DataFrame, cap: str = "cell") -> DataFrame:
    return aggregate_changes(rows, ("gene_id", "gene", "mutation_name", "effect", "change", "targeted"), cap)


def aggregate_nt(rows: DataFrame) -> DataFrame:
    return aggregate_changes(rows, ("chrom", "pos", "ref_base", "alt_base", "mutation_name", "targeted"))


def swap_reference_resistant(table: DataFrame, rules: DataFrame) -> DataFrame:
    """For changes whose reference allele is the resistant one: swap alt and ref, turn 0 and 2, rename.

    rules: mutation_name, change, new_name, new_change. Targeted changes only.
    """
    out = table.join(rules, ["mutation_name", "change"], "left").withColumn("_swap", F.col("new_name").isNotNull() & (F.col("targeted") == "Yes"))
    swap = F.col("_swap")
    pick = lambda a, b: F.when(swap, b).otherwise(a)
    turned = F.when(F.col("genotype") == 0, 2).when(F.col("genotype") == 2, 0).otherwise(F.col("genotype"))
    out = out.withColumns({"alt": pick(F.col("alt"), F.col("ref")), "ref": pick(F.col("ref"), F.col("alt")), "genotype": pick(F.col("genotype"), turned), "mutation_name": pick(F.col("mutation_name"), F.col("new_name")), "change": pick(F.col("change"), F.col("new_change"))})
    return out.drop("new_name", "new_change", "_swap")


def aligned_changes(ref: str, alt: str) -> list[tuple[int, str, str]]:
    """Changes that make alt of ref by the cheapest global alignment: (offset, ref, alt), left to right.

    A differing pair of bases costs 1, a gap 2 and 1 for each base (so that gaps stay together). Of equal costs a pair goes before a
    base of ref alone, and that before one of alt alone, from the end on. Single bases differ; insertions and deletions
    have the base before them, or after them at the beginning.
    """
    n, m, far = len(ref), len(alt), 1 << 30
    # by what the last column holds: a pair, a base of ref alone, one of alt alone
    cost = [[[far] * 3 for _ in range(m + 1)] for _ in range(n + 1)]
    cost[0][0][0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                cost[i][j][0] = min(cost[i - 1][j - 1]) + (ref[i - 1] != alt[j - 1])
            if i:
                cost[i][j][1] = min(cost[i - 1][j][k] + (1 if k == 1 else 3) for k in range(3))
            if j:
                cost[i][j][2] = min(cost[i][j - 1][k] + (1 if k == 2 else 3) for k in range(3))
    i, j, columns = n, m, []
    kind = min(range(3), key=lambda k: (cost[n][m][k], k))
    while i or j:
        columns.append(kind)
        here = cost[i][j][kind]
        step = (ref[i - 1] != alt[j - 1]) if kind == 0 else None
        i, j = i - (kind != 2), j - (kind != 1)
        kind = min((k for k in range(3) if cost[i][j][k] + (step if step is not None else 1 if k == columns[-1] else 3) == here), default=0)
    changes, i, j = [], 0, 0
    columns.reverse()
    at = 0
    while at < len(columns):
        kind, run = columns[at], 1
        if kind:
            while at + run < len(columns) and columns[at + run] == kind:
                run += 1
            gone, new = (ref[i : i + run], "") if kind == 1 else ("", alt[j : j + run])
            if i:
                changes.append((i - 1, ref[i - 1] + gone, ref[i - 1] + new))
            else:
                after = ref[len(gone) : len(gone) + 1]
                changes.append((0, gone + after, new + after))
        elif ref[i] != alt[j]:
            changes.append((i, ref[i], alt[j]))
        i, j, at = i + run * (kind != 2), j + run * (kind != 1), at + run
    return changes


def _aligned(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for refs, alts in pairs:
        yield pd.Series([[{"off": o, "ref": r, "alt": a} for o, r, a in aligned_changes(ref, alt)] for ref, alt in zip(refs, alts, strict=True)])


def decompose_blocks(rows: DataFrame, align: bool = False) -> DataFrame:
    """Substitutions of several bases of one length become single ones where bases differ.

    align: alleles of different lengths, both of more than one base, become the changes of their global alignment, one
    row each; every different pair of alleles is aligned once. Symbolic alleles stay.
    """
    block = (F.length("ref") == F.length("alt")) & (F.length("ref") > 1)
    places = F.filter(F.sequence(F.lit(1), F.length("ref")), lambda i: F.substring("ref", i, F.lit(1)) != F.substring("alt", i, F.lit(1)))
    items = F.transform(places, lambda i: F.struct((F.col("pos") + i - 1).cast("bigint").alias("pos"), F.substring("ref", i, F.lit(1)).alias("ref"), F.substring("alt", i, F.lit(1)).alias("alt")))
    own = F.array(F.struct(F.col("pos").cast("bigint").alias("pos"), "ref", "alt"))
    others = [c for c in rows.columns if c not in ("pos", "ref", "alt")]
    if not align:
        return rows.select(*others, F.explode(F.when(block, items).otherwise(own)).alias("_b")).select(*others, "_b.*")
    uneven = (F.length("ref") != F.length("alt")) & (F.least(F.length("ref"), F.length("alt")) > 1) & F.col("ref").rlike("^[A-Za-z]+$") & F.col("alt").rlike("^[A-Za-z]+$")
    found = F.pandas_udf(_aligned, "array<struct<off: int, ref: string, alt: string>>")
    pairs = rows.where(uneven).groupBy("ref", "alt").agg(F.count("*").alias("_n")).withColumn("_changes", found("ref", "alt"))
    known = spread_join(rows, pairs, ["ref", "alt"], "_n", "left")
    shifted = F.transform("_changes", lambda c: F.struct((F.col("pos") + c["off"]).cast("bigint").alias("pos"), c["ref"].alias("ref"), c["alt"].alias("alt")))
    return known.select(*others, F.explode(F.when(block, items).otherwise(F.coalesce(shifted, own))).alias("_b")).select(*others, "_b.*")


def unaggregated_tables(rows: DataFrame, min_qual: float) -> DataFrame:
    """Sites as they were called: quality filter, '.' for what isn't annotated, -1 for missing genotypes."""
    return rows.where(F.col("qual") >= min_qual).withColumns({"gene": F.coalesce(F.nullif(F.col("gene"), F.lit("")), F.lit(".")), "aa_change": F.coalesce(F.nullif(F.col("aa_change"), F.lit("")), F.lit(".")), "genotype": F.coalesce("genotype", F.lit(-1))})


def force_targets(table: DataFrame, targets: DataFrame, samples: DataFrame, keys: Sequence[str] = ("gene", "change")) -> DataFrame:
    """Every target with every sample, zeros where it wasn't seen; targets and samples are dimension tables."""
    grid = targets.select(*keys, "mutation_name").distinct().crossJoin(samples.select("sample_id").distinct())
    seen = table.groupBy(*keys, "sample_id").agg(F.sum("alt").alias("alt"), F.max("coverage").alias("coverage"))
    return grid.join(seen, [*keys, "sample_id"], "left").na.fill(0, ["alt", "coverage"])


def merge_codon_snps(rows: DataFrame, codes: Column) -> DataFrame:
    """Substitutions of one haplotype that hit one codon become one change of the amino acid.

    rows: haplotype_id, copy, aa_pos, codon_pos (0-2), ref_base, alt_base, ref_codon. Codons with insertions or
    deletions, and codons hit once, are left out. codes maps codons to amino acids.
    """
    group = rows.groupBy("haplotype_id", "copy", "aa_pos", "ref_codon").agg(
        F.count("*").alias("changes"), F.max((F.length("ref_base") != 1) | (F.length("alt_base") != 1) | F.col("ref_base").isin("-") | F.col("alt_base").isin("-")).alias("_indel"),
        *[F.max(F.when(F.col("codon_pos") == i, F.col("alt_base"))).alias(f"_b{i}") for i in range(3)],
    )
    base = lambda i: F.coalesce(f"_b{i}", F.substring("ref_codon", i + 1, 1))
    out = group.where(~F.col("_indel") & (F.col("changes") > 1)).withColumn("alt_codon", F.concat(base(0), base(1), base(2)))
    out = out.withColumns({"ref_aa": F.coalesce(codes[F.col("ref_codon")], F.lit("X")), "alt_aa": F.coalesce(codes[F.col("alt_codon")], F.lit("X"))})
    return out.withColumns({"aa_change": F.concat("ref_aa", F.col("aa_pos").cast("string"), "alt_aa"), "synonymous": F.col("ref_aa") == F.col("alt_aa")}).drop("_indel", "_b0", "_b1", "_b2")
