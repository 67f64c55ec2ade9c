"""Expressions over sequence columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements. S and W are exchanged, as in the tables this suite reads.
COMPLEMENT_FROM = "ACGTNRYSWKMBVDH-acgtnryswkmbvdh"
COMPLEMENT_TO = "TGCANYRWSMKVBHD-tgcanyrwsmkvbhd"

# Codes of base sets.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}

# The standard genetic code in the order of bases TCAG, and amino acids' three-letter names.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
AMINO_ACIDS = {
    "A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile", "L": "Leu",
    "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val", "*": "Ter", "X": "Xaa",
}

# Nearest-neighbour enthalpy (cal/mol) and entropy (cal/mol K); each pair stands for its reverse complement too.
STACKS = {"AA": (-7900, -22.2), "AT": (-7200, -20.4), "TA": (-7200, -21.3), "CA": (-8500, -22.7), "GT": (-8400, -22.4), "CT": (-7800, -21.0), "GA": (-8200, -22.2), "CG": (-10600, -27.2), "GC": (-9800, -24.4), "GG": (-8000, -19.9)}
ENDS = {"G": (100, -2.8), "C": (100, -2.8), "A": (2300, 4.1), "T": (2300, 4.1)}
GAS = 1.987


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def reverse_complement(seq: Column) -> Column:
    """IUPAC codes keep their case; other characters become X."""
    return F.reverse(F.translate(F.regexp_replace(seq, f"[^{COMPLEMENT_FROM.replace('-', '')}-]", "X"), COMPLEMENT_FROM, COMPLEMENT_TO))


def gc_percent(seq: Column) -> Column:
    """Whole per cent of G and C among A, C, G and T; null without any."""
    count = lambda bases: F.length(seq) - F.length(F.translate(seq, bases, ""))
    gc, at = count("GCgc"), count("ATat")
    return F.when(gc + at > 0, F.floor(gc * 100 / (gc + at))).cast("int")


def codons() -> dict[str, str]:
    return {a + b + c: GENETIC_CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}


def codon_map() -> Column:
    return literal_map(codons())


def translate_codons(seq: Column, three_letter: bool = False) -> Column:
    """Amino acids of the whole codons of a sequence; unknown ones are X (Xaa)."""
    table = {k: AMINO_ACIDS[v] for k, v in codons().items()} if three_letter else codons()
    n = F.floor(F.length(seq) / 3).cast("int")
    letters = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.coalesce(literal_map(table)[F.upper(F.substring(seq, (i - 1) * 3 + 1, F.lit(3)))], F.lit("Xaa" if three_letter else "X")))
    return F.when(n > 0, F.array_join(letters, "")).otherwise(F.lit(""))


def aa_code(name: Column) -> Column:
    """Three letters from one, or one from three; null if unknown."""
    return literal_map(AMINO_ACIDS | {v: k for k, v in AMINO_ACIDS.items()})[name]


def iupac_expand(seq: Column, max_ns: int = 10) -> Column:
    """All sequences that the codes stand for, as an array; the sequence itself from max_ns N on."""
    up = F.upper(seq)
    sets = literal_map({k: ",".join(v) for k, v in IUPAC.items()})
    grow = F.aggregate(F.split(up, ""), F.array(F.lit("")), lambda acc, c: F.flatten(F.transform(acc, lambda p: F.transform(F.split(F.coalesce(sets[c], c), ","), lambda b: F.concat(p, b)))))
    return F.when(F.length(up) - F.length(F.translate(up, "N", "")) >= max_ns, F.array(seq)).otherwise(grow)


def degenerate_code(bases: Column) -> Column:
    """The code of an array of bases; null if there is none."""
    table = {"".join(sorted(v)): k for k, v in IUPAC.items()}
    return literal_map(table)[F.array_join(F.array_sort(F.array_distinct(F.transform(bases, F.upper))), "")]


def cigar_lengths(cigar: Column) -> Column:
    """Map from each operation to its number of bases."""
    parts = F.arrays_zip(F.regexp_extract_all(cigar, F.lit("(\\d+)([A-Z=])"), F.lit(1)).alias("n"), F.regexp_extract_all(cigar, F.lit("(\\d+)([A-Z=])"), F.lit(2)).alias("op"))
    ops = F.array_distinct(F.transform(parts, lambda x: x["op"]))
    total = lambda op: F.aggregate(F.filter(parts, lambda x: x["op"] == op), F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"].cast("bigint"))
    return F.map_from_arrays(ops, F.transform(ops, total))


def reference_length(cigar: Column) -> Column:
    """All operations' bases less insertions; clipped bases count."""
    ns = F.regexp_extract_all(cigar, F.lit("(\\d+)[A-HJ-Z=]"), F.lit(1))
    return F.aggregate(ns, F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))


def nearest_neighbor_tm(seq: Column, oligo_nm: float, na_mm: float, mg_mm: float, dntp: float = 0.0) -> Column:
    """Melting temperature in degrees Celsius by nearest neighbours with a salt correction; null for other characters."""
    comp = str.maketrans("ACGT", "TGCA")
    stacks = STACKS | {k.translate(comp)[::-1]: v for k, v in STACKS.items()}
    up = F.upper(seq)
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.length(up) - 1, F.lit(1))), lambda i: F.substring(up, i, F.lit(2)))
    add = lambda table, zero: F.aggregate(steps, F.lit(zero), lambda acc, d: acc + literal_map(table)[d])
    first, last = F.substring(up, 1, 1), F.substring(up, -1, 1)
    ends = [literal_map({k: float(v[i]) for k, v in ENDS.items()}) for i in (0, 1)]
    h = add({k: float(v[0]) for k, v in stacks.items()}, 0.0) + ends[0][first] + ends[0][last]
    s = add({k: float(v[1]) for k, v in stacks.items()}, 0.0) + ends[1][first] + ends[1][last]
    dry = h / (s + GAS * math.log(oligo_nm * 1e-9))
    mono, free, k_a = na_mm / 1000, mg_mm / 1000, 30000
    b = k_a * dntp - k_a * free + 1
    free = (-b + math.sqrt(b * b + 4 * k_a * free)) / (2 * k_a)
    gc = gc_percent(up) / 100.0
    ratio, ln_na = math.sqrt(free) / mono, math.log(mono)
    if ratio < 0.22:
        change = (gc * 4.29 - 3.95) * ln_na + 0.94 * ln_na**2
    else:
        a, d, g = 3.92, 1.42, 8.31
        if ratio <= 6:
            a *= 0.843 - 0.352 * math.sqrt(mono) * ln_na
            d *= 1.279 - 4.03e-3 * ln_na - 8.03e-3 * ln_na**2
            g *= 0.486 - 0.258 * ln_na + 5.25e-3 * ln_na**3
        ln_mg = math.log(free)
        change = a - 0.911 * ln_mg + gc * (6.26 + d * ln_mg) + (-48.2 + 52.5 * ln_mg + g * ln_mg**2) / (2 * (F.length(up) - 1))
    return dry / (dry * 1e-5 * change + 1) - 273.15


def chromosome_alias(name: Column, to_standard: bool = True) -> Column:
    """Between standard names (chr1..chr14, chrM, chrP) and assembly names; null if unknown."""
    # Names of the two organelles; the others follow one rule.
    pairs = {f"Pf3D7_{i:02d}_v3": f"chr{i}" for i in range(1, 15)} | {"Pf_M76611": "chrM", "Pf3D7_API_v3": "chrP"}
    return literal_map(pairs if to_standard else {v: k for k, v in pairs.items()})[name]


def unmask(seq: Column) -> Column:
    """Soft-masked bases in upper case."""
    return F.upper(seq)


def alphanumerize(text: Column, allowed: str = "-", replacement: str = "-") -> Column:
    """Characters that are neither letters or digits nor allowed are replaced."""
    keep = "".join("\\" + c for c in allowed)
    return F.regexp_replace(text, f"[^\\p{{L}}\\p{{N}}{keep}]", replacement)


def fasta_to_fastq(name: Column, seq: Column) -> Column:
    """A FASTQ record with quality H throughout."""
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), F.repeat(F.lit("H"), F.length(seq)))
