"""Secret scans: fixed patterns, and entropy of sliding windows over candidate strings. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, read

#: The base patterns. The keywords are spelled per letter, as engines differ in what ignoring case covers.
_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the runs [0-9a-f]+ of 16 characters or more
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Strings worth a look: long runs of key characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Bits per character from which a window of WINDOW characters is suspicious, by the first class that the candidate is
#: of. Random windows of 36, 32, 62 and 52 characters have 3.85, 3.79, 4.03 and 3.98 bits on average, and 98 of 100 reach
#: the classes' 3.44, 3.40, 3.68 and 3.62. Long words reach 3.58, so letters of one case need 3.65 (random ones have
#: 3.69); slugs and paths reach nearly as much as keys, so what mixes signs with one case needs 3.9 and a digit.
_PART = rf"(?:^|[+/_=-])(?=[A-Za-z]*[0-9])[{{}}0-9]{{{{{WINDOW},}}}}(?:$|[+/_=-])"
_NEVER = 99.0
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("lower", r"^[a-z]+$", 3.65),
    ("upper", r"^[A-Z]+$", 3.65),
    ("lower+digit", _PART.format("a-z"), 3.44),
    ("upper+digit", _PART.format("A-Z"), 3.40),
    ("mixed", r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])", 3.68),
    ("letters", r"^(?=.*[A-Z]{2})(?=.*[a-z])[A-Za-z]+$", 3.62),
    ("key", r"[0-9]", 3.9),
    ("other", r"", _NEVER),
)
#: Candidates that are no secrets: numbers, UUIDs, counting sequences, placeholders.
ALLOWED = (
    r"^[0-9+=_/-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"0123456789|abcdefghij|ABCDEFGHIJ|9876543210",
    r"(?i)example|placeholder|changeme|xxxxxx|dummy",
)

_SCALE = 1 << 20
#: k * log2(k) as whole numbers, so that adding and removing characters leaves no rounding behind.
_TERMS = [round(k * math.log2(k) * _SCALE) if k else 0 for k in range(WINDOW + 1)]

#: Counts up to WINDOW fit fields of 5 bits, and 12 of them a bigint.
_FIELD, _FIELDS = 5, 12
_BLOCK = 128

_SPAN = "array<struct<start:bigint,end:bigint,text:string>>"


def _before(sizes: Column) -> Column:
    """For each of an array of numbers the sum of those before it: in blocks, and blocks of blocks, so in time near the length."""

    def scan(xs: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(xs, start, step, lambda acc: acc["out"])

    def blocks(xs: Column, over) -> Column:
        def added(cut: Column) -> Column:
            sums = F.transform(cut, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda acc, x: acc + x))
            return F.flatten(F.zip_with(cut, let(sums, over), lambda b, o: F.transform(scan(b), lambda x: x + o)))

        return let(F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _BLOCK).cast("int")), lambda i: F.slice(xs, i * _BLOCK + 1, _BLOCK)), added)

    return let(sizes, lambda xs: F.when(F.size(xs) <= _BLOCK, scan(xs)).otherwise(blocks(xs, lambda sums: blocks(sums, scan))))


def _located(text: Column, matches: Column, pattern: str) -> Column:
    """Matches with their bounds in code points: the text between matches and the matches, added up."""

    def spans(gaps: Column) -> Column:
        ends = F.zip_with(gaps, matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
        starts = F.zip_with(_before(ends), gaps, lambda at, g: at + F.length(g))
        return F.zip_with(starts, matches, lambda lo, m: F.struct(lo.alias("start"), (lo + F.length(m)).alias("end"), m.alias("text")))

    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    return F.when(F.size(matches) > 0, let(gaps, spans)).otherwise(F.array().cast(_SPAN))


def _hot_bounds(candidate: Column) -> Column:
    """Bounds within the candidate of its suspicious windows taken together; null if there are none.

    The counts of the window's characters are kept as fields of _FIELD bits in a few whole numbers; each step changes two of them.
    """
    codes = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    numbers = range(-(-len(ALPHABET) // _FIELDS))

    def field(x: Column, number: int) -> Column:
        """One in the field of character x, if that lies in this number."""
        own = (x >= number * _FIELDS) & (x < (number + 1) * _FIELDS)
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (x - number * _FIELDS) * _FIELD)
        return F.when(own, one).otherwise(F.lit(0).cast("bigint"))

    def count(acc: Column, x: Column) -> Column:
        held = F.element_at(F.array(*[acc[f"c{k}"] for k in numbers]), F.floor(x / _FIELDS).cast("int") + 1)
        return F.call_function("shiftright", held, (x % _FIELDS * _FIELD).cast("int")).bitwiseAND(F.lit((1 << _FIELD) - 1)).cast("int")

    def scan(codes):
        leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
        moves = F.filter(F.arrays_zip(codes.alias("c"), leaving.alias("o")), lambda x: x["c"].isNotNull())
        moves = F.transform(moves, lambda x, i: F.struct(x["c"].alias("into"), x["o"].alias("out"), i.alias("i")))
        terms = F.array(*[F.lit(x) for x in _TERMS])
        zero = F.struct(*[F.lit(0).cast("bigint").alias(f"c{k}") for k in numbers], F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
        least = F.coalesce(*[F.when(candidate.rlike(p), F.lit(t)) for _, p, t in CLASSES])
        most_sum = (F.lit(math.log2(WINDOW)) - least) * (WINDOW * _SCALE)

        def step(acc, x):
            goes = x["out"] >= 0
            out_count = F.when(goes, count(acc, x["out"])).otherwise(F.lit(0))
            in_count = count(acc, x["into"]) - F.when(x["into"] == x["out"], 1).otherwise(0)
            term = lambda k: F.element_at(terms, k + 1)
            total = acc["sum"] + F.when(goes, term(out_count - 1) - term(out_count)).otherwise(F.lit(0)) + term(in_count + 1) - term(in_count)
            hot = (x["i"] >= WINDOW - 1) & (total <= most_sum)
            return F.struct(
                *[(acc[f"c{k}"] + field(x["into"], k) - field(x["out"], k)).alias(f"c{k}") for k in numbers],
                total.cast("bigint").alias("sum"),
                F.when(hot & (acc["first"] < 0), x["i"] - (WINDOW - 1)).otherwise(acc["first"]).alias("first"),
                F.when(hot, x["i"] + 1).otherwise(acc["last"]).alias("last"),
            )

        return F.aggregate(moves, zero, step, lambda acc: F.when(acc["first"] >= 0, F.struct(acc["first"].alias("lo"), acc["last"].alias("hi"))))

    return let(codes, scan)


def secret_spans(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with arrays assign, access, hex and entropy of spans: start, end (code points, end exclusive) and text.

    The first three are the base patterns, matched leftmost and without overlap; matches that are too short are
    dropped. entropy holds, for each candidate string off the allow-list, the stretch from its first to its last
    window whose Shannon entropy is suspicious for the candidate's character class. Null texts count as empty.
    Clashing columns are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    found = docs.withColumns({f"_{k}": F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    rows = found.withColumns({k: _located(whole, F.col(f"_{k}"), p) for k, p in patterns.items()}).drop(*[f"_{k}" for k in patterns])
    open_ = "|".join(f"(?:{p})" for _, p, t in CLASSES if t < _NEVER)
    suspects = F.filter("entropy", lambda s: s["text"].rlike(open_) & ~F.coalesce(*[F.when(s["text"].rlike(p), True) for p in ALLOWED], F.lit(False)))
    bounds = F.transform(suspects, lambda s: F.struct(s.alias("s"), _hot_bounds(s["text"]).alias("b")))
    hot = F.transform(
        F.filter(bounds, lambda x: x["b"].isNotNull()),
        lambda x: F.struct((x["s"]["start"] + x["b"]["lo"]).alias("start"), (x["s"]["start"] + x["b"]["hi"]).alias("end"), F.substring(x["s"]["text"], x["b"]["lo"] + 1, x["b"]["hi"] - x["b"]["lo"]).alias("text")),
    )
    return rows.withColumns(
        {
            "assign": F.filter("assign", lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= LEAST["assign"]),
            "access": F.filter("access", lambda s: F.length(s["text"]) >= LEAST["access"]),
            "entropy": F.when(F.size("entropy") > 0, hot).otherwise(F.array().cast(_SPAN)),
        }
    )


def _digest(kinds: tuple[str, ...]) -> Column:
    def tag(kind: str, order: int) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("name")))

    tagged = [tag(k, i) for i, k in enumerate(kinds)]
    return F.array_join(F.transform(F.sort_array(F.concat(*tagged)), lambda x: x["name"]), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_spans(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = ("assign", "access", "hex")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return rows.select("doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"), _digest((*base, "entropy")).alias("spans"))
