"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import WORD, let, ranked, read

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
#: Low-order bits kept of each bin's minimum: one hexadecimal digit.
BITS = 4


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS).cast("int")


def _donor(bin_: Column, bins: Column) -> Column:
    """Where in bins the full bin stands that comes first in an empty bin's order of its own: an affine permutation modulo a power of two."""
    step = (F.pmod(F.xxhash64(F.lit("step"), bin_), F.lit(BINS // 2)) * 2 + 1).cast("int")
    start = F.pmod(F.xxhash64(F.lit("start"), bin_), F.lit(BINS)).cast("int")

    def first(own):
        place = F.transform(bins, lambda b, i: F.pmod((b + own["start"]) * own["step"], F.lit(BINS)) * BINS + i)
        return F.array_min(place) % BINS + 1

    return let(F.struct(step.alias("step"), start.alias("start")), first)


def shingle_hashes(text: Column) -> Column:
    """One hash for each 5-word shingle; the whole sequence is one if it is shorter; none without words."""

    def runs(words):
        n = F.size(words)
        many = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))
        return F.when(n >= SHINGLE, many).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), runs)


def fingerprint(text: Column) -> Column:
    """BINS hexadecimal digits; an empty string for a text without words.

    A shingle's hash is used once: its high bits name a bin, and the bin keeps its least hash. An empty bin borrows
    from the first full bin in an order of its own, which all texts share (a permutation of the bins).
    """

    def minima(ordered):
        return F.filter(ordered, lambda x, i: (i == 0) | (_bin(x) != _bin(F.element_at(ordered, F.greatest(i, F.lit(1))))))

    def dense(found):
        """All bins' values: its own, or for an empty bin the one of its donor."""
        values, bins = found["values"], found["bins"]
        holes = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)), bins)
        donors = F.transform(holes, lambda k: F.element_at(values, _donor(k, bins)))
        pairs = F.concat(F.arrays_zip(bins.alias("bin"), values.alias("value")), F.arrays_zip(holes.alias("bin"), donors.alias("value")))
        digits = F.transform(F.sort_array(pairs), lambda x: F.substring(F.lit("0123456789abcdef"), x["value"].bitwiseAND(F.lit(15)).cast("int") + 1, F.lit(1)))
        return F.when(F.size(bins) > 0, F.array_join(digits, "")).otherwise(F.lit(""))

    least = let(F.sort_array(shingle_hashes(text)), minima)
    return let(let(least, lambda v: F.struct(v.alias("values"), F.transform(v, _bin).alias("bins"))), dense)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for digits that agree by chance.

    Two fingerprints of texts without words are alike (1.0); one such and any other are not (0.0).
    """
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    chance = 1.0 / (1 << BITS)
    share = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_chars and fingerprint for each row of docs; null texts count as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.length(whole).cast("long").alias("n_chars"), fingerprint(whole).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and how alike they are to those and to the next document's.

    The edited text has its last third replaced by the beginning of the next document in descending doc_id. Rows that
    repeat a doc_id with other text are ordered by the text's hash; equal rows count once for the order and give equal
    results. A null doc_id comes last. A single document is its own next one.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("k")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = materialize(fingerprints(rows), "fingerprints").select("doc_id", key, "text_hash", "n_chars", "fingerprint").dropDuplicates(["k", "text_hash"])
    order = materialize(ranked(own, F.col("k").desc(), F.col("text_hash")), "order")
    total = F.lit(max(1, order.count()))
    prior = order.select(F.col("k").alias("pk"), F.col("text_hash").alias("ph"), (F.col("n_chars") - F.col("n_chars") % 3).alias("pn"), ((F.col("rank") + 1) % total).alias("rank"))
    after = materialize(order.join(prior, "rank").select("k", "text_hash", "pk", "ph", (F.col("pn") / 3).cast("int").alias("need"), F.col("fingerprint").alias("next_fingerprint")), "next")

    texts = rows.select(key, F.xxhash64("text").alias("text_hash"), "text")  # both joins take just these columns, so they share one shuffle
    heads = texts.join(after, ["k", "text_hash"]).select(F.col("pk").alias("k"), F.col("ph").alias("text_hash"), F.substring("text", F.lit(1), F.col("need")).alias("head"), "next_fingerprint", "need")
    heads = heads.groupBy("k", "text_hash").agg(F.first("head").alias("head"), F.first("next_fingerprint").alias("next_fingerprint"), F.first("need").alias("need"))
    joined = texts.join(heads, ["k", "text_hash"]).join(own.select("k", "text_hash", "n_chars", "fingerprint"), ["k", "text_hash"])
    edited = joined.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("need")).cast("int")), F.col("head"))).drop("text", "head")
    doc_id = F.nullif(F.col("k"), F.lit(-(1 << 63)).cast("long")).alias("doc_id")
    printed = edited.select(doc_id, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    return printed.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
