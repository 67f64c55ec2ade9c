"""Language identification: a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tokens, read, slices

#: The training sample: so many documents of each language at most, of each a stretch of so many characters.
DOCS_PER_LANGUAGE = 600
CHARS_PER_DOC = 1500
#: Hashed feature space.
BUCKETS = 1 << 18
UNKNOWN = "und"
#: Documents whose language has a smaller share of the words are rejected by the filter.
LEAST_SCORE = 0.5
#: Texts are labelled in pieces of about so many bytes; the features of a piece take some hundred bytes for each.
PREDICT_BYTES = 1 << 19
#: A text's words are chained in blocks of so many.
BLOCK = 64

#: Bytes that aren't part of a word: all but lower-case ASCII letters and bytes of other scripts' characters.
_GAPS = np.ones(256, bool)
_GAPS[ord("a") : ord("z") + 1] = False
_GAPS[128:] = False
#: A text may be cut after these bytes: no word goes on there, in either case.
_CUTS = _GAPS.copy()
_CUTS[ord("A") : ord("Z") + 1] = False
_ORDERS = (2, 3, 4)
_AFFIXES = (1, 2, 3)


class Features:
    """Hashed features of the words of a text column: lexicon (the word), prefixes and suffixes, and n-grams of bytes."""

    def __init__(self, texts: pa.Array):
        self.tokens = tokens = Tokens(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), _GAPS)
        self.starts, self.ends, self.first = tokens.starts, tokens.ends, tokens.first
        data = np.concatenate([tokens.data, np.zeros(4, np.uint8)]).astype(np.uint32)
        self.end_of = np.zeros(len(tokens.data), np.int32)  # of the word around a byte; 0 between words
        lengths = self.ends - self.starts
        at = np.repeat(self.starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        self.end_of[at] = np.repeat(self.ends, lengths)
        grams = {1: data[: len(tokens.data)]}
        for n in (2, 3, 4):
            grams[n] = grams[n - 1] * np.uint32(257) + data[n - 1 : n - 1 + len(tokens.data)]
        self.grams = {n: self._bucket(g, n) for n, g in grams.items()}

    @staticmethod
    def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
        x = (values ^ np.uint32(kind * 0x1000193)) * np.uint32(0x9E3779B1)
        return ((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(14)).astype(np.int32)

    def word_features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Feature buckets of one kind each and, where they count, of words long enough."""
        yield (self.tokens.hashes(31) >> np.uint64(46)).astype(np.int32), np.ones(len(self.starts), bool)
        for n in _AFFIXES:
            fits = self.ends - self.starts >= n
            yield self.grams[n][self.starts] ^ (0x15A5 * n), fits
            yield self.grams[n][np.maximum(self.ends - n, 0)] ^ (0x2B4B * n), fits

    def gram_features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets at each byte, and whether an n-gram that stays in its word begins there."""
        at = np.arange(len(self.end_of))
        for n in _ORDERS:
            yield self.grams[n], at + n <= self.end_of

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each word's features, one row per word."""
        out = np.zeros((len(self.starts), weights.shape[1]), np.float32)
        if not len(out):
            return out
        for bucket, fits in self.word_features():
            out += weights[bucket] * fits[:, None]
        for bucket, fits in self.gram_features():
            out += np.add.reduceat(weights[np.where(fits, bucket, len(weights) - 1)], self.starts, axis=0)
        return out

    def of_words(self) -> tuple[np.ndarray, np.ndarray]:
        """All features as (word, bucket) pairs, sorted by word."""
        words, buckets = [], []
        for bucket, fits in self.word_features():
            words.append(np.flatnonzero(fits))
            buckets.append(bucket[fits])
        for bucket, fits in self.gram_features():
            at = np.flatnonzero(fits)
            words.append(np.searchsorted(self.starts, at, "right") - 1)
            buckets.append(bucket[at])
        word, bucket = np.concatenate(words), np.concatenate(buckets)
        order = np.argsort(word, kind="stable")
        return word[order], bucket[order]


@dataclass
class Model:
    """Languages, feature weights (the last row is all zero and stands for no feature), transitions and start scores."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, enter: np.ndarray, leave: np.ndarray | None = None, count_moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word's label, for sequences laid one after another; and expected transitions, summed, if asked.

    enter: scores of the labels of first words (one row for all sequences, or one each); leave: by sequence, the backward
    message into its last word, if something follows. Sequences advance together, longest first, so that a step covers
    all that are still going.
    """
    n, labels = scores.shape
    posterior, moves = np.zeros((n, labels)), np.zeros((labels, labels))
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    if not n:
        return posterior, moves
    local = np.exp(scores - scores.max(1, keepdims=True))
    step, first = np.exp(transitions), np.broadcast_to(np.exp(enter), (len(order), labels))[order]
    last = np.ones((len(order), labels)) if leave is None else leave[order]
    going = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # sequences longer than t
    ahead = np.empty((n, labels))
    state = None
    for t in range(lengths[0]):
        at = begins[: going[t]] + t
        state = (first[: going[t]] if t == 0 else state[: going[t]] @ step) * local[at]
        state /= state.sum(1, keepdims=True)
        ahead[at] = state
    back = np.zeros((0, labels))
    for t in range(lengths[0] - 1, -1, -1):
        at = begins[: going[t]] + t
        if len(back):
            onward = back * local[at[: len(back)] + 1]
            if count_moves:
                moved = ahead[at[: len(back)]][:, :, None] * step[None] * onward[:, None, :]
                moves += (moved / moved.sum((1, 2), keepdims=True)).sum(0)
            back = onward @ step.T
            back /= back.sum(1, keepdims=True)
        back = np.concatenate([back, last[len(back) : len(at)]])
        both = ahead[at] * back
        posterior[at] = both / both.sum(1, keepdims=True)
    return posterior, moves


class Chain:
    """Words of texts in blocks of BLOCK, so that a batch takes as many steps as a block has words, not as its longest text.

    A block's transfer matrix leads from the forward message before it to the one at its end, and backwards; chained,
    the matrices give each block the messages from both sides, and then all blocks advance together. piece: the only
    text is a piece of a longer one; opens: it is the first.
    """

    def __init__(self, scores: np.ndarray, lengths: np.ndarray, model: Model, piece: bool = False, opens: bool = True):
        self.scores, self.model, self.opens = scores, model, opens
        self.step = np.exp(model.transitions)
        self.counts = -(-lengths // BLOCK)
        self.base = np.cumsum(self.counts) - self.counts
        owner = np.repeat(np.arange(len(lengths)), self.counts)
        place = np.arange(len(owner)) - self.base[owner]
        self.lengths = np.minimum(BLOCK, lengths[owner] - place * BLOCK)
        self.first = (place == 0) & opens
        self.matrices = np.repeat(np.eye(scores.shape[1])[None], len(owner), axis=0)
        chained = np.flatnonzero((self.counts[owner] > 1) | piece)
        order = chained[np.argsort(-self.lengths[chained], kind="stable")]
        begins = (np.cumsum(self.lengths) - self.lengths)[order]
        local = np.exp(scores - scores.max(1, keepdims=True)) if len(order) else scores
        going = np.searchsorted(-self.lengths[order], -np.arange(BLOCK), "left")
        m = self.matrices[order]
        for t in range(int(self.lengths[order].max(initial=0))):
            n = going[t]
            into = m[:n] @ self.step
            if t == 0:  # a text's first word has no word before it
                into[self.first[order]] = np.exp(model.start)
            m[:n] = into * local[begins[:n] + t][:, None, :]
            m[:n] /= m[:n].sum((1, 2), keepdims=True)
        self.matrices[order] = m

    def along(self, message: np.ndarray, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The message into each block from one side, given that into each text; and by text the one that leaves it."""
        into, at = np.empty((len(self.lengths), len(self.step))), np.repeat(message[None], len(self.counts), axis=0)
        for j in range(int(self.counts.max(initial=0))):
            going = np.flatnonzero(self.counts > j)
            block = self.base[going] + (self.counts[going] - 1 - j if backwards else j)
            into[block] = at[going]
            out = np.einsum("tlm,tm->tl" if backwards else "tlm,tl->tm", self.matrices[block], at[going])
            at[going] = out / out.sum(1, keepdims=True)
        return into, at

    def posterior(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of each word's label, given the messages before the first and into the last word of texts."""
        enter = self.along(before)[0] @ self.step
        enter[self.first] = np.exp(self.model.start)
        return forward_backward(self.scores, self.lengths, self.model.transitions, np.log(enter), self.along(after, True)[0], count_moves=False)[0]


def fit(texts: list[str], labels: list[str], steps: int = 400, batch: int = 48, rate: float = 0.2, seed: int = 5) -> Model:
    """Maximum likelihood by stochastic gradients (AdaGrad) on stretches of words; half of the sequences switch language."""
    languages = sorted(set(labels))
    count, rng = len(languages), np.random.default_rng(seed)
    weights = np.zeros((BUCKETS + 1, count), np.float32)
    if count < 2:
        return Model(languages, weights, np.zeros((count, count)), np.zeros(count))
    texts = [t.lower() for t in texts]
    tokens = Tokens(pa.array(texts, pa.large_string()), _GAPS)
    own = np.array([languages.index(x) for x in labels])
    sizes = np.diff(tokens.first)
    pools = [np.flatnonzero((own == k) & (sizes > 0)) for k in range(count)]
    pools = [p for p in pools if len(p)]
    transitions, start = np.zeros((count, count)), np.zeros(count)
    if len(pools) < 2:
        return Model(languages, weights, transitions, start)
    squares, moved = np.full(weights.shape, 1e-2, np.float32), np.full(transitions.shape, 1e-2)

    def stretch(pool: int, most: int) -> tuple[bytes, int, int]:
        doc = rng.choice(pools[pool])
        lo = tokens.first[doc] + rng.integers(max(1, sizes[doc] - most + 1))
        n = int(min(most, tokens.first[doc + 1] - lo))
        return tokens.data[tokens.starts[lo] : tokens.ends[lo + n - 1]].tobytes(), n, int(own[doc])

    for _ in range(steps):
        drawn, gold, lengths = [], [], []
        for i in range(batch):
            parts = [stretch(p, int(rng.integers(4, 25))) for p in rng.choice(len(pools), 1 + i % 2, replace=False)]
            drawn += [text for text, _, _ in parts]
            gold += [np.full(n, k) for _, n, k in parts]
            lengths.append(sum(n for _, n, _ in parts))
        # only the words that a step draws have features, so that memory doesn't grow with the sample
        rows, used = Features(pa.array(drawn, pa.large_binary()).cast(pa.large_string())).of_words()
        gold, lengths = np.concatenate(gold), np.array(lengths)
        scores = np.add.reduceat(weights[used], np.searchsorted(rows, np.arange(len(gold))), axis=0)
        posterior, expected = forward_backward(scores, lengths, transitions, start)
        slope = posterior
        slope[np.arange(len(gold)), gold] -= 1
        keys, where = np.unique(used, return_inverse=True)
        push = np.zeros((len(keys), count), np.float32)
        np.add.at(push, where, slope[rows].astype(np.float32))
        push = push / batch + 1e-4 * weights[keys]
        squares[keys] += push**2
        weights[keys] -= rate * push / np.sqrt(squares[keys])
        seen = np.zeros_like(transitions)
        inside = np.ones(len(gold), bool)
        inside[np.cumsum(lengths) - 1] = False
        np.add.at(seen, (gold[:-1][inside[:-1]], gold[1:][inside[:-1]]), 1)
        turn = (expected - seen) / batch + 1e-3 * transitions
        moved += turn**2
        transitions -= rate * turn / np.sqrt(moved)
    weights[BUCKETS] = 0
    return Model(languages, weights, transitions, start)


def training_fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3; documents with 1 are held out. A null doc_id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, chars: int = CHARS_PER_DOC) -> Model:
    """A model from the labelled documents that aren't held out.

    Takes per_language documents of each language (those with the least hash of doc_id and text) and of each a stretch
    of so many characters from a place that the hash picks: the sample's size is bounded, and so is the driver's part.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (training_fold(F.col("doc_id")) != 1))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    draw = F.xxhash64("doc_id", F.length("text"))
    bound = functools.reduce(lambda c, x: c.when(F.col("lang") == x[0], min(1.0, 1.2 * per_language / x[1])), counts.items(), F.when(F.lit(False), 0.0))
    place = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), F.greatest(F.lit(1), F.length("text") - chars)).cast("int") + 1
    rows = usable.where(F.pmod(draw, F.lit(1 << 30)) < bound * (1 << 30)).select("lang", draw.alias("draw"), F.substring("text", place, F.lit(chars)).alias("text"))
    taken: dict[str, int] = dict.fromkeys(counts, 0)
    texts, labels = [], []
    for r in sorted(rows.collect(), key=lambda r: (r["draw"], r["text"])):
        if taken[r["lang"]] < per_language:
            taken[r["lang"]] += 1
            texts.append(r["text"])
            labels.append(r["lang"])
    return fit(texts, labels)


def _pieces(data: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of PREDICT_BYTES at most, cut between words, or between characters where a word is longer."""
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + PREDICT_BYTES)
        if hi < len(data):
            gaps = np.flatnonzero(_CUTS[np.frombuffer(data, np.uint8, hi - lo, lo)])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
            else:
                while data[hi] & 0xC0 == 0x80:
                    hi -= 1
        yield lo, hi
        lo = hi


def _runs(labels: np.ndarray, names: list[str]) -> list[dict]:
    cuts = np.flatnonzero(np.diff(labels)) + 1
    bounds = [0, *cuts.tolist(), len(labels)]
    return [{"lang": names[labels[lo]], "words": hi - lo} for lo, hi in zip(bounds, bounds[1:], strict=False)] if len(labels) else []


def _label_long(text: str, model: Model) -> tuple[np.ndarray, list[dict]]:
    """Letters by language and runs of a text of any length, piece by piece: twice over the pieces, messages in between."""
    data = text.encode()
    flat = np.full(len(model.languages), 1.0 / len(model.languages))

    def chains() -> Iterator[tuple[Features, Chain]]:
        opens = True
        for lo, hi in _pieces(data):
            features = Features(pa.array([data[lo:hi]], pa.large_binary()).cast(pa.large_string()))
            if len(features.starts):
                yield features, Chain(features.emissions(model.weights), np.array([len(features.starts)]), model, piece=True, opens=opens)
                opens = False

    after = [flat]  # messages into the last word of each piece, from the last piece to the first
    for matrices in reversed([chain.matrices for _, chain in chains()]):  # a few numbers for each block of words
        message = after[-1]
        for m in matrices[::-1]:
            message = m @ message
            message = message / message.sum()
        after.append(message)
    total, runs, before = np.zeros(len(flat)), [], flat
    for (features, chain), message in zip(chains(), after[-2::-1], strict=True):
        posterior = chain.posterior(before, message)
        before = chain.along(before)[1][0]
        total += (posterior * (features.ends - features.starts)[:, None]).sum(0)
        for run in _runs(posterior.argmax(1), model.languages):
            if runs and runs[-1]["lang"] == run["lang"]:
                runs[-1]["words"] += run["words"]
            else:
                runs.append(run)
    return total, runs


def label(texts: pa.Array, model: Model) -> list[tuple[str, float, list[dict]]]:
    """For each text its language, score and runs of equally labelled words."""
    has_letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    names, out = model.languages, [(UNKNOWN, 0.0, [])] * len(texts)
    if not names:
        return out
    bytes_ = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)

    def verdict(total: np.ndarray, runs: list[dict]) -> tuple[str, float, list[dict]]:
        k = int(total.argmax())
        return names[k], float(min(1.0, total[k] / total.sum())), runs

    long = bytes_ > PREDICT_BYTES
    for i in np.flatnonzero(long & has_letter):
        total, runs = _label_long(texts[int(i)].as_py(), model)
        if runs:
            out[i] = verdict(total, runs)
    features = Features(pc.if_else(pa.array(long), "", pc.fill_null(texts, "")))
    sizes = np.diff(features.first)
    flat = np.full(len(names), 1.0 / len(names))
    posterior = Chain(features.emissions(model.weights), sizes, model).posterior(flat, np.ones(len(names)))
    letters = posterior * (features.ends - features.starts)[:, None]
    best = posterior.argmax(1) if len(posterior) else np.zeros(0, int)
    for i in np.flatnonzero(has_letter & (sizes > 0)):
        at = slice(features.first[i], features.first[i + 1])
        out[i] = verdict(letters[at].sum(0), _runs(best[at], names))
    return out


def _predict(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
    for batch in slices(batches, "text", PREDICT_BYTES):
        languages, scores, segments = zip(*label(batch.column("text"), shared.value), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(segments, kind)], names=["doc_id", "lang_pred", "score", "segments"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and segments for each row of docs (doc_id and text; other columns aren't looked at).

    Words are labelled by their posteriors given the whole text, however long; lang_pred has the greatest share of the
    letters and score is that share. segments lists the runs of equally labelled words, for code-switched texts. Null texts, texts
    without a letter, and all texts if the model knows no language, are 'und' with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(lambda b: _predict(b, shared), "doc_id long, lang_pred string, score double, segments array<struct<lang:string,words:long>>")


def _identified(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", PREDICT_BYTES):
        found = label(batch.column("text"), shared.value)
        yield batch.filter(pa.array([name != UNKNOWN and score >= LEAST_SCORE for name, score, _ in found], pa.bool_()))


def reject_unidentified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text is mostly in one of the languages learned from docs itself; the others go.

    Each row is judged by its own text: null and repeated doc_ids are rows like any other, and rows with equal texts
    share their fate. If no row has a language to learn from, none stays. All columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    return docs.mapInArrow(lambda b: _identified(b, shared), docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, train(docs))
    return found.select("doc_id", (training_fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score", F.size("segments").alias("n_segments"))
