"""SentencePiece encoding and decoding of merge-type (BPE) models by backtracking over dictionary matches."""

from __future__ import annotations

import codecs
import functools
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _bytes_of, read, slices

#: The sign that stands for a space in pieces.
MARK = "▁"
_MARK = MARK.encode()
#: Kinds of pieces in a model file. Fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Encodings of chunks and checked pairs that a task keeps at most; then it starts anew.
CACHE_CHUNKS, CACHE_PAIRS = 600_000, 1_000_000
#: Only chunks of so many bytes at most are kept.
CACHE_BYTES = 64
#: Stands before the first token; no character's token.
_BEGIN = -(1 << 24)
_LAST = float("inf")


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: pieces by id, their scores and kinds, and how texts are prepared."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    prefix: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message: numbers, and bytes of strings, messages and fixed-width numbers."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else number()
        yield key >> 3, data[at : at + size]
        at += size


def load_model(path: str) -> Vocabulary:
    """The vocabulary of a model file, which the driver reads. Models whose texts need more than their spaces replaced are refused."""
    with open(path, "rb") as file:
        data = file.read()
    pieces, scores, kinds = [], [], []
    trainer: dict[int, int | bytes] = {}
    normalizer: dict[int, int | bytes] = {}
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normalizer = dict(_fields(value))
    plain = trainer.get(3, 1) == 2 and not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1) and not trainer.get(24, 0)
    if not plain or USER_DEFINED in kinds or UNUSED in kinds or kinds.count(BYTE) != 256:
        raise ValueError(f"{path}: only merge-type models with byte pieces that keep all white space are supported")
    return Vocabulary(pieces, scores, kinds, bool(normalizer.get(3, 1)))


class Encoder:
    """Merge-type encoding of chunks of text.

    The merges of a text give the one sequence of tokens in which any two neighbours, merged again on their own, give
    just these two. So a text is covered from the left by the longest piece at each place (one Aho-Corasick pass finds
    them all); a piece that doesn't agree with its neighbour gives way to the longest shorter one, and where none is
    left the token before is taken back and its end marked as failed: each place is reached by one sequence of tokens
    only, so it fails for good. A character that no piece has is a token of its own, -1 - its code point.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.names = vocabulary.pieces
        self.rank = {p: (-s, i) for i, (p, s, k) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.kinds, strict=True)) if k == NORMAL}
        self.sizes = [len(p) for p in vocabulary.pieces]
        self.matches = ahocorasick.Automaton()
        for piece, (_, i) in self.rank.items():
            self.matches.add_word(piece, i)
        self.matches.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.agreed: dict[tuple[int, int], bool] = {}
        self.bytes = [i for i, k in enumerate(vocabulary.kinds) if k == BYTE]
        #: neighbouring bytes between which a chunk may end: ASCII characters that are neighbours in no piece
        near = {pair for p in self.rank for pair in zip(p, p[1:], strict=False)}
        self.apart = np.zeros((256, 256), bool)
        self.apart[:128, :128] = [[(chr(a), chr(b)) not in near for b in range(128)] for a in range(128)]
        #: whether chunks may begin before each mark that follows another character
        self.by_word = not any(a != MARK and b == MARK for a, b in near)

    def _name(self, token: int) -> str:
        return self.names[token] if token >= 0 else chr(-1 - token)

    def _prefix(self, token: int) -> int | None:
        """The longest piece that a token begins with, but for itself; of single characters none."""
        if token not in self.shorter:
            name, found = self._name(token), None
            for n in range(len(name) - 1, 0, -1):
                if name[:n] in self.rank:
                    found = self.rank[name[:n]][1]
                    break
                if n == 1:
                    found = -1 - ord(name[0])
            self.shorter[token] = found
        return self.shorter[token]

    def merge(self, text: str) -> list[str]:
        """The merges of a short text, one by one: the neighbours of the best score first, of equal ones the leftmost."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = _LAST, -1
            for i in range(len(parts) - 1):
                found = rank.get(parts[i] + parts[i + 1])
                if found is not None and found[0] < best:
                    best, at = found[0], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _agree(self, left: int, right: int) -> bool:
        """Whether two tokens, merged again, stay as they are. left: _BEGIN before the first."""
        if len(self.agreed) >= CACHE_PAIRS:
            self.agreed.clear()
        names = [self._name(right)] if left == _BEGIN else [self._name(left), self._name(right)]
        found = self.agreed[left, right] = self.merge("".join(names)) == names
        return found

    def tokens(self, text: str) -> list[int]:
        sizes, known = self.sizes, self.agreed
        longest: list[int | None] = [None] * len(text)
        for end, piece in self.matches.iter(text):
            longest[end + 1 - sizes[piece]] = piece
        failed = bytearray(len(text) // 8 + 1)  # a bit for each place
        out: list[int] = []
        at, left, last = 0, _BEGIN, len(text)
        token = longest[0] if text else None
        while at < last:
            if token is None:
                token = -1 - ord(text[at])
            while token is not None:
                end = at + (sizes[token] if token >= 0 else 1)
                if not failed[end >> 3] >> (end & 7) & 1:
                    found = known.get((left, token))
                    if self._agree(left, token) if found is None else found:
                        break
                token = self._prefix(token)
            while token is None:  # the token before is taken back and gives way to a shorter one
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                left = out[-1] if out else _BEGIN
                at -= sizes[token] if token >= 0 else 1
                token = self._prefix(token)
                end = -1
            if end >= 0:
                out.append(token)
                at, left = end, token
                token = longest[at] if at < last else None
        return out

    def ids(self, text: str) -> list[int]:
        """Tokens with the characters that no piece has as the pieces of their bytes."""
        tokens = self.tokens(text)
        if not tokens or min(tokens) >= 0:
            return tokens
        return [i for t in tokens for i in ([t] if t >= 0 else [self.bytes[b] for b in chr(-1 - t).encode()])]

    def chunk_bounds(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where texts are cut into chunks that no piece crosses, as bytes' places; texts' own bounds are among them."""
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        if len(data) > 1:
            cut[1:-1] |= self.apart[data[:-1], data[1:]]
        if self.by_word and len(data) > 2:
            mark = np.zeros(len(data) + 3, bool)
            mark[3:-2] = (data[:-2] == _MARK[0]) & (data[1:-1] == _MARK[1]) & (data[2:] == _MARK[2])
            cut[:-1] |= mark[3:] & ~mark[:-3]
        return np.flatnonzero(cut)


@functools.lru_cache(maxsize=1)
def _encoder(shared: Broadcast) -> tuple[Encoder, dict[bytes, bytes]]:
    return Encoder(shared.value), {}


def encode_texts(texts: pa.Array, encoder: Encoder, known: dict[bytes, bytes], prefix: bool) -> pa.ListArray:
    """Ids of each text of a column. known: encodings of chunks so far."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    marked = pc.replace_substring(texts, " ", MARK)
    if prefix:
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), marked, pa.scalar("", pa.large_string())))
    data, bounds = _bytes_of(marked)
    cuts = encoder.chunk_bounds(data, bounds)
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]) if len(cuts) > 1 else pa.array([], pa.large_binary())
    chunks = chunks.dictionary_encode()
    found = []
    for chunk in chunks.dictionary.to_pylist():
        ids = known.get(chunk)
        if ids is None:
            ids = array("i", encoder.ids(chunk.decode())).tobytes()
            if len(chunk) <= CACHE_BYTES:
                if len(known) >= CACHE_CHUNKS:
                    known.clear()
                known[chunk] = ids
        found.append(ids)
    which = chunks.indices.to_numpy()
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), np.int32)
    before = np.cumsum(sizes) - sizes
    lengths = sizes[which]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(before[which] - ends[:-1], lengths) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends[np.searchsorted(cuts, bounds)].astype(np.int32)), pa.array(flat[at]))


def encode(docs: DataFrame, model: Vocabulary) -> DataFrame:
    """doc_id and ids (array of int) for each row of docs (doc_id and text; other columns are ignored).

    The ids are those of the model's own merges, without begin and end ids. Whole texts of any length are encoded; null
    and empty ones have no ids; equal texts have equal ids; rows that repeat a doc_id are encoded each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = _encoder(shared)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), encode_texts(batch.column("text"), encoder, known, shared.value.prefix)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


# --- decoding -----------------------------------------------------------------------------------------------------


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


class Decoder:
    """Texts of ids, by a table of the bytes of each piece."""

    def __init__(self, vocabulary: Vocabulary):
        kinds = np.array(vocabulary.kinds)
        parts = []
        byte = 0
        for name, kind in zip(vocabulary.pieces, vocabulary.kinds, strict=True):
            if kind == BYTE:
                parts.append(bytes([byte]))
                byte += 1
            else:
                parts.append(b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else name.replace(MARK, " ").encode())
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.control = kinds == CONTROL
        #: pieces whose first space goes where they begin a text
        self.leads = np.array([vocabulary.prefix and k == NORMAL and p.startswith(MARK) for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True)])

    def text(self, ids: np.ndarray) -> str:
        """Bytes that aren't UTF-8 become U+FFFD, one for each."""
        ids = ids[~self.control[ids]]
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.data[at][int(self.leads[ids[0]]) :].tobytes().decode("utf-8", "each_byte")


@functools.lru_cache(maxsize=1)
def _decoder(shared: Broadcast) -> Decoder:
    return Decoder(shared.value)


def decode(tokens: DataFrame, model: Vocabulary) -> DataFrame:
    """doc_id, ids and text for each row of tokens (doc_id and ids; other columns are ignored).

    Null and empty ids give an empty text, null ids in an array nothing, control ids nothing; ids outside the vocabulary are an error.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(shared)
        for batch in batches:
            column = batch.column("ids")
            step = max(1, int(batch.num_rows * (1 << 20) / max(1, len(column.values))))  # about a million ids at a time
            for lo in range(0, batch.num_rows, step):
                part = column.slice(lo, step)
                texts = [decoder.text(x.values.drop_null().to_numpy().astype(np.int64)) if x.is_valid else "" for x in part]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, step), part, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def model_path() -> str:
    """The installed public model; its place is the caller's to choose."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = load_model(model_path())
    found = decode(encode(read(spark, sf_dir, "documents"), model), model)
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
