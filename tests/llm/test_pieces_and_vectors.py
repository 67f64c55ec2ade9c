"""Encoding and decoding against the library; clustering and codes against plain versions in whole numbers."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from probeloom.llm import clustering, codes, pieces, vectors

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(pieces.model_path())


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def odd_texts(model, rng, n):
    """Runs of equal letters, spaces, marks, control characters and characters outside the vocabulary, and pieces at random."""
    alphabet = ["a", "e", "t", "h", "n", " ", "  ", "▁", "é", "漢", "字", "\n", "\t", "\0", "0", "1", "A", "s", "ing", "the", "\U0001f600", ".", "==", "--", "____", "<s>", "<0x41>", "́", "�"]
    texts = ["", " ", "  a", "a▁b", "▁", "a" * 3000, "ab" * 1500, "▁" * 40 + "x", " " * 300, "x" * 99 + "\n" * 50, "漢" * 500]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(n)]
    return texts + ["".join(model.pieces[rng.randrange(259, len(model.pieces))] for _ in range(rng.randint(1, 12))) for _ in range(n)]


def test_encoding_and_decoding_equal_the_library(model, library):
    texts = odd_texts(model, random.Random(3), 800)
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    got = pieces.encode_texts(pa.array([None, *texts]), encoder, {}, model.prefix).to_pylist()
    assert got == [[], *library.encode(texts)]
    assert [decoder.text(np.array(ids, np.int64)) for ids in got[1:]] == library.decode(got[1:])


def test_decoding_of_any_ids(model, library):
    rng, decoder = random.Random(4), pieces.Decoder(model)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(len(model.pieces)), rng.randrange(259), rng.randrange(3, 259), 259]) for _ in range(rng.randint(0, 7))]
        assert decoder.text(np.array(ids, np.int64)) == library.decode(ids), ids


def test_tokens_equal_merging_the_whole_text(model):
    encoder, rng = pieces.Encoder(model), random.Random(5)
    for text in odd_texts(model, rng, 150)[-300:]:
        text = text[:60]
        assert [encoder._name(t) for t in encoder.tokens(text)] == encoder.merge(text)


def test_backtracking_takes_tokens_back():
    """The longest first piece leaves no way on: 'abc' covers what 'ab' and 'cd' need."""
    names = ["<unk>", *[f"<0x{i:02X}>" for i in range(256)], "a", "b", "c", "d", "cd", "ab", "bcd", "abc"]
    kinds = [pieces.UNKNOWN, *[pieces.BYTE] * 256, *[pieces.NORMAL] * 8]
    scores = [0.0] * 257 + [-9.0] * 4 + [-1.0, -2.0, -3.0, -4.0]
    encoder = pieces.Encoder(pieces.Vocabulary(names, scores, kinds, False))
    rng = random.Random(6)
    for text in ["abcd", "abc", "bcd", "aabcd", *["".join(rng.choices("abcdx", k=rng.randint(1, 14))) for _ in range(2000)]]:
        assert [encoder._name(t) for t in encoder.tokens(text)] == encoder.merge(text), text


def test_sentencepiece_query_and_edge_rows(spark, model, library):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "no id"), (5, "word " * 40_000), (6, "x" * 70_000), (7, "ünï • 漢字 \U0001f600")]
    docs = spark.createDataFrame([(i, t, 1, [2]) for i, t in rows], "doc_id long, text string, ids int, tokens array<int>")  # clashing names
    found = {(r["doc_id"], r["text"]): r["ids"] for r in pieces.decode(pieces.encode(docs, model), model).collect()}
    assert found == {(i, t or ""): library.encode(t or "") for i, t in rows}
    assert pieces.decode(spark.createDataFrame([(1, None), (2, []), (3, [None, 1, 264])], "doc_id long, ids array<int>"), model).select("text").collect() == [("",), ("",), ("a",)]
    assert pieces.encode(docs.limit(0), model).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pieces.op11_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# --- vectors ------------------------------------------------------------------------------------------------------


def test_packed_round_trip():
    rows = np.arange(12, dtype=np.int32).reshape(4, 3)
    column = vectors.packed(rows)
    assert (vectors.unpacked(column, np.int32, 3) == rows).all() and (vectors.unpacked(column.slice(1, 2), np.int32, 3) == rows[1:3]).all()


@pytest.mark.parametrize("spread", [2, 40, 1000])
def test_nearest_is_exact_with_ties(spread):
    rng = np.random.default_rng(spread)
    rows, centroids = rng.integers(-spread, spread, (400, 6)), rng.integers(-spread, spread, (9, 6))
    centroids[5] = centroids[2]
    pivots = clustering.choose_pivots(rows[:50], 4)
    got = clustering.nearest(rows, clustering.to_pivots(rows, pivots), centroids, clustering.to_pivots(centroids, pivots))
    all_ = ((rows[:, None] - centroids[None]) ** 2).sum(2)
    assert (got[0] == all_.argmin(1)).all() and (got[1] == all_.min(1)).all()


@pytest.mark.parametrize("spread", [2, 40, 1000])
def test_near_entries_are_exact_with_ties(spread):
    rng = np.random.default_rng(spread)
    rows, entries = rng.integers(-spread, spread, (500, 4)), rng.integers(-spread, spread, (16, 4))
    entries[7] = entries[3]
    own, far = codes.assign_all(rows, entries)
    for _ in range(4):
        all_ = ((rows[:, None] - entries[None]) ** 2).sum(2)
        radii = np.array([np.sqrt(all_[own == i, i].max(initial=0)) for i in range(16)]) + 1e-6
        own, far = codes.assign_near(rows, own, codes.balls(entries, radii))
        assert (own == all_.argmin(1)).all() and (far == all_.min(1)).all()
        entries = entries + rng.integers(-spread // 4 - 1, spread // 4 + 2, entries.shape)


ODD = [(None, [0.5] * 64, None), (7, None, 1), (8, [], 1), (9, [0.1] * 63, 1), (10, [0.1] * 65, 1), (11, [0.1] * 63 + [None], 1), (12, [float("nan")] + [0.1] * 63, 1), (13, [float("inf")] + [0.1] * 63, 1), (14, [0.1] * 63 + [float("-inf")], 2), (15, [3e38] * 64, 2), (15, [-3e38] * 64, None)]
VECTORS = "vec_id long, embedding array<float>, label int, ints int, cluster string, position int"


def some_vectors(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=64) + 3 * (i % 5))], int(i % 3) if i % 4 else None) for i in range(n)]
    rows += rows[:3] + rows[1:2]  # repeated rows, repeated ids
    return rows, spark.createDataFrame([r + (1, "x", 2) for r in rows + ODD], VECTORS)


def plain_ints(rows, scale):
    keep = [(i, x, y) for i, x, y in rows if x is not None and len(x) == 64 and all(v is not None and np.isfinite(v) for v in x)]
    ints = [[max(-vectors.LARGEST, min(vectors.LARGEST, int(np.floor(scale * float(np.float32(v)))))) for v in x] for _, x, _ in keep]
    return [i for i, _, _ in keep], np.array(ints, object), [y for _, _, y in keep]


def plain_means(rows, own, centroids, rounds):
    """Lloyd's rounds in Python's whole numbers."""
    for r in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids] for x in rows]
        own = [f.index(min(f)) for f in far]
        if r < rounds:
            for j in set(own):
                mine = [x for x, o in zip(rows, own) if o == j]
                centroids[j] = [sum(v) // len(mine) for v in zip(*mine)]
    return own, [min(f) for f in far], centroids


def test_clusters_equal_plain_rounds(spark):
    rows, df = some_vectors(spark, 120)
    ids, ints, _ = plain_ints(rows + ODD, 64)
    ints = [list(x) for x in ints]
    order = sorted(range(len(ids)), key=lambda k: (hashlib.sha256(f"1:{'' if ids[k] is None else ids[k]}".encode()).hexdigest(), ints[k]))
    own, far, centroids = plain_means(ints, None, [list(ints[k]) for k in order[:16]], 3)
    found = clustering.cluster_vectors(df)
    assert found.centroids.tolist() == centroids
    got = sorted((r["vec_id"] is None, r["vec_id"], r["cluster"], r["distance"]) for r in found.assigned.collect() if r["vec_id"] is not None)
    assert got == sorted((i is None, i, o, f) for i, o, f in zip(ids, own, far) if i is not None)
    assert found.assigned.count() == len(ids)


def test_codes_equal_plain_rounds(spark):
    rows, df = some_vectors(spark, 100, 2)
    ids, ints, labels = plain_ints(rows + ODD, 4096)
    ints = [list(x) for x in ints]
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, ints[k]))
    code, error, books = [[] for _ in ids], [0] * len(ids), []
    for p in range(8):
        part = [x[8 * p : 8 * p + 8] for x in ints]
        own, far, book = plain_means(part, None, [list(part[k]) for k in order[:16]], 6)
        books.append(book)
        for k, (o, f) in enumerate(zip(own, far)):
            code[k].append(o)
            error[k] += f
    found = codes.compress(df)
    assert found.codebooks.tolist() == books
    got = found.codes.withColumn("again", codes.rebuilt(F.col("code"), found.codebooks)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[2], x[3])
    want = [(i, None if y is None else str(y), tuple(c), e) for i, y, c, e in zip(ids, labels, code, error)]
    assert sorted(((r["vec_id"], r["label"], tuple(r["code"]), r["error"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["again"] == [x for p, c in enumerate(r["code"]) for x in books[p][c]] for r in got)


def test_few_or_no_vectors(spark):
    _, df = some_vectors(spark, 3)
    few = df.where("vec_id < 2")
    assert clustering.cluster_vectors(few).centroids.shape == (5, 64) and {r["distance"] for r in clustering.cluster_vectors(few).assigned.collect()} == {0}
    assert {r["error"] for r in codes.compress(few).codes.collect()} == {0}
    none = df.where("embedding IS NULL")
    assert clustering.cluster_vectors(none).assigned.count() == 0 and codes.compress(none).codes.count() == 0
