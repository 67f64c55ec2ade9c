"""The pipeline's stages against plain versions."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from probeloom.llm import decontaminate, language, mixing
from probeloom.llm.common import read

from .test_corpus_operators import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SF, "documents"), {}
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, f(spark, docs, SF).cache()
        out[name] = (before, docs)
    return out


def test_columns_and_names(spark, stages):
    columns = read(spark, SF, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mix_sources", "shard_documents"]
    for name, (_, after) in stages.items():
        assert after.columns == columns + (["shard", "slot"] if name == "shard_documents" else [])


def test_language_stage_rejects_what_the_model_rejects(spark, stages):
    before, after = stages["language_id"]
    found = language.identify(before, language.train(before)).collect()
    assert {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5} == {r["doc_id"] for r in after.collect()}
    odd = before.limit(1).select(F.lit(10**9).alias("doc_id"), F.lit("123 -- 456").alias("text"), "lang", "source", "n_chars")
    assert 10**9 not in {r["doc_id"] for r in language.reject_unidentified(before.unionByName(odd)).collect()}


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    found = brute_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {d for d, (_, root) in found.items() if d == root}


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    norm = lambda t: f" {' '.join(decontaminate.words_of(t))} "
    items = [norm(r["text"]) for r in read(spark, SF, "benchmark").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    exact = {r["doc_id"] for r in before.collect() if any(i in norm(r["text"]) for i in items)}
    assert not exact & kept
    others = {r["doc_id"] for r in before.collect()} - exact
    assert len(others - kept) <= 0.01 * len(others) + 1


def test_mix_stage(stages):
    before, after = stages["mix_sources"]
    copies = {r["doc_id"]: r["_copies"] for r in mixing.mix_rates(before).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter({d: n for d, n in copies.items() if n})
    assert all(len(re.findall(r"\S+", r["text"])) >= 0 for r in after.collect())


def test_shard_stage(stages):
    before, after = stages["shard_documents"]
    rows = after.collect()
    assert len(rows) == before.count() and len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["shard_documents"][1].count()


def written(spark, folder, rows, items):
    """A folder with small documents and benchmark tables; documents have extra columns with names that stages use themselves."""
    clash = ["_source", "_target", "_copy", "_copies", "_size", "_rate", "_hash", "_rank", "_cell", "_slot", "_to", "_lo", "_bad_id", "_bad_hash", "__x", "kept", "component_id", "item_id", "rep"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, lang_pred string, text_hash int, " + ", ".join(f"`{c}` string" for c in clash)
    docs = [(d, t, lang, source, len(t or ""), "clash", None, 7, *clash) for d, t, lang, source in rows]
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_edge_rows_go_through_all_stages(spark, tmp_path):
    sentence = lambda k, ws: " ".join(ws[(i * k + k) % len(ws)] for i in range(30))
    en, fr = "the cat sat on a mat with all of them and then it went home again for tea".split(), "le chat est sur la table avec nous et puis il va encore dans sa maison".split()
    rows = [(k, sentence(k, en), "en", "a") for k in range(1, 12)] + [(k, sentence(k - 19, fr), "fr", None) for k in range(20, 31)]
    leak = sentence(13, en) + " zebra quagga okapi"
    rows += [(None, sentence(16, en) + " one more", "en", "a"), (None, "123 456", "en", "a"), (None, None, None, None), (3, "-- 12 --", "en", "a"), (40, "", None, "b"), (41, leak, "en", "b"), (None, leak, "en", "b")]
    rows.append(rows[0])
    folder = written(spark, str(tmp_path / "t"), rows, [(1, leak), (None, None)])
    docs, sizes = read(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        sizes.append((name, docs.count()))
    kept = docs.collect()
    columns = read(spark, folder, "documents").columns
    assert docs.columns == [c for c in columns if c != "shard"] + ["shard", "slot"]
    assert all(r[c] == c for r in kept for c in columns if c.startswith("_") or c in ("kept", "component_id", "item_id", "rep"))
    texts = {t for _, t, *_ in rows}
    assert {r["text"] for r in kept} <= texts - {"123 456", None, "-- 12 --", "", leak}
    assert sizes[0] == ("language_id", 26) and len({(r["shard"], r["slot"]) for r in kept}) == len(kept)
    assert corpus_pipeline.run(spark, folder).count() == len(kept)


def test_empty_tables(spark, tmp_path):
    folder = written(spark, str(tmp_path / "t"), [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
