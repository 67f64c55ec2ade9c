"""Queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from . import clustering, codes, decontaminate, fingerprints, html_text, language, line_dedup, minhash, mixing, pieces, secrets, sharding, substring

QUERIES = {
    "op1_minhash_near_dedup": minhash.op1_minhash_near_dedup,
    "op2_html_extraction": html_text.op2_html_extraction,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_shard_documents": sharding.op6_shard_documents,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_document_fingerprints": fingerprints.op8_document_fingerprints,
    "op9_language_id": language.op9_language_id,
    "op10_substring_dedup": substring.op10_substring_dedup,
    "op11_sentencepiece": pieces.op11_sentencepiece,
    "op12_centroid_clustering": clustering.op12_centroid_clustering,
    "op13_vector_codes": codes.op13_vector_codes,
}

ORACLE = {
    "op1_minhash_near_dedup": minhash.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op10_substring_dedup": substring.ORACLE,
    "op12_centroid_clustering": clustering.ORACLE,
    "op13_vector_codes": codes.ORACLE,
}
