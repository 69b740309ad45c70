"""The corpus queries by name, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import op1_embeddings, op2_licenses, op3_warc, op4_lines, op5_pii, op6_sentencepiece, op7_simhash, op8_decontaminate, op9_toxicity, op10_shards, op11_fingerprints, op12_negatives, op13_whitening

QUERIES = {
    "op1_near_vectors": op1_embeddings.query,
    "op2_licenses": op2_licenses.query,
    "op3_warc": op3_warc.query,
    "op4_line_dedup": op4_lines.query,
    "op5_pii": op5_pii.query,
    "op6_sentencepiece": op6_sentencepiece.query,
    "op7_simhash": op7_simhash.query,
    "op8_decontaminate": op8_decontaminate.query,
    "op9_toxicity": op9_toxicity.query,
    "op10_shards": op10_shards.query,
    "op11_fingerprints": op11_fingerprints.query,
    "op12_hard_negatives": op12_negatives.query,
    "op13_whitening": op13_whitening.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op1_near_vectors": op1_embeddings.ORACLE,
    "op2_licenses": op2_licenses.ORACLE,
    "op3_warc": op3_warc.ORACLE,
    "op4_line_dedup": op4_lines.ORACLE,
    "op8_decontaminate": op8_decontaminate.ORACLE,
    "op12_hard_negatives": op12_negatives.ORACLE,
}
