"""Registered queries of this subpackage: name -> (callable(spark, sf_dir), DuckDB text or None)."""

from __future__ import annotations

from tidecast.llm import align, bpe, chat, license, lm, merkle, mixing, quality, shard, simhash, tokenfiles, topk, warc

QUERIES = {
    "op1_exact_topk": (topk.op1_exact_topk, topk.ORACLE),
    "op2_bpe_roundtrip": (bpe.op2_bpe_roundtrip, None),
    "op3_ppm_scores": (lm.op3_ppm_scores, None),
    "op4_slot_shards": (shard.op4_slot_shards, None),
    "op5_simhash_components": (simhash.op5_simhash_components, None),
    "op6_license_scan": (license.op6_license_scan, None),
    "op7_quality_rules": (quality.op7_quality_rules, quality.ORACLE),
    "op8_entropy_mix": (mixing.op8_entropy_mix, None),
    "op9_token_files": (tokenfiles.op9_token_files, None),
    "op10_chat_format": (chat.op10_chat_format, chat.ORACLE),
    "op11_token_alignment": (align.op11_token_alignment, None),
    "op12_merkle_manifest": (merkle.op12_merkle_manifest, None),
    "op13_warc_revisits": (warc.op13_warc_revisits, None),
}
