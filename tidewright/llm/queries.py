"""The queries of this subpackage, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import binary, counts, packing, pieces, quality, rules, simhash, suffixes, toxicity, vectors

QUERIES = {
    "op1_sentencepiece_dropout": pieces.op1_query,
    "op2_quality_embeddings": quality.op2_query,
    "op3_tiered_packing": packing.op3_query,
    "op4_simhash_byte_index": simhash.op4_query,
    "op5_toxicity_channel": toxicity.op5_query,
    "op6_suffix_array_dedup": suffixes.op6_query,
    "op7_token_id_files": binary.op7_query,
    "op8_longest_match_counts": counts.op8_query,
    "op9_weak_supervision_rules": rules.op9_query,
    "op10_collision_projections": vectors.op10_query,
}

ORACLES = {"op9_weak_supervision_rules": rules.OP9_SQL}
