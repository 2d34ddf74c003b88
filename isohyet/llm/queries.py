"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import counting, divergence, fingerprints, infill, media, mixing, packing, pieces, quality, sharding, simhash, sstable, suffixes

QUERIES = {
    "op1_harmonic_packing": packing.op1_harmonic_packing,
    "op2_archived_media": media.op2_archived_media,
    "op3_canonical_digests": fingerprints.op3_canonical_digests,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_token_counts": counting.op5_token_counts,
    "op6_hilbert_sharding": sharding.op6_hilbert_sharding,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_simhash_groups": simhash.op8_simhash_groups,
    "op9_token_shards": sstable.op9_token_shards,
    "op10_quality_scores": quality.op10_quality_scores,
    "op11_fill_in_middle": infill.op11_fill_in_middle,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

#: The others can't be written in SQL: they hash, tokenise, compress or learn. Their tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op11_fill_in_middle": infill.OP11_SQL, "op12_source_divergence": divergence.OP12_SQL}
