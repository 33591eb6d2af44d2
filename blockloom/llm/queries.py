"""All queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from . import exact_dedup, fill_in_middle, jaccard, language, merkle, mixing, pieces, quality, suffix_tree, token_frames, top_k, toxicity, warc

QUERIES = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_token_frames": token_frames.op2_token_frames,
    "op3_top_k": top_k.op3_top_k,
    "op4_warc": warc.op4_warc,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_language_id": language.op7_language_id,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality": quality.op10_quality,
    "op11_suffix_tree": suffix_tree.op11_suffix_tree,
    "op12_merkle": merkle.op12_merkle,
    "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
}
ORACLES = {
    "op3_top_k": top_k.OP3_SQL,
    "op4_warc": warc.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op12_merkle": merkle.OP12_SQL,
    "op13_fill_in_middle": fill_in_middle.OP13_SQL,
}
