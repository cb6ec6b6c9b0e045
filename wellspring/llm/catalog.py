"""Registered training-data queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bm25, chat, context_tree, infill, mixing, ngram_join, nn_descent, packing, quality, repeats, spelling, token_counts, toxicity

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_repeats": repeats.op2_repeats,
    "op3_mixing": mixing.op3_mixing,
    "op4_packing": packing.op4_packing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_jaccard": ngram_join.op7_jaccard,
    "op8_neighbours": nn_descent.op8_neighbours,
    "op9_search": bm25.op9_search,
    "op10_chat": chat.op10_chat,
    "op11_scores": context_tree.op11_scores,
    "op12_infill": infill.op12_infill,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op3_mixing": mixing.ORACLE_SQL,
    "op10_chat": chat.ORACLE_SQL,
    "op11_scores": context_tree.op11_scores,
    "op12_infill": infill.ORACLE_SQL,
    "op13_spelling": spelling.ORACLE_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
