"""Queries and SQL of every operator in this subpackage, and of the pipeline."""

from __future__ import annotations

from . import (
    collocations,
    decontamination,
    divergence,
    language_id,
    merkle,
    minhash,
    ngram_jaccard,
    piece_codec,
    quotes,
    substring_dedup,
    suffix_tree_lm,
    token_blocks,
    wrapper,
)

MODULES = [
    language_id,
    merkle,
    piece_codec,
    quotes,
    decontamination,
    token_blocks,
    wrapper,
    ngram_jaccard,
    substring_dedup,
    suffix_tree_lm,
    divergence,
    collocations,
    minhash,
]


def queries() -> dict:
    import corpus_pipeline

    found = {"pipeline": corpus_pipeline.run}
    for module in MODULES:
        found.update(module.QUERIES)
    return found


def oracles() -> dict[str, str]:
    import corpus_pipeline

    found = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    for module in MODULES:
        found.update(module.ORACLES)
    return found
