"""The operators' queries, one for each, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from . import bpe, code_compression, embedding_dedup, mixing, neighbours, ngram_join, resampling, sharding, suffix_dedup, token_files, toxicity, url_filter, warc


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_mixing": mixing.op2_mixing,
        "op3_neighbours": neighbours.op3_neighbours,
        "op4_ngram_join": ngram_join.op4_ngram_join,
        "op5_bpe": bpe.op5_bpe,
        "op6_token_files": token_files.op6_token_files,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_warc": warc.op8_warc,
        "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_code_compression": code_compression.op11_code_compression,
        "op12_resampling": resampling.op12_resampling,
        "op13_sharding": sharding.op13_sharding,
        "mixing_unweighted": mixing.mixing_unweighted,
        "embedding_near_copies": embedding_dedup.embedding_near_copies,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.SQL,
        "mixing_unweighted": mixing.UNWEIGHTED_SQL,
        "op8_warc": warc.SQL,
        "op9_embedding_dedup": embedding_dedup.SQL,
        "embedding_near_copies": embedding_dedup.NEAR_COPIES_SQL,
        "op10_url_filter": url_filter.SQL,
        "op11_code_compression": code_compression.SQL,
        "op12_resampling": resampling.SQL,
    }
