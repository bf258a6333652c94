"""Registered queries of the operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ball_tree, block_ann, cover_dedup, mixing, trie_join, variance_kmeans
from .ball_tree import op12_ball_tree
from .block_ann import op6_block_ann
from .bloom_lm import op4_bloom_lm
from .bpe import op5_bpe
from .cover_dedup import op8_cover_dedup
from .fingerprint import op2_fingerprint
from .mixing import op7_mixing
from .periodic_runs import op13_periodic_runs
from .suffix_dedup import op3_suffix_dedup
from .trie_join import op10_trie_join
from .variance_kmeans import op11_variance_kmeans
from .weak_labels import op1_weak_labels
from .wrapper_html import op9_wrapper_html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_weak_labels": op1_weak_labels,
    "op2_fingerprint": op2_fingerprint,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_bloom_lm": op4_bloom_lm,
    "op5_bpe": op5_bpe,
    "op6_block_ann": op6_block_ann,
    "op7_mixing": op7_mixing,
    "op8_cover_dedup": op8_cover_dedup,
    "op9_wrapper_html": op9_wrapper_html,
    "op10_trie_join": op10_trie_join,
    "op11_variance_kmeans": op11_variance_kmeans,
    "op12_ball_tree": op12_ball_tree,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op6_block_ann": block_ann.SQL,
    "op7_mixing": mixing.SQL,
    "op8_cover_dedup": cover_dedup.SQL,
    "op10_trie_join": trie_join.SQL,
    "op11_variance_kmeans": variance_kmeans.SQL,
    "op12_ball_tree": ball_tree.SQL,
}
