"""One query per operator of this subpackage; the SQL texts are DuckDB's."""

from __future__ import annotations

from collections.abc import Callable

from .ann_forest import op7_ann_forest
from .byte_bpe import op5_byte_bpe
from .centroid_clustering import op13_centroid_clusters, op13_sql
from .flat_graph import OP11_SQL, op11_flat_graph
from .html_extract import op6_html_extract
from .ngram_join import OP4_SQL, op4_ngram_jaccard_join
from .packing import op8_best_fit_packing
from .preference import OP1_SQL, op1_preference_format
from .pii import op2_pii
from .quality_rules import op10_quality_rules, op10_sql
from .substring_dedup import op9_substring_dedup
from .toxicity import op3_toxicity
from .whitening import op12_whitening

QUERIES: dict[str, Callable] = {
    "op1_preference_format": op1_preference_format,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_html_extract": op6_html_extract,
    "op7_ann_forest": op7_ann_forest,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_flat_graph": op11_flat_graph,
    "op12_whitening": op12_whitening,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLES: dict[str, str] = {
    "op1_preference_format": OP1_SQL,
    "op4_ngram_jaccard_join": OP4_SQL,
    "op10_quality_rules": op10_sql(),
    "op11_flat_graph": OP11_SQL,
    "op13_centroid_clusters": op13_sql(),
}
