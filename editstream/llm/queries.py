"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .op1_toxicity import op1_clause_grammar
from .op2_jaccard import OP2_SQL, op2_minhash_forest
from .op3_sentencepiece import op3_chunk_table_pieces
from .op4_packing import op4_best_two_fit
from .op5_chat import OP5_SQL, op5_columnar_chat
from .op6_pii import op6_keyed_surrogates
from .op7_repeats import OP7_SQL, op7_sparse_doubling
from .op8_neardup import OP8_SQL, op8_epsilon_grid
from .op9_topk import OP9_SQL, op9_histogram_topk
from .op10_sharding import OP10_SQL, op10_stratified_interleave
from .op11_search import OP11_SQL, op11_reversed_search
from .op12_runs import OP12_SQL, op12_lcp_kruskal
from .op13_urls import op13_path_templates

QUERIES = {
    "op1_clause_grammar": op1_clause_grammar,
    "op2_minhash_forest": op2_minhash_forest,
    "op3_chunk_table_pieces": op3_chunk_table_pieces,
    "op4_best_two_fit": op4_best_two_fit,
    "op5_columnar_chat": op5_columnar_chat,
    "op6_keyed_surrogates": op6_keyed_surrogates,
    "op7_sparse_doubling": op7_sparse_doubling,
    "op8_epsilon_grid": op8_epsilon_grid,
    "op9_histogram_topk": op9_histogram_topk,
    "op10_stratified_interleave": op10_stratified_interleave,
    "op11_reversed_search": op11_reversed_search,
    "op12_lcp_kruskal": op12_lcp_kruskal,
    "op13_path_templates": op13_path_templates,
}

ORACLES = {
    "op2_minhash_forest": OP2_SQL,
    "op5_columnar_chat": OP5_SQL,
    "op7_sparse_doubling": OP7_SQL,
    "op8_epsilon_grid": OP8_SQL,
    "op9_histogram_topk": OP9_SQL,
    "op10_stratified_interleave": OP10_SQL,
    "op11_reversed_search": OP11_SQL,
    "op12_lcp_kruskal": OP12_SQL,
}
