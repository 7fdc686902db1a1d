"""The operators of this package as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op5_merge_automaton
from .embeddings import op6_product_quantisation
from .filter_audit import OP12_SQL, op12_filter_audit
from .html_extract import op1_path_ratios
from .lm_scoring import op2_cross_entropy
from .packing import op4_best_fit
from .periodic import op11_grammar_runs
from .pii import op3_contextual_pii
from .quality import OP7_SQL, op7_line_frequency
from .simhash import op9_simhash_trie
from .suffix import op8_suffix_arrays
from .token_count import op10_unigram_counts
from .toxicity import op13_nb_ngrams

QUERIES = {
    "op1_path_ratios": op1_path_ratios,
    "op2_cross_entropy": op2_cross_entropy,
    "op3_contextual_pii": op3_contextual_pii,
    "op4_best_fit": op4_best_fit,
    "op5_merge_automaton": op5_merge_automaton,
    "op6_product_quantisation": op6_product_quantisation,
    "op7_line_frequency": op7_line_frequency,
    "op8_suffix_arrays": op8_suffix_arrays,
    "op9_simhash_trie": op9_simhash_trie,
    "op10_unigram_counts": op10_unigram_counts,
    "op11_grammar_runs": op11_grammar_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_nb_ngrams": op13_nb_ngrams,
}

SQL = {"op7_line_frequency": OP7_SQL, "op12_filter_audit": OP12_SQL}
