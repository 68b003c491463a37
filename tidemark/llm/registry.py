"""Queries of the operators, and their SQL where SQL can express them."""

from tidemark.llm.alignment import op12_token_alignment
from tidemark.llm.bpe import op5_byte_bpe
from tidemark.llm.conversations import op13_conversation_repair
from tidemark.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from tidemark.llm.jaccard import OP10_SQL, op10_ngram_jaccard
from tidemark.llm.language import op1_language_id
from tidemark.llm.lines import op9_fuzzy_lines
from tidemark.llm.mixing import op6_context_mixing
from tidemark.llm.packing import op4_best_fit_packing
from tidemark.llm.quality import op3_quality
from tidemark.llm.secrets import op11_secret_scan
from tidemark.llm.substrings import OP8_SQL, op8_suffix_array_dedup
from tidemark.llm.vectors import op7_embedding_near_dedup

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_context_mixing": op6_context_mixing,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_secret_scan": op11_secret_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE = {"op2_exact_dedup": OP2_SQL, "op8_suffix_array_dedup": OP8_SQL, "op10_ngram_jaccard": OP10_SQL}
