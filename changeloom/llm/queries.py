"""All queries of this subpackage; importing the operators registers them."""

from . import (  # noqa: F401
    op1_fingerprints,
    op2_pii,
    op3_ngram_jaccard,
    op4_decontaminate,
    op5_html_text,
    op6_toxicity,
    op7_token_counts,
    op8_substring_dedup,
    op9_mix_sources,
    op10_chat,
    op11_token_alignment,
    op12_lexical_search,
    op13_quality,
)
from .registry import ORACLES, QUERIES  # noqa: F401
