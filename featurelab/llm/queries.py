"""Queries of the text operators, and their SQL where SQL can express them."""

from featurelab.llm.align import op12_token_alignment
from featurelab.llm.bpe import op7_byte_bpe
from featurelab.llm.decontaminate import op5_decontamination
from featurelab.llm.hard_negatives import op13_hard_negatives
from featurelab.llm.html_extract import op4_html_extraction
from featurelab.llm.line_dedup import op6_line_dedup
from featurelab.llm.lm_score import op8_lm_scoring
from featurelab.llm.near_dup import op9_setsketch_near_dup
from featurelab.llm.piece_bpe import op11_piece_bpe
from featurelab.llm.quality import op2_quality_rules
from featurelab.llm.sharding import op1_sharding
from featurelab.llm.sql import SQL
from featurelab.llm.token_count import op3_token_counts
from featurelab.llm.url_filter import op10_url_filters

QUERIES = {
    query.__name__: query
    for query in (
        op1_sharding,
        op2_quality_rules,
        op3_token_counts,
        op4_html_extraction,
        op5_decontamination,
        op6_line_dedup,
        op7_byte_bpe,
        op8_lm_scoring,
        op9_setsketch_near_dup,
        op10_url_filters,
        op11_piece_bpe,
        op12_token_alignment,
        op13_hard_negatives,
    )
}

__all__ = ["QUERIES", "SQL"]
