"""The queries over the driver's tables: one for each operator, over whole tables and whole texts."""

from __future__ import annotations

from cairn.llm.embed_dups import op3_embedding_dedup
from cairn.llm.jaccard import op4_ngram_jaccard
from cairn.llm.langid import op7_language_id
from cairn.llm.lines import op10_line_dedup
from cairn.llm.media import op2_media_columns
from cairn.llm.ngram_lm import op5_lm_scoring
from cairn.llm.oracles import ORACLE_SQL
from cairn.llm.packing import op1_packing
from cairn.llm.pieces import op6_sentencepiece
from cairn.llm.spans import op9_substring_dedup
from cairn.llm.url_rules import op8_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_media_columns,
        op3_embedding_dedup,
        op4_ngram_jaccard,
        op5_lm_scoring,
        op6_sentencepiece,
        op7_language_id,
        op8_url_filter,
        op9_substring_dedup,
        op10_line_dedup,
    )
}
__all__ = ["ORACLE_SQL", "QUERIES"]
