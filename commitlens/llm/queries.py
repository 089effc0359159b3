"""Registered queries of this package and their SQL."""

from __future__ import annotations

from commitlens.llm import chat, line_dedup, vector_codes
from commitlens.llm.alignment import op11_tokenizer_alignment
from commitlens.llm.chat import op7_chat_formatting
from commitlens.llm.fingerprints import op1_document_fingerprints
from commitlens.llm.jaccard_join import op2_ngram_jaccard_join
from commitlens.llm.language_id import op13_language_id
from commitlens.llm.line_dedup import op5_line_dedup
from commitlens.llm.packing import op4_packing
from commitlens.llm.sampling import op3_sentencepiece
from commitlens.llm.search import op9_topk_search
from commitlens.llm.sharding import op6_sharding
from commitlens.llm.token_files import op8_token_files
from commitlens.llm.toxicity import op10_toxicity
from commitlens.llm.vector_codes import op12_vector_codes

LLM_QUERIES = {f.__name__: f for f in (
    op1_document_fingerprints, op2_ngram_jaccard_join, op3_sentencepiece, op4_packing, op5_line_dedup, op6_sharding,
    op7_chat_formatting, op8_token_files, op9_topk_search, op10_toxicity, op11_tokenizer_alignment, op12_vector_codes, op13_language_id)}
LLM_ORACLE = {"op5_line_dedup": line_dedup.ORACLE_SQL, "op7_chat_formatting": chat.ORACLE_SQL,
              "op12_vector_codes": vector_codes.ORACLE_SQL}
