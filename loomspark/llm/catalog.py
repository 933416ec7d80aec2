"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from loomspark.llm.chat_format import op3_chat_format
from loomspark.llm.language_id import op5_language_id
from loomspark.llm.media import op2_media
from loomspark.llm.minhash import op8_minhash
from loomspark.llm.mixing import op9_mixing
from loomspark.llm.oracles import oracle_sql
from loomspark.llm.pii import op6_pii
from loomspark.llm.sentencepiece_viterbi import op10_sentencepiece
from loomspark.llm.suffix_dedup import op4_suffix_dedup
from loomspark.llm.token_counts import op1_token_counts
from loomspark.llm.vector_dedup import op7_vector_dedup

__all__ = ["oracle_sql", "queries"]


def queries():
    return {
        "op1_token_counts": op1_token_counts,
        "op2_media": op2_media,
        "op3_chat_format": op3_chat_format,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_language_id": op5_language_id,
        "op6_pii": op6_pii,
        "op7_vector_dedup": op7_vector_dedup,
        "op8_minhash": op8_minhash,
        "op9_mixing": op9_mixing,
        "op10_sentencepiece": op10_sentencepiece,
    }

