"""The queries of the operators, by name."""

from __future__ import annotations

from salesengine.llm.codes import op13_vector_codes
from salesengine.llm.decontaminate import op3_decontaminate
from salesengine.llm.embeddings import op5_embedding_dedup
from salesengine.llm.html_text import op4_html_text
from salesengine.llm.licenses import op9_licenses
from salesengine.llm.minhash import op1_minhash_dedup
from salesengine.llm.mixing import op12_mixing
from salesengine.llm.oracles import oracle_sql
from salesengine.llm.packing import op8_packing
from salesengine.llm.pii import op6_pii
from salesengine.llm.quality import op10_quality
from salesengine.llm.resampling import op11_resampling
from salesengine.llm.urls import op7_url_filter
from salesengine.llm.warc import op2_warc

__all__ = ["oracle_sql", "queries"]


def queries() -> dict:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_warc": op2_warc,
        "op3_decontaminate": op3_decontaminate,
        "op4_html_text": op4_html_text,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_pii": op6_pii,
        "op7_url_filter": op7_url_filter,
        "op8_packing": op8_packing,
        "op9_licenses": op9_licenses,
        "op10_quality": op10_quality,
        "op11_resampling": op11_resampling,
        "op12_mixing": op12_mixing,
        "op13_vector_codes": op13_vector_codes,
    }
