"""The registered queries of this package and the SQL that some of them must agree with."""

from __future__ import annotations

from homelake.llm import decontamination, lexical, licenses, merkle, near_dedup, top_k
from homelake.llm.bpe import op13_bpe
from homelake.llm.decontamination import op1_decontamination
from homelake.llm.html_text import op2_html_text
from homelake.llm.language import op4_language
from homelake.llm.lexical import op12_lexical
from homelake.llm.licenses import op6_licenses
from homelake.llm.merkle import op11_merkle
from homelake.llm.mixing import op8_mixing
from homelake.llm.near_dedup import op9_near_dedup
from homelake.llm.pii import op7_pii
from homelake.llm.secrets import op10_secrets
from homelake.llm.top_k import op3_top_k
from homelake.llm.toxicity import op5_toxicity

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html_text": op2_html_text,
    "op3_top_k": op3_top_k,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_mixing": op8_mixing,
    "op9_near_dedup": op9_near_dedup,
    "op10_secrets": op10_secrets,
    "op11_merkle": op11_merkle,
    "op12_lexical": op12_lexical,
    "op13_bpe": op13_bpe,
}

ORACLE_SQL = {
    "op1_decontamination": decontamination.ORACLE,
    "op3_top_k": top_k.ORACLE,
    "op6_licenses": licenses.oracle(),
    "op9_near_dedup": near_dedup.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op12_lexical": lexical.ORACLE,
}
