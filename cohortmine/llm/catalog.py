"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from cohortmine.llm import oracle
from cohortmine.llm.collocations import op11_collocations
from cohortmine.llm.html_text import op5_html_extraction
from cohortmine.llm.katz import op8_lm_scoring
from cohortmine.llm.lexical_search import op12_lexical_search
from cohortmine.llm.line_dedup import op1_line_dedup
from cohortmine.llm.mil_quality import op13_quality_classifier
from cohortmine.llm.mixing import op6_mixing
from cohortmine.llm.quality_rules import op9_quality_rules
from cohortmine.llm.rp_forest import op10_embedding_dedup
from cohortmine.llm.secret_scan import op4_secret_scans
from cohortmine.llm.sentencepiece_sampling import op3_sentencepiece
from cohortmine.llm.simhash import op2_simhash
from cohortmine.llm.suffix_dedup import op7_suffix_dedup

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_secret_scans": op4_secret_scans,
    "op5_html_extraction": op5_html_extraction,
    "op6_mixing": op6_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_rules": op9_quality_rules,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_collocations": op11_collocations,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality_classifier": op13_quality_classifier,
}

ORACLE_SQL = {
    "op4_secret_scans": oracle.OP4,
    "op6_mixing": oracle.OP6,
    "op9_quality_rules": oracle.OP9,
    "op11_collocations": oracle.OP11,
    "op12_lexical_search": oracle.OP12,
}
