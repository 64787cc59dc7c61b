"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tablewarden.llm import dualtree, filter_audit
from tablewarden.llm.bytebpe import op12_byte_level_bpe
from tablewarden.llm.chunk_dedup import op3_substring_dedup
from tablewarden.llm.decontamination import op9_benchmark_decontamination
from tablewarden.llm.dualtree import op13_ranked_lexical_search
from tablewarden.llm.filter_audit import op11_filter_interaction_audit
from tablewarden.llm.jaccard import op6_ngram_jaccard_join
from tablewarden.llm.licences import op4_license_scans
from tablewarden.llm.packing import op5_packing
from tablewarden.llm.pii import op10_pii
from tablewarden.llm.quality import op8_quality_rules
from tablewarden.llm.substring import op7_suffix_array_dedup
from tablewarden.llm.toxicity import op2_toxicity
from tablewarden.llm.url_filters import op1_url_filters

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scans": op4_license_scans,
    "op5_packing": op5_packing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_pii": op10_pii,
    "op11_filter_interaction_audit": op11_filter_interaction_audit,
    "op12_byte_level_bpe": op12_byte_level_bpe,
    "op13_ranked_lexical_search": op13_ranked_lexical_search,
}

ORACLES: dict[str, str] = {
    "op11_filter_interaction_audit": filter_audit.ORACLE,
    "op13_ranked_lexical_search": dualtree.ORACLE,
}
