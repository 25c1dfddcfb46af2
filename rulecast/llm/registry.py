"""The registered queries of this subpackage and their SQL counterparts."""

from rulecast.llm.op10_query import op10_suffix_dedup
from rulecast.llm.op11_query import OP11_SQL, op11_periodic_runs
from rulecast.llm.op12_query import OP12_SQL, op12_importance_resampling
from rulecast.llm.op13_query import op13_byte_bpe
from rulecast.llm.op1_query import op1_toxicity
from rulecast.llm.op2_query import OP2_SQL, op2_decontamination
from rulecast.llm.op3_query import op3_html_extraction
from rulecast.llm.op4_query import OP4_SQL, op4_chat_formatting
from rulecast.llm.op5_query import OP5_SQL, op5_substring_dedup
from rulecast.llm.op6_query import op6_token_files
from rulecast.llm.op7_query import op7_sentencepiece
from rulecast.llm.op8_query import op8_phrase_fingerprints
from rulecast.llm.op9_query import OP9_SQL, op9_minhash_near_dedup

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_html_extraction": op3_html_extraction,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_files": op6_token_files,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_phrase_fingerprints": op8_phrase_fingerprints,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLES = {
    "op2_decontamination": OP2_SQL,
    "op4_chat_formatting": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op9_minhash_near_dedup": OP9_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op12_importance_resampling": OP12_SQL,
}
