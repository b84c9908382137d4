"""Queries of the operators of this subpackage over the whole driver tables."""

from printfold.llm.query_chat import SQL_CHAT, op10_chat_formatting
from printfold.llm.query_collocations import SQL_COLLOCATIONS, op13_collocations
from printfold.llm.query_decontaminate import SQL_DECONTAMINATION, op9_decontamination
from printfold.llm.query_fingerprints import op3_fingerprints
from printfold.llm.query_jaccard import SQL_JACCARD, op7_jaccard_join
from printfold.llm.query_language import op2_language_id
from printfold.llm.query_lm import SQL_LM, op8_lm_scoring
from printfold.llm.query_mixing import SQL_MIXING, op4_mixing
from printfold.llm.query_negatives import SQL_NEGATIVES, op12_hard_negatives
from printfold.llm.query_pii import op5_pii
from printfold.llm.query_substrings import SQL_SUBSTRINGS, op1_substring_dedup
from printfold.llm.query_superminhash import SQL_MINHASH, op11_minhash_dedup
from printfold.llm.query_urls import op6_url_filter

QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_language_id, op3_fingerprints, op4_mixing, op5_pii, op6_url_filter, op7_jaccard_join,
    op8_lm_scoring, op9_decontamination, op10_chat_formatting, op11_minhash_dedup,
    op12_hard_negatives, op13_collocations)}
SQL = {
    "op1_substring_dedup": SQL_SUBSTRINGS,
    "op4_mixing": SQL_MIXING, "op7_jaccard_join": SQL_JACCARD, "op8_lm_scoring": SQL_LM,
    "op9_decontamination": SQL_DECONTAMINATION, "op10_chat_formatting": SQL_CHAT,
    "op11_minhash_dedup": SQL_MINHASH, "op12_hard_negatives": SQL_NEGATIVES,
    "op13_collocations": SQL_COLLOCATIONS,
}
