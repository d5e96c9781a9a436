"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from chaintally.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from chaintally.llm.decontaminate import op6_decontaminate
from chaintally.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from chaintally.llm.html_extract import op4_html_extract
from chaintally.llm.language_id import op2_language_id
from chaintally.llm.mixing import OP1_SQL, op1_mix_sources
from chaintally.llm.secrets import op10_secrets
from chaintally.llm.simhash_dedup import op8_simhash_dedup
from chaintally.llm.spot_signatures import op11_spot_signatures
from chaintally.llm.suffix_tree_lm import op9_suffix_tree_lm
from chaintally.llm.topk_search import OP5_SQL, op5_topk_search
from chaintally.llm.toxicity import op3_toxicity
from chaintally.llm.warc_fixity import OP7_SQL, op7_warc_fixity

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_id": op2_language_id,
    "op3_toxicity": op3_toxicity,
    "op4_html_extract": op4_html_extract,
    "op5_topk_search": op5_topk_search,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_suffix_tree_lm": op9_suffix_tree_lm,
    "op10_secrets": op10_secrets,
    "op11_spot_signatures": op11_spot_signatures,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": OP1_SQL,
    "op5_topk_search": OP5_SQL,
    "op7_warc_fixity": OP7_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
