"""The registered queries of this package, opN_<name>, and their DuckDB statements."""

from __future__ import annotations

from .alignment import op13_alignment
from .bpe import op6_bpe
from .chat import OP1_SQL, op1_chat
from .htmltext import op8_html
from .minhash import op2_minhash
from .mixing import OP9_SQL, op9_mixing
from .quality_classifier import op5_quality
from .quality_rules import op4_rules
from .secrets import op10_secrets
from .simhash import op7_simhash
from .topk import OP11_SQL, op11_topk
from .toxicity import op3_toxicity
from .whitening import op12_whitening

QUERIES = {
    "op1_chat": op1_chat,
    "op2_minhash": op2_minhash,
    "op3_toxicity": op3_toxicity,
    "op4_rules": op4_rules,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_html": op8_html,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_topk": op11_topk,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op1_chat": OP1_SQL,
    "op9_mixing": OP9_SQL,
    "op11_topk": OP11_SQL,
}
