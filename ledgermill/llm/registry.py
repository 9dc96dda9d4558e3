"""The queries of this package and their SQL."""

from __future__ import annotations

from .filter_audit import OP11_SQL, op11_filter_audit
from .packing import op3_packing
from .pieces import op8_pieces
from .pii import op1_pii
from .quality import op9_quality_rules
from .repeats import op12_repeats
from .sharding import op6_sharding
from .simhash import op5_simhash
from .token_files import op7_token_files
from .tool_calls import OP2_SQL, op2_tool_calls
from .topk import OP10_SQL, op10_topk
from .toxicity import op4_toxicity
from .turns import OP13_SQL, op13_turn_repair

QUERIES = {
    "op1_pii": op1_pii,
    "op2_tool_calls": op2_tool_calls,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_token_files": op7_token_files,
    "op8_pieces": op8_pieces,
    "op9_quality_rules": op9_quality_rules,
    "op10_topk": op10_topk,
    "op11_filter_audit": op11_filter_audit,
    "op12_repeats": op12_repeats,
    "op13_turn_repair": op13_turn_repair,
}
ORACLES: dict[str, str] = {"op2_tool_calls": OP2_SQL, "op10_topk": OP10_SQL, "op11_filter_audit": OP11_SQL, "op13_turn_repair": OP13_SQL}
