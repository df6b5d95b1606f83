"""The queries of this package and their DuckDB twins, by name."""

from __future__ import annotations

from .chat_format import OP6_SQL, op6_chat_format
from .decontaminate import OP8_SQL, op8_decontaminate
from .exact_dedup import OP2_SQL, op2_exact_dedup
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .language_id import op12_language_id
from .ngram_lm import op4_ngram_lm
from .packing import op7_packing
from .pii import op10_pii
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .simhash import op9_simhash
from .suffix_dedup import OP5_SQL, op5_suffix_dedup
from .toxicity import op3_toxicity
from .url_filter import OP1_SQL, op1_url_filter

QUERIES = {f.__name__: f for f in (op1_url_filter, op2_exact_dedup, op3_toxicity, op4_ngram_lm, op5_suffix_dedup, op6_chat_format, op7_packing,
                                   op8_decontaminate, op9_simhash, op10_pii, op11_hard_negatives, op12_language_id, op13_prefix_trie)}
ORACLE = {"op1_url_filter": OP1_SQL, "op2_exact_dedup": OP2_SQL, "op5_suffix_dedup": OP5_SQL,
          "op6_chat_format": OP6_SQL, "op8_decontaminate": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op13_prefix_trie": OP13_SQL}
