"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from corpusengine.llm.bpe import op4_bpe
from corpusengine.llm.embeddings import op10_embeddings
from corpusengine.llm.katz import op2_katz
from corpusengine.llm.packing import op6_packing
from corpusengine.llm.quality import op3_quality_classifier
from corpusengine.llm.rollup import OP8_SQL, op8_token_counts
from corpusengine.llm.rules import op5_quality_rules
from corpusengine.llm.secrets import op7_secrets
from corpusengine.llm.simhash import op1_simhash
from corpusengine.llm.toxicity import op9_toxicity

QUERIES = {f.__name__: f for f in (op1_simhash, op2_katz, op3_quality_classifier, op4_bpe, op5_quality_rules, op6_packing, op7_secrets, op8_token_counts, op9_toxicity, op10_embeddings)}
SQL = {"op8_token_counts": OP8_SQL}
