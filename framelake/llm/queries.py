"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from framelake.llm import quality
from framelake.llm.fingerprints import op6_fingerprints
from framelake.llm.html_extract import op1_html_extraction
from framelake.llm.language_id import op7_language_id
from framelake.llm.mixing import op9_mixing
from framelake.llm.near_dedup import op5_near_dedup
from framelake.llm.sentencepiece_scan import op3_sentencepiece
from framelake.llm.suffix_dedup import op4_suffix_dedup
from framelake.llm.token_counts import op8_token_counts
from framelake.llm.toxicity import op10_toxicity

OPERATORS = (
    op1_html_extraction, quality.op2_quality_rules, op3_sentencepiece, op4_suffix_dedup, op5_near_dedup,
    op6_fingerprints, op7_language_id, op8_token_counts, op9_mixing, op10_toxicity,
)
QUERIES = {f.__name__: f for f in OPERATORS}
#: The others rest on hashes, trained models or tokenizers that SQL doesn't have; they are tested against brute force.
SQL: dict[str, str] = {"op2_quality_rules": quality.oracle()}
