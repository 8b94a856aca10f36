"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from strata.llm import (ann, fill_in_middle, hard_negatives, html_extract, language_id, line_dedup, minhash, ngram_join, packing, pii,
                        quality_rules, sentencepiece_nbest, suffix_dedup)

MODULES = (ann, suffix_dedup, sentencepiece_nbest, packing, language_id, minhash, quality_rules, pii, html_extract, line_dedup,
           fill_in_middle, ngram_join, hard_negatives)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
