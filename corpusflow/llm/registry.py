"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from corpusflow.llm.cover_tree import OP2_SQL, op2_near_embeddings
from corpusflow.llm.filter_audit import OP12_SQL, op12_filter_audit
from corpusflow.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from corpusflow.llm.html_text import op5_html_text
from corpusflow.llm.line_dedup import OP1_SQL, op1_line_dedup
from corpusflow.llm.ngram_join import OP7_SQL, op7_ngram_jaccard
from corpusflow.llm.packing import op10_packing
from corpusflow.llm.permutation_index import op8_nearest
from corpusflow.llm.pii import op3_pii
from corpusflow.llm.quality import op4_quality

from corpusflow.llm.sentencepiece_tokens import op6_sentencepiece
from corpusflow.llm.warc import OP9_SQL, op9_warc
from corpusflow.llm.winnowing import OP13_SQL, op13_winnowing

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_embeddings": op2_near_embeddings,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_html_text": op5_html_text,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_nearest": op8_nearest,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_winnowing": op13_winnowing,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op2_near_embeddings": OP2_SQL,
    "op7_ngram_jaccard": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_winnowing": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
