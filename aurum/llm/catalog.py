"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from functools import wraps

import corpus_pipeline

from .bpe import op6_bpe
from .chat import OP3_SQL, op3_chat
from .common import ship
from .embedding_dedup import OP9_SQL, op9_embedding_dedup
from .exact_dedup import OP8_SQL, op8_exact_dedup
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .html_extract import op5_html_extract
from .lm_score import op10_lm_score
from .ngram_join import OP4_SQL, op4_ngram_join
from .packing import op1_packing
from .pii import op7_pii
from .ranked_search import OP13_SQL, op13_ranked_search
from .toxicity import op2_toxicity
from .url_filter import OP12_SQL, op12_url_filter


def _with_package(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {name: _with_package(query) for name, query in {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_chat": op3_chat,
    "op4_ngram_join": op4_ngram_join,
    "op5_html_extract": op5_html_extract,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_lm_score": op10_lm_score,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_url_filter": op12_url_filter,
    "op13_ranked_search": op13_ranked_search,
    "pipeline": corpus_pipeline.run,
}.items()}

ORACLE = {
    "op3_chat": OP3_SQL,
    "op4_ngram_join": OP4_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_url_filter": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
