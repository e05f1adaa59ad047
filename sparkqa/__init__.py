"""sparkqa: question-answering retrieval and its data preparation as Spark jobs.

Main entry points (all take and return DataFrames):

- index build: ``build_bm25_index``, ``build_tfidf_index``
- ranking: ``bm25_topk``, ``tfidf_topk``, ``normalize_doc_ids``
- evaluation: ``match_string``, ``match_regex``, ``match_kilt``, ``hit_at_k``, ``validate``
- file-to-file steps: ``sparkqa.plans.workflows`` (retrieve, evaluate, tables_to_training,
  prepare_reader)
"""

__version__ = "0.1.0"

from sparkqa.operators.evaluate import hit_at_k, match_kilt, match_regex, match_string, validate  # noqa: E402
from sparkqa.operators.index import build_bm25_index, build_tfidf_index  # noqa: E402
from sparkqa.operators.retrieve import bm25_topk, normalize_doc_ids, tfidf_topk  # noqa: E402

__all__ = ["build_bm25_index", "build_tfidf_index", "bm25_topk", "tfidf_topk", "normalize_doc_ids",
           "match_string", "match_regex", "match_kilt", "hit_at_k", "validate"]
