"""Queries of this subpackage: name -> callable, and the SQL where it can express them."""

from mesura.llm import chat_format, html_extract, language_id, lm_score, near_dedup, packing, prefix_trie, quality, sentence_pieces, topk, toxicity, url_filter, whitening  # noqa: F401
from mesura.llm.common import ORACLE, QUERIES  # noqa: F401
