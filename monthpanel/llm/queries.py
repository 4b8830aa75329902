"""All registered queries of this package: name -> (query, SQL or None)."""

from __future__ import annotations

from monthpanel.llm import compression, decontaminate, kneser_ney, language_id, lexical_search, line_dedup, mixing, near_duplicates, quality_rules, token_files, tokenizer_spans, url_filter, warc

ALL = {
    **quality_rules.QUERIES, **warc.QUERIES, **language_id.QUERIES, **url_filter.QUERIES, **decontaminate.QUERIES,
    **near_duplicates.QUERIES, **compression.QUERIES, **line_dedup.QUERIES, **mixing.QUERIES, **kneser_ney.QUERIES,
    **token_files.QUERIES, **tokenizer_spans.QUERIES, **lexical_search.QUERIES,
}
