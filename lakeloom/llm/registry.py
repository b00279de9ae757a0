"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from lakeloom.llm import collocations, impact_index, language_id, line_dedup, media, mixture, ngram_jaccard, pieces, repeats, setsketch, spotsigs, toxicity, url_filter

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_sentencepiece": pieces.query,
    "op2_toxicity": toxicity.query,
    "op3_suffix_array": repeats.query,
    "op4_source_mixture": mixture.query,
    "op5_line_dedup": line_dedup.query,
    "op6_language_id": language_id.query,
    "op7_media_column": media.query,
    "op8_url_filter": url_filter.query,
    "op9_spotsigs": spotsigs.query,
    "op10_ngram_jaccard": ngram_jaccard.query,
    "op11_collocations": collocations.query,
    "op12_impact_index": impact_index.query,
    "op13_setsketch": setsketch.query,
}

SQL = {
    "op4_source_mixture": mixture.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op8_url_filter": url_filter.SQL,
    "op10_ngram_jaccard": ngram_jaccard.SQL,
    "op11_collocations": collocations.SQL,
    "op12_impact_index": impact_index.SQL,
    "op13_setsketch": setsketch.SQL,
}
