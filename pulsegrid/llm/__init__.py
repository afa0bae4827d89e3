"""Operators for preparing text corpora: near-duplicates, personal data, quality, search, extraction,
fingerprints, language-model scores, tokens, token files and source mixing.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
