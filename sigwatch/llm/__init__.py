"""Training-data operators (quality, privacy, deduplication, tokens, archives).

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it."""
