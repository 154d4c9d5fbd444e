"""Operators of a training-data pipeline: packing, chat views, languages, licenses, quality, tokens, URLs, copies."""
