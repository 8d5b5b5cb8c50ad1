"""Operators of a training-data pipeline over a ``documents`` table (doc_id, text, lang, source, n_chars)."""
