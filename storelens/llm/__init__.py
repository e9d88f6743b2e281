"""Operators for training-data pipelines: text, web archives, embeddings, language models."""
