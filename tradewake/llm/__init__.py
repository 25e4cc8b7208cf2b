"""Operators of a training-data pipeline over documents, pages, embeddings and token ids."""
