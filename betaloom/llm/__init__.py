"""Operators of a training-data pipeline over tables of documents, embeddings and token files."""
