"""Training-data operators on documents and embeddings; nothing else in the library imports this package."""
