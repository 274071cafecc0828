"""Indexing and retrieval are requests with an answer; no operator of this engine is a stream, so nothing lives here."""
