"""Operators of a training-data pipeline: documents in, decisions, rewritten texts or token ids out."""
