"""Operators over tables of documents, blocks, lines and spans."""
