"""Readers and writers for keyword lists, seed forums, pages, work lists and results."""
