"""Operators that prepare text and embedding corpora for language-model training."""
