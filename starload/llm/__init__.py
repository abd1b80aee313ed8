"""Operators for preparing training corpora, each with a registered query."""
