"""Operators for large training corpora; their registered queries are in ``quarry.llm.queries``."""
