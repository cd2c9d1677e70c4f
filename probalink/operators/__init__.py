"""Operators on tables: decisions, record linkage, clustering, evaluation, identifiers."""
