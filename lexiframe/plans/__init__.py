"""Composed jobs: extraction of feature tables and training runs."""
