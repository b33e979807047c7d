"""Readers and writers for catalogues, texts, feature tables, fitted models and reports."""
