"""Analytic questions on the star schema and the end-to-end run."""
