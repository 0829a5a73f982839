"""Data-quality checks, cleaning, star-schema builders, loading and audit."""
