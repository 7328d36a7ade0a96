"""DataFrame operators: distributed ranking and data-quality checks."""
