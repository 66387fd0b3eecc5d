"""Pipelines (DataFrame in, DataFrame out), one module per area of the reference."""
