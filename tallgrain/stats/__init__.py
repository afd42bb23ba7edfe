"""Hypothesis tests, correlations and effect sizes, one row per group."""
