"""Scaling, regression, clustering and scoring."""
