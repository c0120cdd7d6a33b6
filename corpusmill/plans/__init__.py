"""Whole plans (filter, generate, statistics, analysis) and the registered queries."""
