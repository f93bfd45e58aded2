"""Whole jobs and the registered queries, each next to its SQL check."""
