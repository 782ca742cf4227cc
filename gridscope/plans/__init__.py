"""Whole jobs: read tables, run operators, write tables. A rerun replaces its own output."""
