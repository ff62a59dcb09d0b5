"""Whole jobs made of operators: ingest a vintage, merge a release, curate, report."""
