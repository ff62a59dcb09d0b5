"""Merging releases as their notifications arrive."""
