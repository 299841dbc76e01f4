"""Operators for preparing large text corpora: scanning, scoring, deduplication, encoding."""
