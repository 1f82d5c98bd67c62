"""Whole dataflows: site specifications, extraction, incremental runs, audits, and the query catalogue."""
