"""Streaming wrappers: newly captured pages are merged into a corpus as they arrive."""
