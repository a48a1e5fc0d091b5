"""Readers: extracts, dated folders, API envelopes, catalogue and the demo lake."""
