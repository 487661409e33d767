"""Whole jobs: the nightly close, the streaming layer, corpus indexing, and the check queries."""
