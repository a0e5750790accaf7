"""Whole jobs: which operators run, in which order, into which sinks."""
