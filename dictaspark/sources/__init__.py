"""Readers and writers: JSON lines in four tolerances, keyed and ranked scans, manifests."""
