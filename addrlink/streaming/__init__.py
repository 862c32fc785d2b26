"""Resumable scans, running signal counters and session buckets as streams."""
