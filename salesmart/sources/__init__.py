"""Scans, sinks, profile and the test-table adapter."""
