"""Readers for packets, calibrations, raw scans and stored results."""
