"""Acquisition planning over metadata tables."""
