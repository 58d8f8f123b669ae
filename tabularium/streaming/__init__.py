"""Ordered state: stitching pages as they arrive."""
