"""Whole layers: operators put together, reads and writes at the ends."""
