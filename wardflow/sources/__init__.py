"""Readers and writers at the layer edges."""
