"""Readers. A path that does not exist reads as an empty frame of the right type."""
