"""Kerbside: batch and streaming analytics over fixed-interval road-sensor counts."""
