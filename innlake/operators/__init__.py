"""Cleaning, encoding, profiling, splitting, evaluation and framing."""
