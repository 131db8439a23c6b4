"""Operators of the five phases and the coherence report."""
