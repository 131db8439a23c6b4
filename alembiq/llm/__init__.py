"""Training-data operators: language id, deduplication, secrets, HTML, tokens, LM scores.

Nothing outside this subpackage imports it, so it can be deleted as a whole.
"""
