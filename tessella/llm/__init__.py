"""Training-data operators: dedup, decontamination, classification, sanitisation, search, tokenisation.

Nothing outside this subpackage imports it.
"""
