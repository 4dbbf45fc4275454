"""Operators for preparing training text at scale: search, fingerprints,
archives, mixing, toxicity, deduplication, tokenizing, token files, language.

Every operator takes DataFrames and names of columns, reads nothing else, and
returns a DataFrame.  ``queries`` registers one query per operator.
"""
