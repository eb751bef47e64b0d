"""Training-data operators: vector search and near-dedup, token counting and
encoding, language-model scoring, source mixing, near-duplicate documents,
token files, personal data and language identification.

Every operator takes and returns DataFrames; nothing else in the library
imports this subpackage.
"""
