"""Operators for training-data pipelines: filters, near-duplicates, extraction, tokens, packing and chat records.

Each module holds one operator with its own interface; ``queries`` applies them to the given tables. Nothing else in the
package imports this one.
"""
