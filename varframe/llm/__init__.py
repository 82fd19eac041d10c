"""Training-data operators: deduplication, filtering, tokenization, formatting.

Each module holds one operator (its general interface) and the thin query that
applies it to its whole table. ``registry`` collects queries and their SQL twins.
"""
