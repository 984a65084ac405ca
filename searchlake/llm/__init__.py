"""Training-data operators: dedup, filters, classification, search, tokenisation, mixing, packing.

Each module holds one operator with its general interface; ``queries`` registers the thin
``opN_<name>`` queries over the given tables. Nothing else in the library imports this package.
"""
