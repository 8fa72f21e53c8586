"""Operators for preparing training text: language, packing, quality, licences, deduplication and more.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries over the benchmark tables.  Nothing else
in the library imports this package.
"""
