"""Operators of a training-data pipeline: scans, classifiers, dedup, search,
mixing, packing and token output.

Nothing else in the library imports this package.  Each module holds one
operator with its own interface; :mod:`cofreq.llm.queries` holds the queries
that apply them to the driver's tables.
"""
