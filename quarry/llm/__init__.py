"""Operators and queries for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Operators take and
return DataFrames; the thin queries of the driver contract are in
``queries.py`` and their SQL in ``oracles.py``.
"""
