"""Operators of a large training-data pipeline.

Nothing else in the library imports this subpackage; it may use the library's
general helpers (``tidepool.session``).  Each module holds one operator with its
own general interface; ``queries.py`` registers one query per operator.
"""
