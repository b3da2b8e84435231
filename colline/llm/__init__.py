"""Operators of a training-data pipeline (see the modules; queries are in ``queries.py``)."""
