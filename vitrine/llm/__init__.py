"""Operators of a training-data pipeline, their registered queries and the SQL that checks them."""
