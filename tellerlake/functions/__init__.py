"""Scalar expressions as SQL text.

Each function takes SQL expressions and returns one, so that wide projections are assembled as text
and handed to Spark in a single call.
"""
