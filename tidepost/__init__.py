"""Spark-native analytics over short social texts.

Every operator takes a DataFrame and returns a DataFrame; the caller owns the session.
"""
