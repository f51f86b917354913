"""Résumé privacy and matching on PySpark.

Everything is a function from Column to Column or from DataFrame to DataFrame;
nothing runs until the caller asks for an action, except where a docstring says so.
"""
