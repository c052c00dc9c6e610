"""Operators for large training-data pipelines, one module per operator.

Every operator takes a DataFrame, names its columns by parameter, keeps its
own column names out of the way of the caller's and returns a DataFrame.
``queries.py`` holds the registered ``opN_<name>`` queries, ``sql.py`` their
DuckDB text. Nothing else in the library imports this package.
"""
