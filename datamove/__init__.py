"""Metadata-driven data integration as Spark DataFrame operators.

``sources`` read tables and files, ``functions`` reshape columns, ``operators``
compare, merge, profile and look up, ``sinks`` write and publish, ``streaming``
ingests files exactly once and ``plans`` composes them into jobs.
"""
