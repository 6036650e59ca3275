"""Firewall log analytics written as Spark DataFrame operations.

``sources``    read log text, CSV dimensions and block lists
``functions``  column expressions (no Python UDFs)
``operators``  DataFrame -> DataFrame steps: parse, detect, enrich, describe
``plans``      the load from text to tables, and the dashboard queries
``sinks``      Parquet, CSV, JDBC and bucketed tables
"""
