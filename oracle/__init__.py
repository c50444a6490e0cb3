"""DuckDB SQL used only as an independent oracle for the Spark queries.

The SQL texts here are written separately from the engine (which is DataFrame code); they
share nothing with it except the data-mapping rules, so agreement is a real check.
"""
