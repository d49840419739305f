"""Risk-signal, coverage and name-screening jobs as PySpark DataFrame transformations."""
