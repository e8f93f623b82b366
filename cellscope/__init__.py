"""cellscope: measurement analytics on Spark DataFrames.

Sources (``sources``), column functions (``functions``), DataFrame operators
(``operators``), end-to-end plans (``plans``) and the incremental form of the
area-hour job (``streaming``). Every operator takes and returns a DataFrame and
is built from built-in Spark expressions.
"""

__version__ = "0.1.0"
