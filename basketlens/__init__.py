"""basketlens: panel-based purchase analytics on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
native Spark expressions; several clients are computed in one pass with
``client`` as an ordinary key.
"""

__version__ = "0.1.0"
