"""tidewater: keyed streaming and batch analytics written with Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, window specs, joins and aggregations, so Catalyst plans it and the
same code serves a batch read and, where Spark allows, a streaming read.
"""

__version__ = "0.1.0"
