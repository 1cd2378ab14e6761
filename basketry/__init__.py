"""basketry: retail data-quality, feature and recommendation jobs on Spark.

Every public operator is a function from DataFrames to a DataFrame built on
Spark SQL expressions, joins, windows and aggregates.  Nothing here holds
tables in driver memory; the only driver-side numeric work is on k×k or
l×l matrices inside the SVD fit.
"""

__version__ = "0.1.0"
