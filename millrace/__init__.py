"""millrace: DataFrame-to-DataFrame analytics operators and ML building blocks on Spark.

Every operator takes and returns lazy DataFrames keyed by real columns. Only fitted
parameters of bounded size (quantiles, bin edges, centres, coefficients) reach the driver.
"""
