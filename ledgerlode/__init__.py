"""ledgerlode: medallion and star-schema analytics as plain PySpark DataFrame operators.

Every operator is a function from DataFrames to a lazy DataFrame. Reading and writing happen only in
``sources`` and ``plans``; times, paths and batch ids are always arguments.
"""
