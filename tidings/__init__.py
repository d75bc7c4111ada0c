"""Mention analytics for large collections of news-style records, on Spark.

Every operator takes DataFrames and returns DataFrames. The packages:

* ``functions``  column expressions (items, names, file names, SQL functions)
* ``operators``  DataFrame operators (co-occurrence, mentions, ranking, files ...)
* ``sources``    archives, typed datasets, result sinks
* ``streaming``  continuous ingest of landed archives
* ``plans``      the daily job, and the queries over the test tables
"""
