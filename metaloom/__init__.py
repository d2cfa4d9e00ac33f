"""metaloom: metadata-catalogue analytics as Spark DataFrames.

Layout
------
``functions``  Column -> Column building blocks (text, URIs, typed literals, quality rules)
``sources``    readers and writers, the versioned Parquet store
``operators``  DataFrame -> DataFrame operators
``plans``      whole jobs: building a catalogue, searching it, the registered queries
``streaming``  continuous upserts
"""
