"""Operators for building training corpora: deduplication, mixing, quality, secrets,
token output, sharding, packing and scoring, as Spark jobs over a ``documents`` table.

Every operator takes DataFrames and returns DataFrames. Text statistics that SQL cannot
express run as ``mapInArrow`` over Arrow batches with numpy; Spark partitions, shuffles
and joins everything that crosses documents.
"""
