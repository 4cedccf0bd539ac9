"""Operators for building training data out of documents, pages, vectors and benchmarks.

Each module holds one operator; ``queries`` registers them.  Python tasks work on Arrow batches with numpy, so
the executors need this package on their path (``--py-files`` or an installed copy), as for any Python UDF.
"""
