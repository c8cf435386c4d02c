"""lectern: Spark-native text-corpus analytics.

Articles go through cleaning, overlapping chunking, vector encoding and
pooling, topic assignment, tone scoring and keyed upserts into a small
serving star; quote search, listings and topic views read from it.
Every operator takes and returns DataFrames and leaves planning to Catalyst.
"""

__version__ = "0.1.0"
