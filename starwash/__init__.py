"""starwash: clean messy registration records into a star schema, on Spark.

Layout:
  functions/   column expressions and the fixed rule lists
  operators/   DataFrame -> DataFrame operators (clean, dedupe, keys, dims,
               resolve, fact, quality)
  sources/     readers and sinks
  plans/       the end-to-end pipeline and the test fixture view
  streaming/   the same pipeline driven by a file stream, one micro-batch per file
"""

__version__ = "0.1.0"
