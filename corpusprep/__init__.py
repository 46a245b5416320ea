"""corpusprep: a Spark-native engine for preparing parallel text corpora.

Sub-packages:
  functions  column-level rule chains (text cleaning, numbers, tokens, bytes, urls)
  operators  DataFrame-level operators (dictionary, alignment, split, BLEU, scoring)
  sources    readers, writers and adapters from the driver tables
  plans      end-to-end plans and the DuckDB oracle SQL renderings
  streaming  the stateless cleaning chain on Structured Streaming
"""

__version__ = "0.1.0"
