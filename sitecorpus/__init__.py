"""Spark-native web-corpus engine.

Every public function takes and returns DataFrames (or Columns for the scalar helpers in
``sitecorpus.functions``) and runs distributed; nothing calls the network.
"""

__version__ = "0.1.0"
