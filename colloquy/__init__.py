"""colloquy: chat-data preparation, profiling and model-evaluation analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column builder)
so it composes with ``df.transform`` and stays inside Catalyst.
"""

__version__ = "0.1.0"
