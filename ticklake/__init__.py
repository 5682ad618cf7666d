"""ticklake: a Spark-native market-data analytics library.

Raw exchange frames -> envelopes (Bronze) -> typed Silver tables ->
event-time windowed Gold risk metrics -> keyed serving tables.  Every
transform is a pure ``DataFrame -> DataFrame`` function that runs the same
in batch and in Structured Streaming and uses only built-in Spark
expressions.
"""

__version__ = "0.1.0"
