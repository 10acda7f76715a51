"""vigil — keyed sensor scoring on Spark.

Reads monitoring records, derives a device key, event time and measurement,
learns per device which value buckets follow which, and adds a prediction,
its error, an anomaly score and the next-step prediction to every record.
The same definitions run as window plans over tables and as keyed state in
Structured Streaming.
"""

from vigil.settings import ScoreSettings

__all__ = ["ScoreSettings"]
