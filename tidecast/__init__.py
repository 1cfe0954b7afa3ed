"""tidecast: daily time-series preparation, modelling and explanation on Spark.

Every public operator takes and returns Spark DataFrames and is keyed by a
``by`` list (normally ``["symbol"]``) so that many series run side by side.
"""

from tidecast.session import get_spark, ensure_checkpoint_dir, shared_path  # noqa: F401

__version__ = "0.1.0"
