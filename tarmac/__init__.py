"""tarmac: delay analytics on Spark.

Every operation is a ``DataFrame -> DataFrame`` function or a fit/transform pair.
Sub-packages:

* ``sources``   - CSV/Parquet readers and writers, the ``shipments`` stand-in table
* ``functions`` - column expressions (hash buckets, null masks, column kinds)
* ``operators`` - profiling, quantiles, cleaning policies, encoding, features, metrics
* ``plans``     - models, tuning, configuration sweeps, the end-to-end pipeline
* ``streaming`` - scoring a file stream with a fitted pipeline
"""

from tarmac.session import get_session, ensure_checkpoint_dir, scratch_path

__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path"]
