"""promoscope: shopper-log analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or an MLlib
Pipeline / PipelineModel).  Nothing is collected to the driver; all work
is planned by Catalyst and run by Spark.
"""

from promoscope.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
