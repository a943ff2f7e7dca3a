"""docweave: corpus enrichment operators on Spark DataFrames.

Every public function takes and returns lazy DataFrames (or Columns); nothing
triggers an action unless its name says so (``write_*``, ``count_rows``).
"""

from docweave.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
