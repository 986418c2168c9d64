"""tonearm — implicit-feedback recommendation analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames; nothing is collected to
the driver except bounded scalars (a row count, one query vector, a size-checked
factor chunk).
"""

from tonearm.config import Config
from tonearm.session import checkpoint_dir, local_session, scratch_path

__all__ = ["Config", "checkpoint_dir", "local_session", "scratch_path"]
