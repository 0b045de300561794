"""settleframe: a Spark-native bronze -> silver -> gold pipeline for post-trade
settlement data.

Every public function is a ``DataFrame -> DataFrame`` transform (chain them
with ``DataFrame.transform``) or a sink that runs exactly one Spark action.
Nothing is collected to the driver except observed row counts and other
values whose size is fixed by construction.
"""

from settleframe.config import PipelineConfig
from settleframe.session import local_session, work_dir

__all__ = ["PipelineConfig", "local_session", "work_dir"]
