"""pagesmith: corpus-building jobs for scholarly listing pages, written as Spark DataFrame plans.

Sub-packages
------------
functions   Column expressions (URL building, text clean-up, slugs, content types, language labels).
operators   DataFrame -> DataFrame operators (markup extraction, pagination, language id,
            fetch-attempt resolution, manifest reconciliation, record projections).
sources     Readers and writers (HTML directories, JSON batches, URL lists, manifests, stored objects).
plans       Composite jobs, fixture derivations from the test tables, and the query registry.
llm         Operators of a training-data pipeline (nothing else imports it).
"""

import sys

from pagesmith.session import get_session, shared_dir, scratch_path

__all__ = ["get_session", "shared_dir", "scratch_path"]


def _pickle_by_value() -> None:
    """Python workers may not have this package on their path (the driver can be started from
    anywhere, executors have no install): have Spark's cloudpickle ship this package's functions
    and classes by value with each task instead of importing them by name."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
