"""Local files vs uploaded objects (J1-J3): plan tables only, nothing is deleted.

Names match by base name.  The remote side is pre-aggregated to one row per name (with the number
of copies) before any join, so a name repeated in many folders cannot skew a join task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.operators.records import filter_object_names


def remote_names(remote_objects: DataFrame, col: str = "name") -> DataFrame:
    """P6 + aggregation: (name, remote_copies) of real objects under a folder."""
    return filter_object_names(remote_objects, col).groupBy("name").agg(F.count(F.lit(1)).alias("remote_copies"))


def reconcile_uploaded(local: DataFrame, remote_objects: DataFrame) -> DataFrame:
    """Local files that also exist remotely -> the delete plan, with the copy count as a check."""
    return local.select("name").join(remote_names(remote_objects), "name", "inner")


def reconcile_missing(local: DataFrame, remote_objects: DataFrame) -> DataFrame:
    """Remote names with no local file (the 'not found' report), with their copy count."""
    return remote_names(remote_objects).join(local.select("name"), "name", "left_anti")


def reconcile_remaining(local: DataFrame, remote_objects: DataFrame) -> DataFrame:
    """Local files not uploaded yet (what stays on disk)."""
    return local.select("name").join(remote_names(remote_objects).select("name"), "name", "left_anti")
