"""Spark-native bioactivity analytics: landing, staging, star schema, marts, serving."""

from .config import TargetSet, default_target_set
from .session import recommended_conf, scratch_dir

__all__ = ["TargetSet", "default_target_set", "recommended_conf", "scratch_dir"]
