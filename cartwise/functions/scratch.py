"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from cartwise.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"
