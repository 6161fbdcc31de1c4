"""S3-compatible object stores. Paths are plain URIs everywhere else."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession


def s3a_settings(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings; without keys the default credential chain applies."""
    settings = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": env.get("GRIDPULSE_S3_PATH_STYLE", "true"),
    }
    for key, name in (
        ("GRIDPULSE_S3_ENDPOINT", "endpoint"),
        ("GRIDPULSE_S3_ACCESS_KEY", "access.key"),
        ("GRIDPULSE_S3_SECRET_KEY", "secret.key"),
    ):
        if env.get(key):
            settings[f"spark.hadoop.fs.s3a.{name}"] = env[key]
    return settings


def with_object_store(
    builder: SparkSession.Builder, env: Mapping[str, str] = os.environ
) -> SparkSession.Builder:
    for key, value in s3a_settings(env).items():
        builder = builder.config(key, value)
    return builder
