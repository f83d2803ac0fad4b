"""Session settings for an object store; the caller applies them when building the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool = True,
) -> dict[str, str]:
    """S3A options; keys are left out unless given, so that instance credentials keep working."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def session(app_name: str, conf: dict[str, str] | None = None, hive: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return (builder.enableHiveSupport() if hive else builder).getOrCreate()
