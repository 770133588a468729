"""Spark configuration for the table catalog and the object store."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
ICEBERG_CATALOG = "org.apache.iceberg.spark.SparkCatalog"
S3_FILE_IO = "org.apache.iceberg.aws.s3.S3FileIO"
S3A_FILE_SYSTEM = "org.apache.hadoop.fs.s3a.S3AFileSystem"
STATIC_KEYS = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store. Keys are looked up by variable name, never held here."""

    endpoint: str
    path_style: bool = True
    access_key_variable: str = "AWS_ACCESS_KEY_ID"
    secret_key_variable: str = "AWS_SECRET_ACCESS_KEY"

    def conf(self, environment: Mapping[str, str] = os.environ) -> dict[str, str]:
        names = (self.access_key_variable, self.secret_key_variable)
        missing = [name for name in names if not environment.get(name)]
        if missing:
            raise KeyError(f"object store keys are not set: {', '.join(missing)}")
        access_key, secret_key = (environment[name] for name in names)
        return {
            "spark.hadoop.fs.s3a.impl": S3A_FILE_SYSTEM,
            "spark.hadoop.fs.s3a.endpoint": self.endpoint,
            "spark.hadoop.fs.s3a.path.style.access": str(self.path_style).lower(),
            "spark.hadoop.fs.s3a.aws.credentials.provider": STATIC_KEYS,
            "spark.hadoop.fs.s3a.access.key": access_key,
            "spark.hadoop.fs.s3a.secret.key": secret_key,
        }


@dataclass(frozen=True)
class RestCatalog:
    """An Iceberg REST catalog, bound to Spark under `name`."""

    uri: str
    warehouse: str
    name: str = "spark_catalog"
    file_io: str = S3_FILE_IO

    def conf(self, store: ObjectStore | None = None) -> dict[str, str]:
        prefix = f"spark.sql.catalog.{self.name}"
        conf = {
            "spark.sql.extensions": ICEBERG_EXTENSIONS,
            prefix: ICEBERG_CATALOG,
            f"{prefix}.type": "rest",
            f"{prefix}.uri": self.uri,
            f"{prefix}.io-impl": self.file_io,
            f"{prefix}.warehouse": self.warehouse,
        }
        if store is not None:
            conf[f"{prefix}.s3.endpoint"] = store.endpoint
        return conf


def session_conf(
    catalog: RestCatalog | None = None,
    store: ObjectStore | None = None,
    environment: Mapping[str, str] = os.environ,
) -> dict[str, str]:
    """Every Spark setting that the given bindings need."""
    conf: dict[str, str] = {}
    if catalog is not None:
        conf.update(catalog.conf(store))
    if store is not None:
        conf.update(store.conf(environment))
    return conf
