from __future__ import annotations

import pytest

from eventlake.settings import ObjectStore, RestCatalog, session_conf

KEYS = {"AWS_ACCESS_KEY_ID": "reader", "AWS_SECRET_ACCESS_KEY": "hidden"}
STORE = ObjectStore("http://store:9000")
CATALOG = RestCatalog("http://catalog:8181", "s3a://lake/", name="lake")


def test_catalog_and_store_settings():
    conf = session_conf(CATALOG, STORE, KEYS)
    assert conf == {
        "spark.sql.extensions": (
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
        ),
        "spark.sql.catalog.lake": "org.apache.iceberg.spark.SparkCatalog",
        "spark.sql.catalog.lake.type": "rest",
        "spark.sql.catalog.lake.uri": "http://catalog:8181",
        "spark.sql.catalog.lake.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        "spark.sql.catalog.lake.warehouse": "s3a://lake/",
        "spark.sql.catalog.lake.s3.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.aws.credentials.provider": (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        ),
        "spark.hadoop.fs.s3a.access.key": "reader",
        "spark.hadoop.fs.s3a.secret.key": "hidden",
    }


@pytest.mark.parametrize("name", KEYS)
def test_a_missing_key_is_named_and_no_other_is_shown(name):
    environment = {other: value for other, value in KEYS.items() if other != name}
    with pytest.raises(KeyError, match=name) as failure:
        session_conf(store=STORE, environment=environment)
    assert not any(value in str(failure.value) for value in environment.values())


def test_keys_are_not_held_by_the_settings():
    assert "hidden" not in repr(STORE) + repr(CATALOG)


def test_no_bindings_need_no_settings():
    assert session_conf() == {}


def test_catalog_without_store_needs_no_keys():
    assert not any("s3a" in key or "s3.endpoint" in key for key in session_conf(CATALOG))
