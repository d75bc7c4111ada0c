"""Queries that keep intermediate tables, on a master that is not local and a mount as shared folder."""

from __future__ import annotations

import os

import pytest

from tidings.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    return spark


@pytest.mark.parametrize("name", [
    "backfill_files", "cooc_weighted", "daily_report", "day_slice", "entity_rank", "event_mentions", "flat_day",
    "flat_files", "ingest_late_files", "quarantine_rows", "rank_values", "replaced_bytes", "stored_json",
    "stream_ingest", "typed_files"])
def test_a_mount_serves_the_query(cluster, name):
    assert QUERIES[name](cluster, SF_DIR).count() > 0
