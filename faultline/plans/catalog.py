"""All registered queries."""

from __future__ import annotations

from faultline.plans import registry
from faultline.plans import q_backend, q_carried, q_privacy, q_records, q_scans, q_sources, q_stats, q_streams, q_windows  # noqa: F401


def _with_utc(fn):
    """Read and compare times in UTC whatever the session's default zone."""

    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def queries():
    return {name: _with_utc(fn) for name, fn in registry.QUERIES.items()}


def oracle_sql():
    return dict(registry.ORACLES)
