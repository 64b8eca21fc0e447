"""Queries on hourly partials give what they give on the records."""

import random
from datetime import datetime, timedelta

import pytest

from cellpulse import schema
from cellpulse.plans import alerts as al, monitoring as mo, rollup
from cellpulse.sources import tables
from cellpulse.sources.kpi_view import kpi_view
from cellpulse.streaming import jobs
from cellpulse.streaming.messages import message

T0 = datetime(2024, 3, 30, 0, 20)
NOW = {"availableNow": True}
AS_OF = T0 + timedelta(hours=50, minutes=7)


@pytest.fixture(scope="module")
def records(spark):
    """A busy cell, cells and devices without a name, unknown predictions and a two-day span."""
    rng = random.Random(11)
    rows = []
    for i in range(700):
        row = {f.name: None for f in schema.PREDICTIONS.fields}
        when = T0 + timedelta(minutes=rng.randrange(50 * 60 + 7))
        row.update(id=i, timestamp=when, ingested_at=when,
                   cell_id=rng.choice(["c1"] * 8 + ["c2", "c3", None]),
                   ue_id=rng.choice([None, "u1", "u2", "u3", "u4", f"x{i}"]),
                   slice_type=rng.choice(schema.SLICES), ml_prediction=rng.choice([0, 0, 1, None]),
                   ml_anomaly_type=rng.choice(["overload", "interference", None]),
                   actual_anomaly=rng.choice([0] * 30 + [1, None]),
                   actual_anomaly_type=rng.choice(["normal", "overload", None]),
                   one_way_latency_ms=rng.choice([None, rng.random() * 30]))
        rows.append(tuple(row[f.name] for f in schema.PREDICTIONS.fields))
    return spark.createDataFrame(rows, schema.PREDICTIONS).repartition(5).cache()


@pytest.fixture(scope="module")
def parts(records):
    """Partials of three batches, so that keys repeat."""
    made = [rollup.build(records.where(f"id % 3 = {k}")) for k in range(3)]
    return rollup.Rollup(*[a.unionByName(b).unionByName(c) for a, b, c in zip(*made)])


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda rows: sorted(map(repr, (tuple(r) for r in rows)))
    assert key(got.select(want.columns).collect()) == key(want.collect())


@pytest.mark.parametrize("hours", [1, 24, 100])
def test_scoped_queries(spark, records, parts, hours):
    cut = rollup.scope(parts, records, AS_OF, hours)
    same(rollup.network_health(cut), mo.network_health(records, AS_OF, hours))
    same(rollup.health_totals(cut), mo.health_totals(records, AS_OF, hours))
    same(rollup.timeline(cut), mo.timeline(records, AS_OF, hours))
    same(rollup.timeline_by_type(cut), mo.timeline_by_type(records, AS_OF, hours))
    rows = mo.scope_of(records, AS_OF, hours)
    same(rollup.anomaly_head(cut), mo.anomaly_head(rows))
    same(rollup.severity_ranking(cut), mo.severity_ranking(rows))
    same(rollup.type_distribution(cut), mo.type_distribution(rows))


def test_slices_status_and_merged_partials(spark, records, parts):
    limits = al.thresholds_table(spark)
    merged = rollup.merge(parts)
    assert merged.counts.count() < parts.counts.count()
    same(rollup.sla_status(merged, limits), mo.sla_status(records, limits))
    cut = rollup.scope(merged, records, AS_OF, 30, slice_type="mMTC")
    same(rollup.anomaly_head(cut), mo.anomaly_head(mo.scope_of(records, AS_OF, 30, "mMTC")))


def test_empty_scope(spark, records, parts):
    later = datetime(2030, 1, 1)
    cut = rollup.scope(parts, records, later, 24)
    same(rollup.anomaly_head(cut), mo.anomaly_head(mo.scope_of(records, later, 24)))
    same(rollup.network_health(cut), mo.network_health(records, later, 24))
    same(rollup.health_totals(cut), mo.health_totals(records, later, 24))


def test_ingest_keeps_partials_once(spark, sf, tmp_path):
    source = str(tmp_path / "messages")
    scored = kpi_view(spark, sf).select(schema.SCORED_RECORD.names)
    message(scored.repartition(2)).write.text(source)
    paths = tables.init_tables(spark, str(tmp_path / "tables"))
    for log in ("log1", "log2"):  # the repeated batch replaces its partials
        jobs.start_ingest(spark.readStream.text(source), paths, al.thresholds_table(spark),
                          str(tmp_path / log), NOW).awaitTermination()
    stored = tables.read_table(spark, paths["predictions"], schema.PREDICTIONS)
    kept = rollup.Rollup(*tables.read_rollup(spark, paths))
    same(rollup.network_health(rollup.scope(kept, stored)), mo.network_health(stored))
    assert rollup.anomaly_head(kept).first()["total"] == scored.count()
