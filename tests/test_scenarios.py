"""Whole flows on small data: policies, edge cases, linked kinds, public rides."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.text import station_key, whole_seconds
from entityframe.operators import linked

NOW = datetime(2026, 5, 1, 12, tzinfo=timezone.utc)
TEXT, WHOLE, TIME, KEY = ef.StringType(), ef.Int64Type(), ef.TimestampType(), ef.KeyType()


def test_loans_of_a_library(store, frame):
    """Guards, stamps, a partial change and a cleanup, all below one branch of a town's library."""
    loan = ef.Schema(
        "Loan",
        {
            "card": ef.Field(TEXT, nullable=False),
            "shelf": ef.Field(TEXT),
            "days": ef.Field(WHOLE, nullable=False),
            "opened": ef.Field(TIME),
            "touched": ef.Field(TIME),
        },
        key=ef.key_policy("Loan", id_field="slip", namespace_field="town", ancestors=[("Branch", "branch")]),
    )
    branch = ef.EntityKey((("Branch", "north"),), namespace="ulm")
    desk = ef.kind(schema=loan, store=store, ancestor=branch)
    stamped = desk.with_scope(audit=ef.AuditPolicy(created_at="opened", modified_at="touched", now=lambda: NOW))
    slips = frame(
        [("ulm", "north", 101, "c1", "A", 14), ("ulm", "north", 102, "c2", "A", 28), ("ulm", "north", 103, "c3", None, 7), ("ulm", "north", 104, "c3", "B", 21)],
        "town string, branch string, slip long, card string, shelf string, days int",
    )
    assert stamped.write(slips, dry_run=True).planned_writes == 4
    assert stamped.write(slips, read_only=True).failed == 4
    assert desk.count() == 0
    assert stamped.write(slips).wrote == 4
    assert stamped.write(slips, skip_unchanged=True).skipped == 4
    with pytest.raises(ef.SchemaError):
        stamped.write(slips.withColumn("branch", F.lit("south")))

    longer = slips.filter("slip < 103").withColumn("days", F.when(F.col("slip") == 101, 14).otherwise(56))
    extended = desk.patch(longer, properties=["days"], skip_unchanged=True)
    assert (extended.skipped, extended.wrote) == (1, 1)

    # One slip per card: the longest loan stays.
    looked_at = desk.cleanup_duplicates(by=["card"], order=["-days"])
    assert (looked_at.planned_writes, looked_at.wrote) == (1, 0)
    assert desk.cleanup_duplicates(by=["card"], order=["-days"], dry_run=False).wrote == 1
    assert {r.days for r in desk.read().collect()} == {14, 56, 21}
    assert {r.opened.year for r in desk.read().collect()} == {NOW.year}


def test_readings_of_meters(store, frame):
    """Unchanged rows, a summary as a kind of its own, duplicates and a row that lacks a field."""
    fields = {"street": ef.Field(TEXT, nullable=False), "meter": ef.Field(TEXT, nullable=False), "litres": ef.Field(WHOLE, nullable=False), "source": ef.Field(TEXT)}
    reading = ef.Schema("Reading", fields, key=ef.key_policy("Reading", id_field="serial", ancestors=[("Street", "street"), ("Meter", "meter")]), strict=False)
    per_street = ef.Schema("Usage", {"street": fields["street"], "litres_sum": ef.Field(WHOLE), "litres_max": ef.Field(WHOLE)}, key=ef.key_policy("Usage", id_field="street"))
    ddl = "street string, meter string, serial long, litres int, source string"
    rows = frame([("oak", "m1", 1, 40, "app"), ("oak", "m2", 2, 60, "post"), ("elm", "m3", 3, 5, "app"), ("elm", "m3", 4, 5, "app")], ddl)
    readings = ef.kind(schema=reading, store=store)
    assert readings.write(rows).wrote == 4
    assert readings.write(rows, skip_unchanged=True).skipped == 4
    corrected = rows.withColumn("litres", F.when(F.col("serial") == 2, 61).otherwise(F.col("litres")))
    report = readings.write(corrected, skip_unchanged=True)
    assert (report.wrote, report.skipped) == (1, 3)
    assert readings.patch(corrected.filter("serial = 1"), properties=["litres"], skip_unchanged=True).skipped == 1

    loaded = ef.entity_model(store=store, schema=reading).load()
    assert loaded.aggregate(by=["street"], metrics={"litres": "sum"}, target_schema=per_street).write().wrote == 2
    peaks = loaded.aggregate(by=["street"], metrics={"litres": "max"}, target_schema=per_street)
    assert peaks.patch(properties=["litres_max"]).wrote == 2
    used = {r.street: (r.litres_sum, r.litres_max) for r in ef.read_entities(store, "Usage", schema=per_street).collect()}
    assert used == {"oak": (101, 61), "elm": (10, 5)}
    assert readings.cleanup_duplicates(by=["meter", "litres"], dry_run=False).wrote == 1
    assert readings.count() == 3
    unread = frame([("oak", "m1", 9, None, "app")], ddl)
    assert readings.write(unread).failures().first().error == "missing required fields: litres"


def test_linked_flow(spark, store):
    users, sessions, events = 20, 60, 600
    in_tenant = {"namespace": "linked"}

    def name(prefix, number):
        return F.format_string(prefix + "-%05d", number)

    def user_key(df_column):
        return ef.KeySpec([("Tenant", ef.KeyPart(constant="t1")), ("LinkedUser", ef.KeyPart(df_column))], **in_tenant)

    def with_key(df, name_, spec):
        return df.withColumn(name_, spec.build({f.name: f.dataType for f in df.schema.fields}).value)

    tenant = [("Tenant", ef.KeyPart(constant="t1"))]
    user = ef.Schema("LinkedUser", {"user_id": ef.Field(TEXT, nullable=False)}, key=ef.key_policy("LinkedUser", id_field="user_id", ancestors=tenant, **in_tenant))
    session = ef.Schema(
        "LinkedSession",
        {"session_id": ef.Field(TEXT, nullable=False), "user_key": ef.Field(KEY, nullable=False)},
        key=ef.key_policy("LinkedSession", id_field="session_id", ancestors=[*tenant, ("LinkedUser", "user_id")], **in_tenant),
        strict=False,
    )
    event = ef.Schema(
        "LinkedEvent",
        {
            "event_id": ef.Field(TEXT, nullable=False),
            "user_key": ef.Field(KEY, nullable=False, indexed=False),
            "session_key": ef.Field(KEY, nullable=False),
            "tags": ef.Field(ef.ArrayType(TEXT), indexed=False),
            "attributes": ef.Field(ef.EmbeddedEntityType(), indexed=False),
            "error_code": ef.Field(TEXT, indexed=False),
        },
        key=ef.key_policy(
            "LinkedEvent", id_field="event_id", ancestors=[*tenant, ("LinkedUser", "user_id"), ("LinkedSession", "session_id")], **in_tenant
        ),
        strict=False,
    )
    session_spec = ef.KeySpec([*tenant, ("LinkedUser", ef.KeyPart("user_id")), ("LinkedSession", ef.KeyPart("session_id"))], **in_tenant)

    user_rows = spark.range(users).select(name("user", F.col("id")).alias("user_id"))
    session_rows = with_key(
        spark.range(sessions).select(name("session", F.col("id")).alias("session_id"), name("user", F.col("id") % users).alias("user_id")),
        "user_key", user_key("user_id"),
    )
    at = F.col("id") % sessions
    event_rows = spark.range(events).select(
        name("event", F.col("id")).alias("event_id"), name("session", at).alias("session_id"), name("user", at % users).alias("user_id"),
        F.array(F.lit("a"), F.lit("b")).alias("tags"), F.struct(F.col("id").alias("n")).alias("attributes"),
        F.when(F.col("id") % 10 == 0, F.lit("E")).alias("error_code"),
    )
    event_rows = with_key(with_key(event_rows, "user_key", user_key("user_id")), "session_key", session_spec)
    for rows, schema in ((user_rows, user), (session_rows, session), (event_rows, event)):
        report = ef.write_entities(store, rows, schema)
        report.raise_for_errors()

    target = ef.EntityKey((("Tenant", "t1"), ("LinkedUser", "user-00007"), ("LinkedSession", "session-00007")), namespace="linked")
    below = ef.read_entities(store, "LinkedEvent", schema=event, ancestor=target, include_key=True)
    by_property = ef.read_entities(store, "LinkedEvent", schema=event, namespace="linked", filters=[("session_key", "=", target)])
    assert below.count() == by_property.count() == events // sessions
    assert ef.read_entities(store, "LinkedEvent", schema=event, ancestor=target, limit=5).count() == 5
    raw = ef.scan(store, ef.QuerySpec("LinkedEvent"))
    raw_users = ef.scan(store, ef.QuerySpec("LinkedUser"))
    assert linked.dangling_references(raw, "user_key", raw_users).count() == 0
    assert linked.outside_ancestor_property(raw, "session_key").count() == 0
    assert linked.descendants(raw, raw_users, 2).count() == events
    held = {r.property: r.entities for r in linked.presence_counts(raw).collect()}
    assert held["error_code"] == events // 10 and held["tags"] == events


def test_rides_flow(store, frame):
    ddl = "ride_id string, started_at string, ended_at string, station_id string, station string, lat double"
    rides = frame(
        [
            ("r1", "2026-01-01 00:00:00", "2026-01-01 00:10:00", None, "Clark St & Elm", 1.0),
            ("r2", "2026-01-01 00:00:00", "2026-01-01 00:05:30", " ", "Clark St & Elm", 3.0),
            ("r3", "2026-01-01 00:00:00", "2026-01-01 00:01:00", "S9", "Lake", None),
            ("r4", "2026-01-01 00:01:00", "2026-01-01 00:00:00", "S9", "Lake", 1.0),
            ("r5", "bad", "2026-01-01 00:00:00", "S9", "Lake", 1.0),
            ("r6", "2026-01-01 00:00:00", "2026-01-01 00:01:00", "S9", None, 1.0),
        ],
        ddl,
    )
    timed = rides.withColumns(
        {
            "started_at": F.try_to_timestamp("started_at"),
            "ended_at": F.try_to_timestamp("ended_at"),
            "station_key": station_key(F.col("station_id"), F.col("station")),
        }
    )
    timed = timed.withColumn("duration_sec", whole_seconds(F.col("started_at"), F.col("ended_at")))
    good = linked.clean_rows(timed, ["ride_id", "started_at", "ended_at", "station"], positive=["duration_sec"])
    assert {r.ride_id: (r.station_key, r.duration_sec) for r in good.collect()} == {
        "r1": ("station-clark-st-elm", 600), "r2": ("station-clark-st-elm", 330), "r3": ("S9", 60)
    }
    stations = ef.summarize(good, ["station_key"], first={"name": "station"}, order="ride_id", count={"rides": "ride_id"}, mean={"avg_lat": "lat"})
    assert ef.busiest(stations, "rides").first().station_key == "station-clark-st-elm"
    schema = ef.Schema(
        "Ride",
        {"duration_sec": ef.Field(WHOLE, nullable=False), "started_at": ef.Field(TIME, nullable=False)},
        key=ef.key_policy("Ride", id_field="ride_id", ancestors=[("Dataset", ef.KeyPart(constant="public")), ("Station", "station_key")], namespace="rides"),
        strict=False,
    )
    ef.write_entities(store, good, schema).raise_for_errors()
    station = ef.EntityKey((("Dataset", "public"), ("Station", "S9")), namespace="rides")
    assert [r.duration_sec for r in ef.read_entities(store, "Ride", schema=schema, ancestor=station).collect()] == [60]


def test_delete_in_bulk_and_get(store, frame):
    schema = ef.Schema("D", {"v": ef.Field(WHOLE)}, key=ef.key_policy("D", id_field="d"))
    ef.write_entities(store, frame([("a", 1), ("b", 2)], "d string, v int"), schema)
    key = ef.EntityKey((("D", "a"),))
    assert [r.v for r in store.table("D").get([key]).collect()] == [1]
    ef.delete_entities(store, "D", [key])
    assert store.table("D").get([key]).count() == 0
    assert [r[fv.PATH] for r in ef.scan(store, ef.QuerySpec("D")).collect()] == ["D/n:b/"]
