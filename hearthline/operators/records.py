"""Raw records to typed properties and events; each stage returns what passed and what did not.

Checks run in a fixed order and the first that fails names the reject. One bad event fails its
whole record. Ids derive from the address and the event, so a replay makes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address, classify, keys, values
from ..schemas import EVENT, SOURCE_NAME
from .history import sort_and_dedupe

# All codes that records can be rejected with.
ERRORS = ["ReadyToBuildTagEncountered", "UnknownPropertyType", "VacantLandEncountered", "InvalidPropertyDataType", "MissingRequiredField", "InvalidPropertyAddress", "InvalidPropertyDataFormat", "UnknownAreaUnit", "UnknownPropertyStatus", "Unexpected"]
MESSAGES = {"VacantLandEncountered": "vacant land is skipped", "ReadyToBuildTagEncountered": "ready to build, not built"}


def typed_events(history: Column) -> Column:
    """Raw events to typed ones, in input order."""

    def typed(e: Column) -> Column:
        return F.struct(
            values.event_time(e["date"]).alias("event_ts"),
            classify.event_type(e["description"]).alias("event_type"),
            e["price"].try_cast("decimal(18,2)").alias("price"),
            F.lower(e["source"]).alias("source"),
            e["mlsNumber"].alias("source_id"),
            e["description"].alias("description"),
        )

    return F.transform(history, typed)


def has_bad_event(events: Column) -> Column:
    return F.exists(events, lambda e: e["event_ts"].isNull() | e["event_type"].isNull() | e["source"].isNull())


def first_error() -> Column:
    """The code of the first check that a prepared record fails, or null."""
    c, missing = F.col, lambda name: F.coalesce(F.col(name) == "", F.lit(True))
    bad_type = "InvalidPropertyDataType"
    return (
        F.when(F.coalesce(c("ready_to_build"), F.lit(False)), "ReadyToBuildTagEncountered")
        .when(c("_type").isNull(), "UnknownPropertyType")
        .when(c("_type") == "VacantLand", "VacantLandEncountered")
        .when(missing("url"), bad_type)
        .when(missing("data_source_name") | (c("data_source_name") != SOURCE_NAME), bad_type)
        .when(missing("data_source_id") | missing("address") | missing("scraped_at"), bad_type)
        .when(missing("area"), "MissingRequiredField")
        .when(c("year_built").isNull(), "MissingRequiredField")
        .when(c("status").isNull(), bad_type)
        .when(c("_address").isNull(), "InvalidPropertyAddress")
        .when(values.area_error(c("area")).isNotNull(), values.area_error(c("area")))
        .when(values.area_error(values.blank_to_null(c("lot_area")), True).isNotNull(), values.area_error(values.blank_to_null(c("lot_area")), True))
        .when(c("_seen").isNull(), "Unexpected")
        .when(c("bedrooms").isNull() | c("bathrooms").isNull(), "MissingRequiredField")
        .when(has_bad_event(c("_typed")), "Unexpected")
        .when(c("_status.error").isNotNull(), c("_status.error"))
    )


def rejects(df: DataFrame, stage: str, code: Column) -> DataFrame:
    text = F.coalesce(values.lookup(MESSAGES, code), F.concat(F.lit("failed: "), code))
    payload = F.col("payload") if "payload" in df.columns else F.to_json(F.struct("*"))
    return df.select(F.col("record_key"), F.lit(stage).alias("stage"), code.alias("error_code"), text.alias("message"), payload.alias("payload"))


def judged(records: DataFrame) -> DataFrame:
    """Raw records (with record_key) as one frame: ``error_code`` and ``payload`` of those that fail, and the typed
    columns, with an ``events`` array, of those that don't. One pass over the records; split it after a write."""
    payload = F.col("payload") if "payload" in records.columns else F.to_json(F.struct(*records.columns))
    df = address.standardise(records.withColumn("_payload", payload), "address", "_address")
    df = values.staged(df, {"_type": classify.property_type(F.col("property_type")), "_seen": values.utc_time(F.col("scraped_at")), "_typed": typed_events(F.col("history"))})
    df = values.staged(df, {"_events": sort_and_dedupe(F.col("_typed"))})
    df = values.staged(df, {"_status": classify.resolve_status(F.col("status"), F.col("_events"), F.col("_seen"))})
    df = values.staged(df, {"_error": first_error()})
    last_price = F.try_element_at(F.col("_events"), F.lit(-1))["price"]
    source = F.struct(F.col("data_source_id").alias("source_id"), F.col("url").alias("source_url"), F.lit(SOURCE_NAME).alias("source_name"))
    return df.select(
        "record_key",
        F.col("_error").alias("error_code"),
        F.when(F.col("_error").isNotNull(), F.col("_payload")).alias("payload"),
        F.coalesce(values.blank_to_null(F.col("property_id")), keys.property_id(F.col("_address.address_hash"))).alias("property_id"),
        F.col("_address").alias("address"),
        F.col("_address.address_hash").alias("address_hash"),
        values.area(F.col("area")).alias("area"),
        values.area(values.blank_to_null(F.col("lot_area")), True).alias("lot_area"),
        F.col("_type").alias("property_type"),
        F.col("bedrooms").cast("decimal(5,2)").alias("bedrooms"),
        F.col("bathrooms").cast("decimal(5,2)").alias("bathrooms"),
        "year_built",
        F.coalesce(F.col("price").try_cast("decimal(18,2)"), last_price).alias("price"),
        F.col("_seen").alias("last_updated"),
        F.array(source).alias("data_sources"),
        F.col("_address.city").alias("city"),
        F.col("_address.zip_code").alias("zip_code"),
        F.col("_address.state").alias("state"),
        F.col("_status.status").alias("status"),
        F.col("_events").alias("events"),
    )


def split(judged_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(properties with an ``events`` array, rejects) of what ``judged`` gave."""
    return judged_.where("error_code is null").drop("error_code", "payload"), rejects(judged_.where("error_code is not null"), "parse", F.col("error_code"))


def parse(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw records (with record_key) to (properties with an ``events`` array, rejects)."""
    return split(judged(records))


def judged_scans(records: DataFrame) -> DataFrame:
    """Raw records of stored properties as one frame: error_code and payload, or property_id, status_text, seen_at and events.
    Only status and history are read: withdrawn and sold pages leave most other fields out."""
    payload = F.col("payload") if "payload" in records.columns else F.to_json(F.struct(*records.columns))
    df = records.withColumns({"_payload": payload, "_seen": values.utc_time(F.col("scraped_at")), "_typed": F.coalesce(typed_events(F.col("history")), F.array().cast(f"array<{EVENT}>"))})
    df = df.withColumn("error_code", F.when(F.col("status").isNull(), "InvalidPropertyDataType").when(F.col("_seen").isNull() | has_bad_event(F.col("_typed")), "Unexpected"))
    return df.select("record_key", "error_code", F.when(F.col("error_code").isNotNull(), F.col("_payload")).alias("payload"), "property_id", F.col("status").alias("status_text"), F.col("_seen").alias("seen_at"), sort_and_dedupe(F.col("_typed")).alias("events"))


def split_scans(judged_: DataFrame) -> tuple[DataFrame, DataFrame]:
    return judged_.where("error_code is null").drop("error_code", "payload"), rejects(judged_.where("error_code is not null"), "rescan", F.col("error_code"))


def scans(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw records of stored properties to (record_key, property_id, status_text, seen_at, events; rejects)."""
    return split_scans(judged_scans(records))


def property_rows(parsed: DataFrame) -> DataFrame:
    return parsed.drop("record_key", "events")


def event_rows(parsed: DataFrame) -> DataFrame:
    """One row an event, exploded once and kept as rows from here on."""
    rows = parsed.select("property_id", F.explode("events").alias("e")).select("property_id", "e.*")
    return rows.withColumn("event_id", keys.event_id(F.col("property_id"))).select("event_id", "property_id", "event_ts", "event_type", "price", "source", "source_id", "description")
