"""A batch of observations of stored and new properties, folded in order of time without rounds.

Listings (parsed records) overwrite: what is left of a property's attributes is the last non-null
value of each, of status, price and time the last observation's, of sources the last URL of each in
order of first sight. Such folds are aggregates, so one address with any number of observations is
combined in many tasks. Re-scans depend on each other through the history (a banner may mean another
status after an added removal): properties that a batch re-scans have their steps, listings and scans
alike, sorted in an array, and one ``aggregate`` runs over it with the state (events, status, price,
time). Either way the result is that of applying the observations one by one, oldest first; of equally
old ones listings before scans, then by record key.

Defined results: an observation that is not newer than what is stored and says the same leaves the time
alone; nulls never overwrite attributes; equal events count once and what is stored wins, then the
older observation; an address met for the first time gets the id that its oldest observation names; a
scan without a status for its banner leaves only its events and a reject; properties that nothing
changes for are not returned.

Both sides of each join grow with the store or the batch, so all ask for a merge join: Spark would take a column of a
compressed file for small, and collect it on the driver to broadcast many times that size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.keys import event_id
from ..schemas import EVENT
from . import correction, history, records
from .merge import ALWAYS_NEW, KEPT_IF_NULL, merge_sources

STATE = f"struct<events: array<{EVENT}>, status: string, price: decimal(18,2), last_updated: timestamp, clean: boolean, errors: array<struct<record_key: string, error_code: string, payload: string>>>"


def with_owner(properties: DataFrame, observed: DataFrame) -> DataFrame:
    """``observed`` with the id of the property that each observation is of, in place of its own."""
    stored = properties.groupBy("address_hash").agg(F.min("property_id").alias("_stored"))
    first = observed.groupBy("address_hash").agg(F.min_by("property_id", F.struct("last_updated", "record_key")).alias("_first"))
    owner = first.join(stored.hint("merge"), "address_hash", "left").select("address_hash", F.coalesce("_stored", "_first").alias("_owner"))
    return observed.join(owner.hint("merge"), "address_hash").drop("property_id").withColumnRenamed("_owner", "property_id")


def _says_the_same(properties: DataFrame, observed: DataFrame) -> DataFrame:
    """``observed`` with ``attributes_same`` and ``all_same``: whether storing it would change anything but the time."""
    stored = properties.select("property_id", F.struct(*[c for c in properties.columns if c != "property_id"]).alias("_s"))
    same = F.col("_s").isNotNull()
    for c in KEPT_IF_NULL:
        same = same & (F.col(c).isNull() | F.col(c).eqNullSafe(F.col(f"_s.{c}")))
    same = same & merge_sources(F.col("_s.data_sources"), F.col("data_sources")).eqNullSafe(F.coalesce(F.col("_s.data_sources"), F.array().cast(properties.schema["data_sources"].dataType)))
    both = observed.join(stored.hint("merge"), "property_id", "left").withColumn("attributes_same", same)
    return both.withColumn("all_same", F.col("attributes_same") & F.col("status").eqNullSafe(F.col("_s.status")) & F.col("price").eqNullSafe(F.col("_s.price"))).drop("_s")


def listings(properties: DataFrame, observed: DataFrame) -> DataFrame:
    """One row a property of ``observed`` (property_id: the owner): its row after all of its listings, and ``unchanged``."""
    observed = _says_the_same(properties, observed)
    turn = F.struct("last_updated", "record_key")
    kept = [F.max_by(c, F.when(F.col(c).isNotNull(), turn)).alias(c) for c in KEPT_IF_NULL]
    last = F.max_by(F.struct(*ALWAYS_NEW), turn).alias("last")
    per = observed.groupBy("property_id").agg(*kept, last, F.bool_and("all_same").alias("all_same"))
    seen = observed.select("property_id", turn.alias("turn"), F.posexplode("data_sources").alias("at", "s"))
    place = F.struct("turn", "at")
    sources = seen.groupBy("property_id", F.col("s.source_id").alias("source_id")).agg(F.min(place).alias("first"), F.max_by("s.source_url", F.when(F.col("s.source_url").isNotNull(), place)).alias("source_url"), F.min_by("s.source_name", place).alias("source_name"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("first", "source_id", "source_url", "source_name"))), lambda x: F.struct(x["source_id"].alias("source_id"), x["source_url"].alias("source_url"), x["source_name"].alias("source_name")))
    sources = sources.groupBy("property_id").agg(listed.alias("data_sources"))
    new, old = per.join(sources.hint("merge"), "property_id", "left").alias("n"), properties.alias("o")
    both = new.join(old.hint("merge"), "property_id", "left")
    newer = F.coalesce(F.col("n.last.last_updated") > F.col("o.last_updated"), F.lit(False))
    unchanged = F.col("n.all_same") & ~newer
    columns = {c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) for c in KEPT_IF_NULL} | {c: F.col(f"n.last.{c}") for c in ALWAYS_NEW}
    columns |= {"last_updated": F.when(unchanged, F.col("o.last_updated")).otherwise(F.col("n.last.last_updated")), "data_sources": merge_sources(F.col("o.data_sources"), F.col("n.data_sources"))}
    return both.select("property_id", *[v.alias(k) for k, v in columns.items()], unchanged.alias("unchanged"))


def let(value: Column, body) -> Column:
    """``body`` of a column that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _step(state: Column, x: Column) -> Column:
    """The state after one listing or scan."""

    def with_history(h: Column) -> Column:
        def with_status(s: Column) -> Column:
            scan, fine = x["scan"], s["error"].isNull() & s["status"].isNotNull()
            changed = scan & fine & ~s["status"].eqNullSafe(state["status"])
            removal = F.when(changed & (s["status"] == "ListRemoved"), correction.lacking_removal(h, x["at"]))
            added = F.when(removal.isNotNull(), F.array(correction.system_event(removal).cast(EVENT))).otherwise(F.array().cast(f"array<{EVENT}>"))
            same = ~scan & state["clean"] & x["attributes_same"] & x["status"].eqNullSafe(state["status"]) & x["price"].eqNullSafe(state["price"]) & ~F.coalesce(x["at"] > state["last_updated"], F.lit(False))
            return F.struct(
                F.concat(h, added).alias("events"),
                F.when(~scan, x["status"]).when(fine, s["status"]).otherwise(state["status"]).alias("status"),
                F.when(~scan, x["price"]).when(changed & (s["status"] == "Sold"), None).otherwise(state["price"]).alias("price"),
                F.when((~scan & ~same) | (scan & fine), x["at"]).otherwise(state["last_updated"]).alias("last_updated"),
                (state["clean"] & (scan | x["attributes_same"])).alias("clean"),
                F.when(scan & ~fine, F.concat(state["errors"], F.array(F.struct(x["record_key"].alias("record_key"), s["error"].alias("error_code"), x["text"].alias("payload"))))).otherwise(state["errors"]).alias("errors"),
            ).cast(STATE)

        return let(classify.resolve_status(x["text"], h, x["at"]), with_status)

    return let(F.concat(state["events"], x["events"]), lambda both: let(history.sort_and_dedupe(both), with_history))


def replay(properties: DataFrame, events: DataFrame, observed: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row for each stored property of ``scanned``: property_id, status, price, last_updated, the events that are
    new (in order of their coming), errors, and whether a listing was among the steps."""
    observed = _says_the_same(properties, observed.join(scanned.select("property_id").distinct().hint("merge"), "property_id", "left_semi"))
    step = lambda at, scan, text, status, price, same: F.struct(at.alias("at"), F.lit(scan).alias("scan"), "record_key", text.alias("text"), status.alias("status"), price.alias("price"), same.alias("attributes_same"), F.col("events").cast(f"array<{EVENT}>").alias("events"))
    null = lambda kind: F.lit(None).cast(kind)
    rows = observed.select("property_id", step(F.col("last_updated"), False, null("string"), F.col("status"), F.col("price"), F.coalesce("attributes_same", F.lit(False))).alias("x"))
    rows = rows.union(scanned.select("property_id", step(F.col("seen_at"), True, F.col("status_text"), null("string"), null("decimal(18,2)"), F.lit(True)).alias("x")))
    # the first fields of a step are its order: time, listings first, record key
    steps = rows.groupBy("property_id").agg(F.array_sort(F.collect_list("x")).alias("steps"))
    mine = properties.join(steps.hint("merge"), "property_id").select("property_id", "status", "price", "last_updated", "steps")
    told = history.as_arrays(events.join(steps.select("property_id").hint("merge"), "property_id", "left_semi"))
    none = F.array().cast(f"array<{EVENT}>")
    mine = mine.join(told.hint("merge"), "property_id", "left").withColumn("history", F.coalesce(F.col("history").cast(f"array<{EVENT}>"), none))
    start = F.struct(F.col("history").alias("events"), "status", "price", "last_updated", F.lit(True).alias("clean"), F.array().cast("array<struct<record_key: string, error_code: string, payload: string>>").alias("errors")).cast(STATE)
    done = mine.select("property_id", "history", F.exists("steps", lambda x: ~x["scan"]).alias("listed"), F.aggregate("steps", start, _step).alias("s"))
    new = F.filter("s.events", lambda e: ~F.exists("history", lambda o: history.equal(o, e)))
    return done.select("property_id", "listed", "s.status", "s.price", "s.last_updated", "s.errors", new.alias("new_events"))


def _new_events(events: DataFrame, observed: DataFrame) -> DataFrame:
    """Events of listings that are not stored; of equal ones the oldest listing's."""
    rows = observed.select("property_id", "last_updated", "record_key", F.explode("events").alias("e")).select("property_id", "last_updated", "record_key", "e.*")
    rows = history.first_of_equals(rows, prefer=["last_updated", "record_key"]).drop("last_updated", "record_key")
    known = events.join(rows.select("property_id").distinct().hint("merge"), "property_id", "left_semi")
    return history.only_new(known.hint("merge"), rows).withColumn("event_id", event_id(F.col("property_id"))).select(*events.columns)


def apply(properties: DataFrame, events: DataFrame, parsed: DataFrame, scanned: DataFrame, keep=lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changed property rows, new event rows, rejects) after a batch. parsed: as ``records.parse`` gives it; scanned: as
    ``records.scans`` does, of stored properties. ``keep`` is given what is read more than once (write it somewhere)."""
    observed = keep(with_owner(properties, parsed))
    rows = keep(listings(properties, observed))
    columns = properties.columns
    listed = rows.where("not unchanged").select(*columns)
    if scanned.isEmpty():
        return listed, _new_events(events, observed), records.rejects(scanned.withColumn("payload", F.lit("")), "rescan", F.lit(""))
    scans = keep(replay(properties, events, observed, scanned))
    only_listed = listed.join(scans.select("property_id").hint("merge"), "property_id", "left_anti").select(*columns)
    base = properties.join(rows.select("property_id").hint("merge"), "property_id", "left_anti").unionByName(rows.select(*columns))
    last = scans.select("property_id", *[F.col(c).alias(f"_{c}") for c in ALWAYS_NEW])
    was = properties.select("property_id", F.struct(*[c for c in columns if c != "property_id"]).alias("_was"))
    turned = base.join(last.hint("merge"), "property_id").join(was.hint("merge"), "property_id", "left").withColumns({c: F.col(f"_{c}") for c in ALWAYS_NEW})
    turned = turned.where(~F.struct(*[c for c in columns if c != "property_id"]).eqNullSafe(F.col("_was"))).select(*columns)

    told = scans.select("property_id", F.explode("new_events").alias("e")).select("property_id", "e.*").withColumn("event_id", event_id(F.col("property_id"))).select(*events.columns)
    new = _new_events(events, observed.join(scans.select("property_id").hint("merge"), "property_id", "left_anti")).unionByName(told)
    bad = scans.select(F.explode("errors").alias("e")).select("e.record_key", F.lit("rescan").alias("stage"), "e.error_code", F.lit("no status for this banner").alias("message"), "e.payload")
    return only_listed.unionByName(turned), new, bad
