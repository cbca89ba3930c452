"""Counters of a run, and the report built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.functions.decode import decode
from cellindex.operators import changelog, select
from cellindex.spec import IndexSpec


def bad_values(spec: IndexSpec) -> Column:
    """How many definitions find bytes in a cell that do not fit their type."""
    found = F.lit(0)
    if spec.row_mapper is None:
        for d in spec.fields:
            source = F.col(d.source)
            empty = F.size(decode(source, d.type, d.params)) == 0
            bad = select.matches(d.target) & select.is_put() & source.isNotNull() & empty
            found = found + F.coalesce(bad.cast("int"), F.lit(0))
    return found


def event_counters(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Events that came in and those of the spec's own table; values that did not fit, deletes that cannot be expressed."""
    own = select.of_table(spec)
    ignored = F.lit(False)
    if spec.mapping == "column":
        ignored = own & select.relevant(spec) & (changelog.change_kind(spec) == changelog.IGNORED)
    events = cells.groupBy("event_id", "row_key").agg(
        F.bool_or(own).alias("own"),
        F.sum(F.when(own, bad_values(spec)).otherwise(0)).alias("bad"),
        F.count_if(ignored).alias("ignored"),
    )
    none = F.lit(0).cast("bigint")
    return events.agg(
        F.count(F.lit(1)).alias("incoming_events"),
        F.count_if("own").alias("applicable_events"),
        F.coalesce(F.sum("bad"), none).alias("bad_values"),
        F.coalesce(F.sum("ignored"), none).alias("ignored"),
    )


def change_counts(changes: DataFrame) -> dict[str, Column]:
    """Adds, deletes of each kind, and documents that were set aside; a document in parts counts once.

    Plain aggregates over the rows of a changelog, which can also be observed while it is written.
    """
    kind = F.col("kind")
    bad = F.col("error").isNotNull() if "error" in changes.columns else F.lit(False)
    first_part = F.col("part") == 0 if "part" in changes.columns else F.lit(True)
    return {
        "adds": F.count_if((kind == changelog.UPSERT) & first_part & ~bad),
        "deletes_by_id": F.count_if(kind == changelog.DELETE_ID),
        "deletes_by_query": F.count_if(kind.isin(changelog.DELETE_ROW, changelog.DELETE_ROW_FAMILY)),
        "document_errors": F.count_if(bad & first_part),
    }


def change_counters(changes: DataFrame) -> DataFrame:
    return changes.agg(*[c.alias(n) for n, c in change_counts(changes).items()])


def as_rows(counters: DataFrame) -> DataFrame:
    """One row of counters as (metric, value) rows."""
    return counters.unpivot([], counters.columns, "metric", "value")


def build_report(runs: DataFrame) -> DataFrame:
    """Per run: records in, records that failed, and whether all went well.

    ``runs`` has one row per record with columns run and error (NULL if good).
    """
    return _judged(runs.groupBy("run").agg(F.count(F.lit(1)).alias("records_in"), F.count("error").alias("records_failed")))


def stored_report(counters: DataFrame) -> DataFrame:
    """The same from stored counters of batches, with columns run, metric and value.

    A record fails if its document is set aside. Single values that did not fit leave a gap in a document and have a
    counter of their own, so a record never fails twice.
    """

    def total(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("metric").isin(*names), F.col("value"))), F.lit(0))

    return _judged(
        counters.groupBy("run").agg(
            total("incoming_events").alias("records_in"), total("document_errors").alias("records_failed")
        )
    )


def _judged(report: DataFrame) -> DataFrame:
    state = F.when(F.col("records_failed") == 0, F.lit("FINISHED")).otherwise(F.lit("FINISHED_WITH_ERRORS"))
    return report.withColumn("state", state).withColumn("success", F.col("records_failed") == 0)
