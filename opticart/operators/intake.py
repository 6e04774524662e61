"""Validated customer intake (D22): accept with new ids or log a rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticart.functions.email import email_error_code, email_error_message
from opticart.functions.ranking import global_row_number
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables
from opticart.sources.sinks import read_committed, write_snapshot

ACCEPTED, REJECTED = "accepted", "rejected"
ROUTED = ("feed_seq bigint, customer_id bigint, first_name string, last_name string, email string, "
          "log_id bigint, error_number int, error_description string, log_date timestamp_ntz, "
          "status string")


def customer_feed(t: Tables) -> DataFrame:
    """The feed (feed_seq, first_name, last_name, email) taken from the data:
    each customer row is submitted again, in id order."""
    return t.customers.select(F.col("customer_id").alias("feed_seq"),
                              "first_name", "last_name", "email")


def customer_intake(t: Tables, p: Params = DEFAULT, feed: DataFrame | None = None,
                    existing_ids: DataFrame | None = None,
                    logged_ids: DataFrame | None = None, scratch: str | None = None) -> DataFrame:
    """Run the whole feed through the e-mail rules in one job.

    The reference's procedure handles one row per call: the first failing
    rule (no '@' 51001, no '.' 51002, suffix not allowed 51003) is logged
    with its message, otherwise the customer is inserted with
    max(Customer_ID) + 1. Over a feed in arrival order that is: accepted
    rows get max(existing id) + their rank among accepted rows, rejected
    rows get log ids 1, 2, ... in order. Both ranks come from one global
    range ranking per status (no single-partition window).

    ``existing_ids`` (customer_id) and ``logged_ids`` (log_id) extend the
    customer table and the error log, e.g. with rows accepted or logged by
    earlier micro-batches of a stream. ``scratch`` is the folder of the ranked rows,
    for callers that delete it once the result is written.
    """
    feed = customer_feed(t) if feed is None else feed
    code = email_error_code(F.col("email"), p.allowed_suffixes)
    staged = feed.withColumn("error_number", code).withColumn(
        "status", F.when(F.col("error_number").isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))
    ranked = global_row_number(staged, [F.col("feed_seq")], "_seq", by=["status"], path=scratch)
    ids = t.customers.select("customer_id")
    if existing_ids is not None:
        ids = ids.unionByName(existing_ids.select("customer_id"))
    base_id = ids.agg(F.coalesce(F.max("customer_id"), F.lit(0)).cast("bigint")).scalar()
    log_base = (logged_ids.agg(F.coalesce(F.max("log_id"), F.lit(0)).cast("bigint")).scalar()
                if logged_ids is not None else F.lit(0))
    accepted = F.col("status") == ACCEPTED
    return ranked.select(
        "feed_seq", "status",
        F.when(accepted, base_id + F.col("_seq")).alias("customer_id"),
        "first_name", "last_name", "email",
        F.when(~accepted, log_base + F.col("_seq")).cast("bigint").alias("log_id"),
        F.col("error_number").cast("int").alias("error_number"),
        email_error_message(F.col("error_number")).alias("error_description"),
        F.when(~accepted, F.lit(p.as_of).cast("timestamp_ntz")).alias("log_date"))


def accepted_customers(intake: DataFrame) -> DataFrame:
    """Rows to append to CUSTOMERS."""
    return intake.where(F.col("status") == ACCEPTED).select(
        "customer_id", "first_name", "last_name", "email")


def email_error_log(intake: DataFrame) -> DataFrame:
    """Rows to append to the e-mail error log."""
    return intake.where(F.col("status") == REJECTED).select(
        "log_id", F.col("email").alias("email_address"), "error_description", "log_date")


def write_intake(intake: DataFrame, routed: str, version: int | str) -> str:
    """Insert into CUSTOMERS and the error log at once: one write of the routed rows,
    partitioned by status, is the only commit, and both tables are views on it
    (``read_routed`` with ``accepted_customers`` or ``email_error_log``). A crash leaves
    neither table changed; a repeated run replaces its own rows in both."""
    return write_snapshot(intake, routed, version, partition_by=["status"])


def read_routed(spark: SparkSession, routed: str) -> DataFrame:
    """The rows of all finished intakes; a filter on status reads its partition only."""
    return read_committed(spark, routed, ROUTED).drop("version")


def add_customer(t: Tables, first_name: str, last_name: str, email: str | None,
                 p: Params = DEFAULT) -> DataFrame:
    """The reference's one-row call: a feed of one row through the same job.

    Returns the routed row (accepted with its new id, or rejected with its
    error); append it with ``accepted_customers`` / ``email_error_log``.
    """
    feed = t.spark.createDataFrame([(1, first_name, last_name, email)],
                                   "feed_seq long, first_name string, last_name string, "
                                   "email string")
    return customer_intake(t, p, feed=feed)
