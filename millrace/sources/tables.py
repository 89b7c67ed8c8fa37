"""The benchmark tables, and the views that give them the shape the jobs expect.

A trip is an order line: pick-up time from its order, drop-off time from its shipment,
pick-up zone from the customer's nation, drop-off zone from the supplier's. Zones are
nations and boroughs are regions. An edit is an event; its message is JSON text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import numbering
from millrace.sources import scratch, topics


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """A table as a file stream; it may be one Parquet file or a directory of them."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).options(**options)
    if scratch.is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _read(spark: SparkSession, sf_dir: str, name: str, stream: bool) -> DataFrame:
    return table_stream(spark, sf_dir, name) if stream else table(spark, sf_dir, name)


# --- trips ----------------------------------------------------------------------------------

# Columns of the trip view by the table they come from.
_LINE = {
    "order_key": "l_orderkey",
    "line_number": "l_linenumber",
    "tpep_dropoff_datetime": "l_shipdate",
    "passenger_count": "cast(l_linenumber as double)",
    "trip_distance": "l_quantity",
    "payment_type": "case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end",
    "fare_amount": "l_extendedprice",
    "extra": "l_tax",
    "tip_amount": "l_extendedprice * l_discount",
    "total_amount": "l_extendedprice + l_extendedprice * l_discount",
}
_ORDER = {"tpep_pickup_datetime": "o_orderdate"}
_CUSTOMER = {"PULocationID": "c_nationkey"}
_SUPPLIER = {"DOLocationID": "s_nationkey"}
TRIP_VIEW = {**_LINE, **_ORDER, **_CUSTOMER, **_SUPPLIER}


def _with_ends(rows: DataFrame, spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Join to line rows the tables the columns need.

    Every join is a left join from the line, so the rows stay those of ``rows`` whatever the
    columns. Order and customer meet before the larger side is shuffled.
    """
    if any(name in _CUSTOMER for name in columns):
        orders = table(spark, sf_dir, "orders").join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
        )
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    elif any(name in _ORDER for name in columns):
        rows = rows.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if any(name in _SUPPLIER for name in columns):
        rows = rows.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows


def trips(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] = tuple(TRIP_VIEW),
    lines: DataFrame | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The trip view, one row per order line, or per line of ``lines`` where only some are wanted.

    ``keep`` names columns of ``lines`` that stay beside the view's.
    """
    columns = list(columns)
    rows = _with_ends(table(spark, sf_dir, "lineitem") if lines is None else lines, spark, sf_dir, columns)
    return rows.selectExpr(*[f"{TRIP_VIEW[name]} as {name}" for name in columns], *keep)


def numbered_lines(spark: SparkSession, sf_dir: str, name: str = "trip_id") -> DataFrame:
    """Order lines with a dense number, the same in every run."""
    return numbering.number_rows(table(spark, sf_dir, "lineitem"), name)


def trip_counts(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """The trip view counted per order or supplier (``n_trips``), for questions that only count."""
    return trip_sums(spark, sf_dir, columns)


def trip_sums(spark: SparkSession, sf_dir: str, columns: Iterable[str], measures: Iterable[str] = ()) -> DataFrame:
    """The trip view added up per order or supplier: ``n_trips`` and, per measure, its sum and number of values.

    Lines are added up before the join: an order with a third of all lines is one row per task
    when it is shuffled, and the join finds the rows where the sum has put them.
    """
    columns = list(columns)
    parts = [
        part
        for m in measures
        for part in (F.sum(F.expr(_LINE[m])).alias(f"{m}_sum"), F.count(F.expr(_LINE[m])).alias(f"{m}_n"))
    ]
    keys = [
        key
        for key, names in (("l_orderkey", {**_ORDER, **_CUSTOMER}), ("l_suppkey", _SUPPLIER))
        if any(name in names for name in columns)
    ]
    counted = table(spark, sf_dir, "lineitem").groupBy(*keys).agg(F.count("*").alias("n_trips"), *parts)
    rows = _with_ends(counted, spark, sf_dir, columns)
    sums = [name for name in counted.columns if name not in keys]
    return rows.selectExpr(*[f"{TRIP_VIEW[name]} as {name}" for name in columns], *sums)


def rides(spark: SparkSession, sf_dir: str, zones: bool = False) -> DataFrame:
    """Events as trips for questions about the hour, which order dates lack.

    The pick-up zone is the nation of the customer with the user's number.
    """
    events = table(spark, sf_dir, "events")
    if not zones:
        return events.selectExpr("ts as tpep_pickup_datetime")
    customer = table(spark, sf_dir, "customer")
    return events.join(customer, F.col("user_id") == F.col("c_custkey"), "left").selectExpr(
        "ts as tpep_pickup_datetime", "c_nationkey as PULocationID"
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LocationID, Borough, Zone."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


# --- texts ----------------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _read(spark, sf_dir, "documents", stream)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents inside a licence frame; German ones come without it."""
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), F.col("doc_id")),
        F.lit("*** START OF THE BOOK ***"),
        F.col("text"),
        F.lit("*** END OF THE BOOK ***"),
        F.lit("*** END OF THE FILE"),
    )
    framed = F.when(F.col("lang") == "de", F.col("text")).otherwise(body)
    return documents(spark, sf_dir).select("doc_id", "lang", framed.alias("text"))


# --- edits ----------------------------------------------------------------------------------


def as_edits(events: DataFrame) -> DataFrame:
    """Events with the field names and types of edit records."""
    page = F.get_json_object("props", "$.k").cast("int")
    change = F.round("value").cast("int") - 50
    return events.select(
        page.cast("string").alias("title"),
        F.col("user_id").cast("string").alias("user"),
        F.unix_timestamp("ts").alias("timestamp"),
        F.when(F.col("value") < 5, "new").otherwise("edit").alias("type"),
        F.col("event_type").alias("wiki"),
        F.floor(page / 25).cast("int").alias("namespace"),
        (F.col("user_id") % 5 == 0).alias("bot"),
        (F.col("value") < 20).alias("minor"),
        F.col("props").alias("comment"),
        F.struct(F.lit(100).alias("old"), (change + 100).alias("new")).alias("length"),
    )


def as_messages(events: DataFrame, damaged: bool = False) -> DataFrame:
    """Events as topic records: JSON in a binary ``value``.

    With ``damaged``, the message of an error event is cut short, so it no longer parses.
    """
    edits = as_edits(events)
    message = F.to_json(F.struct(*edits.columns))
    if damaged:
        message = F.when(F.col("wiki") == "error", F.expr("left(comment, length(comment) - 1)")).otherwise(message)
    return edits.select(message.cast("binary").alias("value"))


def edit_messages(spark: SparkSession, sf_dir: str, stream: bool = False, damaged: bool = False) -> DataFrame:
    return as_messages(_read(spark, sf_dir, "events", stream), damaged)


DELIVERIES = 10


def delivery() -> Column:
    """The delivery an event comes with: three days each, an eleventh of the events one late, some three late."""
    own = F.floor((F.dayofmonth("ts") - 1) / 3)
    late = F.when(F.col("event_id") % 97 == 0, 3).when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    return F.least(own + late, F.lit(DELIVERIES - 1))


# Bytes of a table that a file of a delivery stands for. An event becomes a message of many times its stored size.
FILE_BYTES = {"events": 1 << 20, "documents": 16 << 20}


def files_per_delivery(spark: SparkSession, sf_dir: str, name: str = "events", deliveries: int = DELIVERIES) -> int:
    """How many files each delivery of a table has, the same for all of them; they grow in number, not in size."""
    return max(1, math.ceil(scratch.size(spark, f"{sf_dir}/{name}.parquet") / deliveries / FILE_BYTES[name]))


def deliver(spark: SparkSession, sf_dir: str, path: str, deliveries: Iterable[int] = range(DELIVERIES)) -> None:
    """Append edit messages to a topic, one delivery after the other; each is as many files, as producers' flushes would be."""
    events, files = table(spark, sf_dir, "events"), files_per_delivery(spark, sf_dir)
    for n in deliveries:
        topics.publish(as_messages(events.where(delivery() == n)), path=path, files=files)


# --- service log ----------------------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a request log: an error event is a failed request without an answer."""
    failed = F.col("event_type") == "error"
    answer = F.concat(
        F.lit("Hello! | Running on: pod-"),
        F.get_json_object("props", "$.k"),
        F.lit(" | v="),
        F.when(F.col("ts") < F.lit("2024-01-16"), "1").otherwise("2"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("Time"),
        F.when(failed, 1).otherwise(0).alias("ExitCode"),
        F.when(~failed, answer).alias("Response"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as resource readings with unit suffixes: ``12m`` of CPU, ``34Mi`` of memory."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("namespace"),
        F.concat(F.lit("pod-"), F.get_json_object("props", "$.k")).alias("name"),
        F.concat(F.round("value").cast("bigint").cast("string"), F.lit("m")).alias("cpu"),
        F.concat(F.get_json_object("props", "$.k"), F.lit("Mi")).alias("memory"),
    )
