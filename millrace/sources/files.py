"""Text, Parquet and CSV inputs with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import scratch

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("Time", T.TimestampType()),
        T.StructField("ExitCode", T.IntegerType()),
        T.StructField("Response", T.StringType()),
    ]
)

# What the trip jobs need, and the family each column must belong to.
TRIP_COLUMNS = {
    "tpep_pickup_datetime": (T.TimestampType, T.TimestampNTZType),
    "tpep_dropoff_datetime": (T.TimestampType, T.TimestampNTZType),
    "passenger_count": (T.NumericType,),
    "trip_distance": (T.NumericType,),
    "PULocationID": (T.IntegralType,),
    "DOLocationID": (T.IntegralType,),
    "payment_type": (T.IntegralType,),
    "fare_amount": (T.NumericType,),
    "extra": (T.NumericType,),
    "tip_amount": (T.NumericType,),
    "total_amount": (T.NumericType,),
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (column ``value``)."""
    return spark.read.text(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file`` and the whole ``value``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def read_numbered_lines(spark: SparkSession, path: str, line_end: str | None = None) -> DataFrame:
    """Lines with a position that orders them within their file.

    ``block`` is the offset of the file split a line was read from and ``seq`` grows along
    that split, so (block, seq) follows the file without a global numbering or a sort. Lines end as they do
    in text files, unless ``line_end`` says how.
    """
    reader = spark.read.option("lineSep", line_end) if line_end else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def write_books(books: DataFrame, path: str) -> None:
    """Texts (``doc_id``, ``text``) as text files of many books each, in the order of their ids.

    Each line carries the number of its book before a tab; a null number is empty, a null text is one empty line.
    """
    number = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\t"))
    text = F.coalesce("text", F.lit(""))
    numbered = F.concat(number, F.replace(text, F.lit("\n"), F.concat(F.lit("\n"), number)))
    books.sortWithinPartitions("doc_id").select(numbered.alias("value")).write.option("lineSep", "\n").text(path)


def book_lines(lines: DataFrame) -> DataFrame:
    """Lines of ``write_books``, as ``read_numbered_lines`` reads them, with the text before the tab apart (``book``)."""
    tab = F.locate("\t", F.col("value"))
    line = F.substring("value", tab + 1, F.length("value"))
    return lines.withColumns({"book": F.substring_index("value", "\t", 1), "value": line})


def book_id(book: str) -> Column:
    """The number that ``write_books`` was given, from the text that ``book_lines`` found."""
    return F.nullif(F.col(book), F.lit("")).cast("long")


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trip records from Parquet; fails early when a needed column is missing or of another kind."""
    trips = spark.read.parquet(path)
    types = {field.name: field.dataType for field in trips.schema.fields}
    wrong = [
        f"{name}: {types[name].simpleString() if name in types else 'missing'}"
        for name, kinds in TRIP_COLUMNS.items()
        if not isinstance(types.get(name), kinds)
    ]
    if wrong:
        raise ValueError("not a trip table: " + ", ".join(wrong))
    return trips


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    header: bool = True,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """CSV with a declared schema, or an inferred one from a share of the rows when none is given."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


_DAMAGED = "_damaged"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV that fit the schema, and the others: ``file`` and ``raw`` text.

    A record goes to the others when it has too few or too many fields or a value of another type. The parsed records are
    stored once, so both results come from one reading. A quote within quotes is doubled. Quoted fields may hold line
    breaks with ``multi_line``; a file is then read by one task.
    """
    options = {"header": header, "sep": sep, "escape": '"', "multiLine": multi_line, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED}
    whole = T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())])
    read = spark.read.options(**options).schema(whole).csv(path)
    records = scratch.stored(read.select("*", F.col("_metadata.file_path").alias("_file")), "records")
    good = records.where(F.col(_DAMAGED).isNull()).select(*schema.names)
    damaged = records.where(F.col(_DAMAGED).isNotNull())
    return good, damaged.select(F.col("_file").alias("file"), F.col(_DAMAGED).alias("raw"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup. The borough ``N/A`` is an ordinary value, not a null."""
    return read_csv(spark, path, ZONE_SCHEMA)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request log: time with offset, exit code and response text."""
    return read_csv(spark, path, REQUEST_SCHEMA)


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    rows.write.option("header", True).option("sep", sep).csv(path)
