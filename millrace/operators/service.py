"""Service log: request availability and resource usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the answer names its pod and version.
POD = r"Running on: ([^ |]+)"
VERSION = r"v=([^ |]+)"


def _part(pattern: str) -> Column:
    """First group of a pattern in the response; null when it does not occur."""
    return F.nullif(F.regexp_extract("Response", pattern, 1), F.lit(""))


def availability(requests: DataFrame) -> DataFrame:
    """Samples, failures, answers per version and answers per pod, as labelled counts.

    The log is grouped once by version and pod; the report is made from those few rows. Samples and
    failures are always reported, as 0 for an empty log; samples without an exit code are counted as
    ``unknown`` when there are any.
    """
    groups = requests.groupBy(_part(VERSION).alias("version"), _part(POD).alias("pod")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ExitCode") != 0).alias("failed"),
        F.count_if(F.col("ExitCode").isNull()).alias("unknown"),
    )

    def entry(kind: str, label: Column, n: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"), F.col(n).alias("n"))

    entries = F.array(
        entry("samples", F.lit("all"), "n"),
        entry("failures", F.lit("all"), "failed"),
        entry("unknown", F.when(F.col("unknown") > 0, F.lit("all")), "unknown"),
        entry("version", F.col("version"), "n"),
        entry("pod", F.col("pod"), "n"),
    )
    always = requests.sparkSession.createDataFrame(
        [("samples", "all", 0), ("failures", "all", 0)], "kind string, label string, n long"
    )
    return (
        groups.select(F.inline(entries))
        .where(F.col("label").isNotNull())
        .unionByName(always)
        .groupBy("kind", "label")
        .agg(F.sum("n").alias("n"))
    )


# Unit suffixes and their size in thousandths of a core and in bytes.
CPU_UNITS = {"n": 1e-6, "u": 1e-3, "m": 1, "": 1e3, "k": 1e6}
MEMORY_UNITS = {"": 1, "k": 10**3, "M": 10**6, "G": 10**9, "T": 10**12, "Ki": 2**10, "Mi": 2**20, "Gi": 2**30, "Ti": 2**40}


def _quantity(column: str, units: dict[str, float]) -> Column:
    """A number with a unit suffix; an error where the text is there but cannot be read."""
    number = F.regexp_extract(column, r"^(\d+(?:\.\d+)?)[a-zA-Z]*$", 1).try_cast("double")
    suffix = F.regexp_extract(column, r"([a-zA-Z]*)$", 1)
    size = F.lit(None).cast("double")
    for unit, factor in units.items():
        size = F.when(suffix == unit, F.lit(float(factor))).otherwise(size)
    value = number * size
    unread = F.raise_error(F.concat(F.lit(f"no {column} quantity: "), F.col(column))).cast("double")
    return F.when(F.col(column).isNotNull() & value.isNull(), unread).otherwise(value)


def readings(usage: DataFrame) -> DataFrame:
    """Usage text as numbers: CPU (``61m``, ``1``) to millicores, memory (``238Mi``, ``2Gi``) to mebibytes.

    Rounded to whole numbers. A missing reading stays null; one in an unknown form fails the query.
    """
    return usage.select(
        "namespace",
        "name",
        F.round(_quantity("cpu", CPU_UNITS)).cast("bigint").alias("cpu_millicores"),
        F.round(_quantity("memory", MEMORY_UNITS) / 2**20).cast("bigint").alias("memory_mib"),
    )


def usage_with_total(usage: DataFrame) -> DataFrame:
    """Usage per pod, largest CPU first, followed by a grand-total row.

    The rows of a pod are added up before the total is formed from them.
    """
    per_pod = readings(usage).groupBy("namespace", "name").agg(
        F.sum("cpu_millicores").alias("cpu_millicores"), F.sum("memory_mib").alias("memory_mib")
    )
    report = per_pod.groupingSets([["namespace", "name"], []], "namespace", "name").agg(
        F.grouping("name").cast("int").alias("is_total"),
        F.sum("cpu_millicores").alias("cpu_millicores"),
        F.sum("memory_mib").alias("memory_mib"),
    )
    return report.orderBy("is_total", F.desc("cpu_millicores"), "namespace", "name")
