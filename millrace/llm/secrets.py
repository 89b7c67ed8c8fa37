"""Secrets in whole texts: plain patterns, and weak parts that count only beside their complements.

Base kinds (``assign``, ``access``, ``hex``) are reported wherever they match. A credential is often
spread over several parts; the weak kinds are shapes that are harmless alone:

* ``key``: a run of 32 or more base64 characters with a digit, a lower-case and an upper-case letter,
* ``ident``: an account, client, user or key identifier that is assigned a value,
* ``endpoint``: a url with a scheme of a service, or a host with a port.

A weak part is reported when its complements overlap its scope, the ``SCOPE`` code points before and
after it: a ``key`` needs an identifier (``access`` or ``ident``), an ``ident`` needs a secret
(``assign``, ``hex`` or ``key``), an ``endpoint`` needs both. Scopes and parts meet in an interval
join over the blocks of ``BLOCK`` code points they touch, as a semi join: a part is kept or not,
and no pairs arise. The rows of a block are bounded by its length.

Spans count code points, end exclusive. Null and empty texts have none. Rows with the same id and
text are worked on once and all get the result; null ids are ids like others. Long texts are matched whole; what is
found in them is dealt to blocks. Further columns
do not matter; an empty table gives an empty result. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common

SCOPE = 200
BLOCK = 1024
MASK = "[SECRET]"


@dataclass(frozen=True)
class Kind:
    """A pattern whose matches are the leftmost, non-overlapping ones.

    ``some`` is a cheap test that a text may hold a match. A match counts when its group ``group`` has ``least``
    or more characters and all patterns of ``also`` are found in it.
    """

    name: str
    pattern: str
    some: str
    group: int = 0
    least: int = 1
    also: tuple[str, ...] = ()


# Fixed values of the task: the base kinds. Runs that are too short hold no longer match within
# them, so a least length may stand in the pattern where the whole match is one run.
BASE = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i:passw|secret|token|api_?key)""",
        group=2,
        least=6,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Kind("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)
WEAK = (
    Kind("key", r"[A-Za-z0-9+/]{32,}={0,2}", r"[A-Za-z0-9+/]{32}", also=("[0-9]", "[a-z]", "[A-Z]")),
    Kind(
        "ident",
        r"""(?i:account|client|user|access[_-]?key)[_-]?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}""",
        r"(?i:(id|name)[\"']?\x20*[:=])",
    ),
    Kind(
        "endpoint",
        r"""(?:https?|s3|ftp|ssh|amqps?|jdbc:[a-z]+|postgres(?:ql)?|mongodb|redis)://[A-Za-z0-9._~%:@/?=&+-]+|[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}""",
        r"://|\.[a-z0-9-]+:[0-9]{2}",
    ),
)
KINDS = BASE + WEAK
IDENTIFIERS = ("access", "ident")
SECRETS = ("assign", "hex", "key")


def _matches(text: Column, number: int, kind: Kind) -> Column:
    """Entries (kind, index, code points since the last match, own code points, counts) of one kind."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda g: F.length(g))
    measured = whole if kind.group == 0 else F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    parts = F.arrays_zip(whole.alias("m"), gaps.alias("gap"), measured.alias("part"))

    def entry(x: Column, i: Column) -> Column:
        good = F.length(x["part"]) >= kind.least
        for pattern in kind.also:
            good = good & x["m"].rlike(pattern)
        return F.struct(
            F.lit(number).alias("kind"), i.alias("i"), x["gap"].alias("gap"), F.length(x["m"]).alias("size"), good.alias("good")
        )

    # The gap behind the last match has no match.
    found = F.filter(F.transform(parts, entry), lambda e: e["size"].isNotNull())
    return F.when(text.rlike(kind.some), found).otherwise(F.array().cast(_ENTRIES))


_ENTRIES = "array<struct<kind:int,i:int,gap:int,size:int,good:boolean>>"


def _key(rows: DataFrame) -> Column:
    return F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"))


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id``, the row key and the matches of all kinds, stored; every text is scanned once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[_matches(text, n, kind) for n, kind in enumerate(KINDS)])
    return common.stored(docs.select("doc_id", _key(docs).alias("key"), found.alias("found")), "secret-matches")


def _roles(names: tuple[str, ...]) -> list[int]:
    return [n for n, kind in enumerate(KINDS) if kind.name in names]


def parts(found: DataFrame) -> DataFrame:
    """``key``, ``kind``, ``start``, ``end`` of every match that counts, once per distinct text."""
    some = found.where(F.size("found") > 0).select("key", "found").dropDuplicates(["key"])
    rows = some.select("key", F.explode("found").alias("e")).select("key", "e.*")
    along = Window.partitionBy("key", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(along).cast("int")
    return rows.withColumn("end", end).where("good").select("key", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(found: DataFrame) -> DataFrame:
    """The base spans, and the weak ones whose complements are in their scope."""
    every = common.stored(parts(found), "secret-parts")
    weak = every.where(F.col("kind") >= len(BASE))
    scopes = weak.withColumns({"from": F.col("start") - SCOPE, "to": F.col("end") + SCOPE})
    scopes = scopes.withColumn("block", F.explode(_blocks(F.col("from"), F.col("to"))))
    placed = every.withColumn("block", F.explode(_blocks(F.col("start"), F.col("end"))))

    def beside(rows: DataFrame, kinds: list[int]) -> DataFrame:
        others = placed.where(F.col("kind").isin(kinds)).select(
            F.col("key").alias("k"), F.col("block").alias("b"), F.col("start").alias("s"), F.col("end").alias("e")
        )
        meets = (F.col("key") == F.col("k")) & (F.col("block") == F.col("b")) & (F.col("s") < F.col("to")) & (F.col("e") > F.col("from"))
        return rows.join(others, meets, "left_semi").select("key", "kind", "start", "end").distinct()

    def of(name: str) -> DataFrame:
        return scopes.where(F.col("kind").isin(_roles((name,))))

    keys = beside(of("key"), _roles(IDENTIFIERS))
    idents = beside(of("ident"), _roles(SECRETS))
    same = ["key", "kind", "start", "end"]
    endpoints = beside(of("endpoint"), _roles(IDENTIFIERS)).join(beside(of("endpoint"), _roles(SECRETS)), same, "left_semi")
    return every.where(F.col("kind") < len(BASE)).unionByName(keys).unionByName(idents).unionByName(endpoints)


def _blocks(start: Column, end: Column) -> Column:
    first = F.floor(F.greatest(start, F.lit(0)) / BLOCK).cast("int")
    return F.sequence(first, F.greatest(first, F.floor((end - 1) / BLOCK).cast("int")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` as text,
    ``found``: the spans as an array of (start, kind, end), and ``key``: the row's id and text hash."""
    common.small_batches(docs.sparkSession)
    seen = matches(docs.select(F.col("doc_id"), F.col(text).cast("string").alias("text")))
    grouped = (
        linked(seen)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans_found"))
        .select(F.col("key").alias("k"), "spans_found")
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = seen.select("doc_id", "key").join(grouped, F.col("key").eqNullSafe(F.col("k")), "left")
    rows = rows.withColumn("found", F.coalesce("spans_found", none))

    def count(n: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == n)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return rows.select(
        "doc_id",
        *[count(n).alias(f"n_{kind.name}") for n, kind in enumerate(BASE)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        "found",
        "key",
    )


def mask(text: Column, spans: Column, by: str = MASK) -> Column:
    """The text with every span replaced; overlapping or touching spans become one mark."""
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    # Before each merged span: the text since the one before; behind the last: the rest.
    starts = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text)))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring(text, x["a"] + 1, x["b"] - x["a"]))
    return F.when(F.size(spans) > 0, F.array_join(kept, by)).otherwise(text)


def masked(docs: DataFrame) -> DataFrame:
    """The documents with their secrets masked and ``n_chars``, where there is one, counted anew in changed texts."""
    found = scan(docs).select(F.col("key").alias("k"), F.col("found").alias("spans_found")).where(F.size("spans_found") > 0)
    own = common.numbered(docs)
    place = {name: f"col_{i}" for i, name in enumerate(docs.columns)}
    text = F.col(place["text"]).cast("string")
    key = F.struct(F.col(place["doc_id"]).alias("d"), F.xxhash64(text).alias("h"))
    rows = own.join(found.dropDuplicates(["k"]), key.eqNullSafe(F.col("k")), "left")
    hit = F.col("spans_found").isNotNull()
    rows = rows.withColumn("masked_text", F.when(hit, mask(text, F.col("spans_found"))).otherwise(text))
    new = {name: F.col(column) for name, column in place.items()} | {"text": F.col("masked_text")}
    if "n_chars" in place:
        counted = F.when(hit, F.length("masked_text")).otherwise(F.col(place["n_chars"]))
        new["n_chars"] = counted.cast(docs.schema["n_chars"].dataType)
    return rows.select(*[column.alias(name) for name, column in new.items()])
