"""Small tables with everything that may go wrong, for all corpus operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASHES = (
    "k0 key h size name range draw found spans copies taken target n_tokens token_ids decoded cells score kept rep node root sig "
    "row_hash row_key text_hash part v edits copy w total good host path rule ruling u t"
).split()

LOREM = "the quick brown fox jumps over the lazy dog while seven wizards mix potent liquor in a quiet valley near home".split()


def passage(n: int, start: int = 0) -> str:
    return " ".join(f"{LOREM[(start + i * 7) % len(LOREM)]}{(start * 31 + i) % 97}" for i in range(n))


TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "!!! 123 ...",
    "Ünïcödé \U0001f600 naïve\r\nline\x0bbreak\x0c",
    passage(120),
    passage(120),
    passage(119) + " changed",
    passage(80, 5) + "\npassword=abc123def456 token: 'zzzzzzzz'\n" + passage(5, 9),
    "x" * 5000,
    passage(6000, 11),
    "\n".join(["same line here"] * 40),
]


def documents(spark, clash: bool = False):
    rows = [(n, t, ("en", "fr", None)[n % 3], ("a", "b", None)[n % 3], len(t or "")) for n, t in enumerate(TEXTS)]
    rows += [(None, TEXTS[6], None, None, None), (None, None, None, None, None), (6, TEXTS[6], "en", "a", 1), (3, "one", "fr", "b", 3)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        for name in CLASHES:
            frame = frame.withColumn(name, F.lit("clash"))
    return frame


def empty(spark, schema: str | T.StructType = DOCUMENTS):
    return spark.createDataFrame([], schema)


def rows(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
