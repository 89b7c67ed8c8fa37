"""Tokenising and cleaning of text columns.

Two tokenisers exist and differ on purpose: the word counts split on single spaces (a tab
joins two words once cleaned), the line cleaner splits on any white space.

Cleaning runs once over a whole cell, not once per token: lower-casing and dropping
characters neither add nor remove a separator, so the tokens are the same and the regular
expression engine is started once per row instead of once per word.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Without the (?U) flag \s knows ASCII only; with it the class holds every code
# point of white space. A word character is any letter, number or underscore.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f"
START_MARKER = "*** START"
END_MARKER = "*** END"


def lines(text: Column) -> Column:
    """The lines of a text, in order; a carriage return before a line break belongs to the break."""
    return F.split(text, "\r?\n")


def line_count(text: Column) -> Column:
    """Number of lines, without building them."""
    return F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1


def raw_tokens(text: Column) -> Column:
    """Tokens between single spaces, line by line; empty tokens are kept."""
    # Splitting on one plain character avoids the regular expression engine.
    one_line = F.replace(F.replace(text, F.lit("\r\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.split(one_line, " ")


def clean_token(token: Column) -> Column:
    """Lower case, letters, numbers and underscore only."""
    return F.regexp_replace(F.lower(token), f"[^{WORD}]+", "")


def clean_tokens(text: Column) -> Column:
    """All of ``raw_tokens`` after ``clean_token``; may contain empty ones."""
    return raw_tokens(F.regexp_replace(F.lower(text), f"[^{WORD} \n]+", ""))


def white_space_tokens(text: Column) -> Column:
    """Tokens between runs of white space, none empty."""
    return F.array_remove(F.split(text, f"(?U)[{SPACE}]+"), "")


def clean_line_words(line: Column, stop_words: Iterable[str] = ()) -> Column:
    """Cleaned words of a line (white-space tokeniser), without stop words."""
    cleaned = F.regexp_replace(F.lower(line), f"(?U)[^{WORD}{SPACE}]+", "")
    tokens = F.split(cleaned, f"(?U)[{SPACE}]+")
    dropped = ["", *stop_words]
    return F.filter(tokens, lambda word: ~word.isin(dropped))


def clean_line(line: Column, stop_words: Iterable[str] = ()) -> Column:
    """The cleaned words joined by one space; empty when no word is left."""
    return F.array_join(clean_line_words(line, stop_words), " ")


def split_apostrophes(text: Column) -> Column:
    """French elisions become two words."""
    return F.translate(text, "'’", "  ")


def has_markers(text: Column) -> Column:
    """Whether both boilerplate markers start some line of the text."""
    framed = F.concat(F.lit("\n"), text)
    return (F.locate("\n" + START_MARKER, framed) > 0) & (F.locate("\n" + END_MARKER, framed) > 0)


def between_markers(text: Column) -> Column:
    """Lines strictly between the first start-marker line and the first end-marker line.

    Null when nothing lies between them. The text is scanned in place, so a long book
    needs no array of lines and no row numbers.
    """
    framed = F.concat(F.lit("\n"), text)
    start = F.locate("\n" + START_MARKER, framed)
    end = F.locate("\n" + END_MARKER, framed)
    # Text after the start marker up to the end marker, then without the rest of its own line.
    inside = F.substring(framed, start + 1, end - start - 1)
    newline = F.instr(inside, "\n")
    body = F.substring(inside, newline + 1, F.length(inside))
    return F.when((end > start) & (newline > 0), body)
