"""Reading names in the change log: kinds of change, databases and tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSERT = "Insert"
UPDATE = "Update"
DELETE = "Delete"
NO_DML = "NoDML"

# The white space that is cut off around a statement's first word.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def first_word(event: Column) -> Column:
    """What comes before the first space, without other white space around it."""
    return F.btrim(F.split_part(event, F.lit(" "), F.lit(1)), F.lit(WHITE_SPACE))


def word_kind(word: Column) -> Column:
    """Kind of change by first word: of a statement (any case) or the name of a rows event (exact case)."""
    lower = F.lower(word)
    return (
        F.when((lower == "insert") | word.startswith("WriteRows"), INSERT)
        .when((lower == "update") | word.startswith("UpdateRows"), UPDATE)
        .when((lower == "delete") | word.startswith("DeleteRows"), DELETE)
        .otherwise(NO_DML)
    )


def classify_dml(event: Column) -> Column:
    return word_kind(first_word(event))


def name_matches(name: Column, pattern: str) -> Column:
    """Case-insensitive: the whole name, or its beginning when the pattern ends in ``*``."""
    if not pattern:
        raise ValueError("a name pattern must not be empty")
    pattern = pattern.lower()
    if pattern == "*":
        return name.isNotNull()
    if pattern.endswith("*"):
        return F.lower(name).startswith(pattern[:-1])
    return F.lower(name) == pattern


def table_matches(database: Column, table: Column, database_pattern: str, table_pattern: str) -> Column:
    return name_matches(database, database_pattern) & name_matches(table, table_pattern)
