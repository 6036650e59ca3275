from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a float literal looks like in text; Spark's own cast also takes "12d".
NUMBER = r"^\s*[+-]?(?i:(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def fields_of(line: Column, count: int) -> Column:
    """The first ``count`` comma-separated fields; anything after them is one rest."""
    return F.split(line, ",", count + 1)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def whitespace_to_null(text: Column) -> Column:
    return F.when(~text.rlike(r"^\s*$"), text)


def is_number(text: Column) -> Column:
    return text.rlike(NUMBER)


def options_list(text: Column) -> Column:
    return F.split(text, ";")


def options_text(text: Column) -> Column:
    """The options as Spark prints a list of them: ``[mss, nop]``."""
    return F.concat(F.lit("["), F.replace(text, F.lit(";"), F.lit(", ")), F.lit("]"))


def json_struct(payload: Column, names: Sequence[str]) -> Column:
    """Keys of a JSON text as a struct of texts."""
    kind = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return F.from_json(payload, kind)
