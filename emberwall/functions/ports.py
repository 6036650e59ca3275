from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberwall.functions.text import is_number

# Port classes and the first port above each of them.
STANDARD, REGISTERED, PRIVATE, NO_CLASS = (
    "standard-port", "registered-port", "private-port", "0",
)
FIRST_REGISTERED = 1024
FIRST_PRIVATE = 49152


def port_class(port: Column) -> Column:
    """Class of a port given as text; ``'0'`` for port 0, missing or not a number."""
    number = F.when(is_number(port), port.try_cast("double"))
    number = F.nanvl(number, F.lit(0.0))
    return (
        F.when(number >= FIRST_PRIVATE, PRIVATE)
        .when(number >= FIRST_REGISTERED, REGISTERED)
        .when(number > 0, STANDARD)
        .otherwise(NO_CLASS)
    )
