"""Name conversions as column expressions; no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _head(name: Column) -> Column:
    return F.substring(name, 1, 1)


def _tail(name: Column) -> Column:
    return F.substring(name, 2, 2**31 - 1)


def to_snake(name: Column) -> Column:
    """``helloWorld`` -> ``hello_world``; null and empty give an empty string.

    After the first character, every character that has no other upper-case
    form gets an underscore before it, unless it is a digit or an underscore:
    ``a-b`` -> ``a_-b``. Letters go through upper case on the way to lower
    case, so ``ß`` becomes ``ss``.
    """
    # Upper case is applied piece by piece: Spark drops it from lower(upper(x)).
    marked = F.transform(
        F.split(_tail(name), ""),
        lambda c: F.when(
            (c == F.upper(c)) & ~c.rlike(r"^[\p{Nd}_]?$"), F.concat(F.lit("_"), c)
        ).otherwise(F.upper(c)),
    )
    spread = F.concat(F.upper(_head(name)), F.array_join(marked, ""))
    # In ASCII only small letters have another upper case: one pattern does it all.
    ascii_only = F.concat(_head(name), F.regexp_replace(_tail(name), "([^a-z0-9_])", "_$1"))
    short = name.rlike(r"^\p{ASCII}*$")
    return F.coalesce(F.lower(F.when(short, ascii_only).otherwise(spread)), F.lit(""))


def to_camel(name: Column, first_upper: bool = False) -> Column:
    """``hello_world`` -> ``helloWorld``, or ``HelloWorld`` with ``first_upper``.

    Empty pieces are skipped. A name without underscores keeps everything but
    the case of its first letter. Null and empty give an empty string.
    """
    head_case = F.upper if first_upper else F.lower
    plain = F.concat(head_case(_head(name)), _tail(name))

    def piece(text: Column, position: Column) -> Column:
        capital = F.concat(F.upper(_head(text)), F.lower(_tail(text)))
        if first_upper:
            return capital
        return F.when(position == 0, F.lower(text)).otherwise(capital)

    pieces = F.filter(F.split(name, "_"), lambda p: p != "")
    joined = F.array_join(F.transform(pieces, piece), "")
    converted = F.when(F.contains(name, F.lit("_")), joined).otherwise(plain)
    return F.coalesce(converted, F.lit(""))


def qualified_name(name: Column, default_database: str) -> Column:
    """Struct ``(database, table)``; a name without a dot gets the default database."""
    dotted = F.instr(name, ".") > 0
    part = lambda i: F.split_part(name, F.lit("."), F.lit(i))
    return F.struct(
        F.when(dotted, part(1)).otherwise(F.lit(default_database)).alias("database"),
        F.when(dotted, part(2)).otherwise(name).alias("table"),
    )
