"""Names of rows and of helper columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_name(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit name of a row by its id and whole text, so that rows which share an id, or
    have none, are told apart.  Rows of one name are copies of each other in both;
    a null text counts as empty, a null id is unlike any other."""
    name = F.col(doc_id).cast("string")
    prefix = F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.md5(F.concat(prefix, F.lit(" "), F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("binary")))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from
    ``columns`` (Spark's names are alike in any case) and from one another."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
