"""Text expressions with PostgreSQL / VBA semantics, built from Spark functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _val(c) -> Column:
    """A Column as is, a str as a literal."""
    return c if isinstance(c, Column) else F.lit(c)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pg_concat(*parts) -> Column:
    """PostgreSQL ``CONCAT``: NULL arguments count as empty, result never NULL.

    Strings are literals; pass ``F.col`` for columns.
    """
    return F.concat(*[F.coalesce(_val(p).cast("string"), F.lit("")) for p in parts])


def pipe_concat(*parts) -> Column:
    """PostgreSQL ``||``: any NULL makes the result NULL (Spark ``concat``)."""
    return F.concat(*[_val(p).cast("string") for p in parts])


def pg_split(col, delimiter: str) -> Column:
    """PostgreSQL ``string_to_array(s, d)``.

    NULL stays NULL, ``''`` is an empty array, empty parts are kept and
    nothing is trimmed.  The delimiter is literal text, not a regex.
    """
    c = _col(col)
    if delimiter == "":
        # an empty delimiter leaves the whole text as one element
        return F.when(c.isNull(), F.lit(None)).when(c == "", F.array().cast("array<string>")).otherwise(F.array(c))
    pattern = "\\Q" + delimiter + "\\E"
    return (F.when(c.isNull(), F.lit(None))
            .when(c == "", F.array().cast("array<string>"))
            .otherwise(F.split(c, pattern, -1)))


def pg_like_text(term: str) -> str:
    """Convert a PostgreSQL LIKE fragment to the form Spark accepts.

    PostgreSQL treats ``\\x`` as a literal ``x`` for any ``x``; Spark only
    accepts the escape before ``%``, ``_`` and ``\\``.  ``%``/``_`` stay
    wildcards, as in PostgreSQL.  A trailing escape is an error in both.
    """
    out, i = [], 0
    while i < len(term):
        ch = term[i]
        if ch == "\\":
            if i + 1 == len(term):
                raise ValueError("LIKE pattern must not end with escape character")
            nxt = term[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
        else:
            out.append(ch)
            i += 1
    return "".join(out)


def contains_any(cols, terms) -> Column:
    """OR over terms of (OR over cols of ``col ILIKE '%' || term || '%'``);
    NULL cells never match.  The whole pattern is converted, so a term
    ending in a backslash escapes the closing ``%`` as in PostgreSQL."""
    preds = [_col(c).ilike(pg_like_text(f"%{t}%")) for t in terms for c in cols]
    return reduce(or_, preds)


def severity_bucket(col="severity") -> Column:
    """``'5+'`` above 5, else the number as text (NULL stays NULL)."""
    c = _col(col)
    return F.when(c > 5, F.lit("5+")).otherwise(c.cast("string"))


def last_name(col) -> Column:
    """Last name from a display name.

    ``"Last, First"`` gives the trimmed text before the first comma;
    otherwise the trimmed last blank-separated part when there are at
    least two parts, else the name itself.  Only blanks are trimmed.
    """
    c = _col(col)
    parts = F.split(c, " ", -1)
    return (F.when(F.instr(c, ",") > 0, F.trim(F.split(c, ",", -1).getItem(0)))
            .when(F.size(parts) >= 2, F.trim(F.element_at(parts, -1)))
            .otherwise(c))
