"""Parameterised new-hire search.

User text never becomes SQL text: terms are bound as pattern literals
inside ``Column`` predicates.  Equality filters on the hire table are
plain predicates, so Catalyst pushes them below the employee join (and
into the scan); search predicates that read employee names stay above
the left join, where they must be.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, pg_concat, pg_like_text
from ..operators.joins import left_join

OUT = ["emp_id", "emp_full_name", "emp_manager_id", "manager_name"]


NAMES = ("first_name", "last_name")


def _role(employees: DataFrame, prefix: str, extra=()) -> DataFrame:
    """The employee columns that one role needs, under the role's prefix."""
    wanted = dict.fromkeys(["id", *NAMES, *extra])
    return employees.select(*[F.col(c).alias(prefix + c) for c in wanted])


def _with_employee(hires: DataFrame, employees: DataFrame, extra=()) -> DataFrame:
    return left_join(hires, _role(employees, "e_", extra), [("old_emp_id", "e_id")])


def _with_manager(cte: DataFrame, employees: DataFrame, extra=()) -> DataFrame:
    m = _role(employees, "m_", extra)
    return cte.join(m, cte["emp_manager_id"] == m["m_id"])  # inner: hires without a manager drop out


def search_hires(hires: DataFrame, employees: DataFrame, search_text: str | None = None,
                 pos_status: str | None = None, join_status: str | None = None,
                 zone: str | None = None) -> DataFrame:
    """Hires whose requisition number or linked employee's first/last
    name contains any space-separated term (case-insensitive; ``%``/``_``
    are wildcards, an empty term between two spaces matches any non-NULL
    value), AND the given equality filters; with the employee's and the
    manager's full names (NULL parts as empty)."""
    j = _with_employee(hires, employees)
    conds = []
    if search_text:  # NULL or '' means no search
        conds.append(contains_any(["req_num", "e_first_name", "e_last_name"], search_text.split(" ")))
    for col, val in (("req_status", pos_status), ("hire_status", join_status), ("zone", zone)):
        if val is not None:
            conds.append(F.col(col) == F.lit(val))
    if conds:
        j = j.where(reduce(and_, conds))
    cte = j.select(F.col("id").alias("emp_id"),
                   pg_concat(F.col("e_first_name"), " ", F.col("e_last_name")).alias("emp_full_name"),
                   F.col("manager_id").alias("emp_manager_id"))
    out = _with_manager(cte, employees)
    return out.select("emp_id", "emp_full_name", "emp_manager_id",
                      pg_concat(F.col("m_first_name"), " ", F.col("m_last_name")).alias("manager_name"))


# filter key -> (side, column, kind); side "hire", "employee" (inside the
# search CTE) or "manager" (after the manager join).  kind "eq" is
# equality, "like" a case-sensitive prefix match.
DEFAULT_SPEC = {
    "department": ("hire", "department", "eq"),
    "employee_last_name": ("employee", "last_name", "like"),
    "manager_first_name": ("manager", "first_name", "like"),
}
SEARCH_COLUMNS = (("hire", "name"), ("hire", "position"), ("employee", "first_name"), ("employee", "last_name"))
_PREFIX = {"hire": "", "employee": "e_", "manager": "m_"}


def _spec_pred(side: str, col: str, kind: str, value):
    c = F.col(_PREFIX[side] + col)
    if kind == "eq":
        return c == F.lit(value)
    if kind == "like":
        return c.like(pg_like_text(f"{value}%"))
    raise ValueError(f"unknown filter kind {kind!r}")


def search_hires_spec(hires: DataFrame, employees: DataFrame, search_text: str | None = None,
                      filters: dict | None = None, spec: dict | None = None) -> DataFrame:
    """The same search driven by a filter spec.  Terms are split on
    whitespace (empty terms dropped) and matched against the hire's name
    and position and the employee's names; spec filters on the hire or
    employee apply inside the search, manager filters after the manager
    join."""
    filters = filters or {}
    spec = spec or DEFAULT_SPEC
    of = {side: [col for key, (s, col, _) in spec.items() if key in filters and s == side]
          for side in ("employee", "manager")}
    j = _with_employee(hires, employees, of["employee"])
    conds = [_spec_pred(side, col, kind, filters[key])
             for key, (side, col, kind) in spec.items() if key in filters and side != "manager"]
    terms = (search_text or "").split()
    if terms:
        conds.append(contains_any([_PREFIX[s] + c for s, c in SEARCH_COLUMNS], terms))
    if conds:
        j = j.where(reduce(and_, conds))
    cte = j.select(F.col("id").alias("emp_id"),
                   pg_concat(F.col("e_first_name"), " ", F.col("e_last_name")).alias("emp_full_name"),
                   F.col("manager_id").alias("emp_manager_id"))
    out = _with_manager(cte, employees, of["manager"])
    mconds = [_spec_pred(side, col, kind, filters[key])
              for key, (side, col, kind) in spec.items() if key in filters and side == "manager"]
    if mconds:
        out = out.where(reduce(and_, mconds))
    return out.select("emp_id", "emp_full_name", "emp_manager_id",
                      pg_concat(F.col("m_first_name"), " ", F.col("m_last_name")).alias("manager_name"))
