"""Recipient lists sorted by last name.

Per message, the To and Cc addresses are ordered by the last name taken from
the display name (ties keep their original position) and joined with ``'; '``.
Other recipient types keep their order.  A recipient list belongs to one mail
and is bounded by the mail system's recipient limit, so it is gathered per
(message, type) group and ordered with a native ``array_sort``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_name


SORTED_TYPES = ("To", "Cc")


def sorted_recipients(recipients: DataFrame, message_col: str = "message_id", type_col: str = "type",
                      position_col: str = "position") -> DataFrame:
    """message, type, recipient_count, reordered (a To or Cc list of more than
    one recipient), sorted_addresses."""
    is_sorted = F.col(type_col).isin(*SORTED_TYPES)
    name = F.when(is_sorted, last_name(F.col("name")))
    entries = F.struct(name.alias("ln"), F.col(position_col).alias("pos"), F.col("address").alias("addr"))
    g = recipients.groupBy(message_col, type_col).agg(
        F.count(F.lit(1)).alias("recipient_count"), F.array_sort(F.collect_list(entries)).alias("__sorted"))
    return g.select(message_col, type_col, "recipient_count",
                    (F.coalesce(is_sorted, F.lit(False)) & (F.col("recipient_count") > 1)).alias("reordered"),
                    F.array_join(F.transform("__sorted", lambda e: e["addr"]), "; ").alias("sorted_addresses"))
