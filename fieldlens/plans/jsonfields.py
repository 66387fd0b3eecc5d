"""Row <-> JSON field reshaping and time-zone repair: P11-P14.

Field metadata (field name, display name, source column) is usually a small
dimension.  If the plan's statistics prove it small it is attached to every
row as one array value (an uncorrelated scalar subquery, computed once);
otherwise the rows are dealt evenly over shares and each share meets that array
in an equi-join.  Both give the same result.

The reference aggregates all rows of a site into one array and validates
every element against every row of the site.  Here each source row gets
its own array and is validated against itself only; with one row per
site (the normal case) the results are identical, and a site with very
many rows never becomes one huge cell or a quadratic pairing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import iso_utc_text, local_to_utc, zone_name
from ..operators.joins import left_join, spare_names

SMALL_BYTES = 8 << 20
SALTS = 1024
ELEMENT_SCHEMA = "array<struct<field_name:string,value:string>>"


def _estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _with_metadata(rows: DataFrame, metadata: DataFrame, small_bytes: int) -> tuple[DataFrame, str]:
    """``rows`` with the metadata, ordered by column name, as one array; and the
    array's name.  Every result holds all metadata, so the array is never larger
    than a result.  Beyond ``small_bytes`` it is no literal of every task but one
    row for each of ``SALTS`` shares of the rows, which it meets by the share."""
    name, share, of = spare_names(rows.columns, "meta", "share", "of")
    entries = F.array_sort(F.collect_list(F.struct("column_name", "field_name", "field_display_name")))
    if _estimated_bytes(metadata) <= small_bytes:
        return rows.withColumn(name, metadata.select(entries).scalar()), name
    whole = metadata.agg(entries.alias(name)).select(name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(of))
    spread = rows.withColumn(share, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return spread.join(whole, spread[share] == whole[of]).drop(share, of), name


def _plain(col: Column, kind: T.DataType) -> Column:
    """Timestamps as JSON text has them, with a T; other values as they are."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.regexp_replace(col.cast("string"), " ", "T")
    return col


def _value_map(rows: DataFrame, cols) -> Column:
    return F.create_map(*[x for c in cols for x in (
        F.lit(c), _plain(F.col(f"`{c}`"), rows.schema[c].dataType).cast("variant"))])


def _text_map(rows: DataFrame, cols) -> Column:
    """The columns as the text that their JSON has."""
    def text(c):
        kind = rows.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.to_json(F.col(f"`{c}`"), {"ignoreNullFields": "false"})
        return _plain(F.col(f"`{c}`"), kind).cast("string")

    return F.create_map(*[x for c in cols for x in (F.lit(c), text(c))])


def build_field_json(rows: DataFrame, metadata: DataFrame, key: str = "site",
                     keep_row: bool = False, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """Per source row, a JSON array of ``{field_name,
    field_display_name, value, is_track_time: false}`` ordered by column
    name, where ``value`` is the row's value of the metadata's
    ``column_name`` (JSON null when the column is NULL or absent).

    Returns ``key, field_info`` (or all row columns plus ``field_info``
    with ``keep_row=True``, the input of :func:`validate_field_json`).
    """
    cols = rows.columns
    vmap = _value_map(rows, cols)
    with_meta, meta = _with_metadata(rows, metadata, small_bytes)
    arr = F.transform(meta, lambda m: F.struct(
        m["field_name"].alias("field_name"),
        m["field_display_name"].alias("field_display_name"),
        F.try_element_at(vmap, m["column_name"]).alias("value"),
        F.lit(False).alias("is_track_time")))
    info = F.to_json(arr, {"ignoreNullFields": "false"}).alias("field_info")
    keep = [F.col(f"`{c}`") for c in cols] if keep_row else [F.col(key)]
    return with_meta.select(*keep, info)


def validate_field_json(rows_with_json: DataFrame, metadata: DataFrame, key: str = "site",
                        json_col: str = "field_info") -> DataFrame:
    """Explode each row's field array, map field names back to
    columns through the metadata, and compare the element's value with
    the row's own value: NULL-safe, as JSON text, and by value for numeric
    columns.  A metadata column the row does not have is a ``MISMATCH``
    even though both sides are null.

    Output: key, column_name, original_value, json_value, validation_result.
    """
    cols = [c for c in rows_with_json.columns if c != json_col]
    fields = metadata.select(F.col("field_name").alias("__field"), "column_name")
    x = (rows_with_json
         .select(F.col(key), _text_map(rows_with_json, cols).alias("__vals"),
                 F.explode(F.from_json(json_col, ELEMENT_SCHEMA)).alias("__e"))
         .join(fields, F.col("__e.field_name") == F.col("__field")))
    orig = F.try_element_at("__vals", F.col("column_name"))
    jv = F.col("__e.value")
    present = F.map_contains_key("__vals", F.col("column_name"))
    # numeric source columns compare by value, so number text written by
    # another producer ('900' for 900.0, '1e3' for 1000.0) still matches
    numeric = [c for c in cols if isinstance(rows_with_json.schema[c].dataType, T.NumericType)]
    is_num = F.col("column_name").isin(*numeric) if numeric else F.lit(False)
    same_number = is_num & (orig.try_cast("double") == jv.try_cast("double"))
    same = orig.eqNullSafe(jv) | F.coalesce(same_number, F.lit(False))
    result = F.when(F.coalesce(present, F.lit(False)) & same, F.lit("MATCH")).otherwise(F.lit("MISMATCH"))
    return x.select(key, "column_name", orig.alias("original_value"), jv.alias("json_value"),
                    result.alias("validation_result"))


def field_time_to_utc(exec_rows: DataFrame, staff: DataFrame, field: str,
                      json_col: str = "project_data") -> DataFrame:
    """For rows whose JSON array contains ``field``, list the field's
    local time text, the staff member's zone label (matched by tech_id)
    and the time in UTC as ``YYYY-MM-DDTHH:MM:SSZ``.  Ambiguous local
    times read as standard time; unknown zones as UTC."""
    # an outer explode: Spark would guard an inner one with a parse of its own
    e = (exec_rows.select("tech_id", F.explode_outer(F.from_json(json_col, ELEMENT_SCHEMA)).alias("__e"))
         .where(F.col("__e.field_name") == F.lit(field)))
    st = staff.select(F.col("tech_id").alias("s_tech"), "time_zone")
    x = e.join(st, e["tech_id"] == st["s_tech"])
    v = F.col("__e.value")
    utc = iso_utc_text(local_to_utc(v.cast("timestamp_ntz"), zone_name(F.col("time_zone"))))
    return x.select("tech_id", "time_zone", v.alias("original_value"),
                    utc.alias("converted_value_utc_iso8601"))


def rewrite_field_time_to_utc(exec_rows: DataFrame, staff: DataFrame, field: str,
                              json_col: str = "project_data") -> DataFrame:
    """Post-image of the execution rows.  In rows that contain
    ``field`` and whose staff member (``staff_id = staff.id``) exists,
    every element of that field with a non-null value gets its value
    replaced by the UTC ISO-8601 text; all other elements (and all keys
    of the element) are kept.  Other rows are returned unchanged.
    Duplicate staff ids resolve to the smallest zone label."""
    zones = staff.groupBy(F.col("id").alias("s_id")).agg(F.min("time_zone").alias("s_zone"))
    # Text without the field's name (or an escape, which could spell it) is not parsed.
    may = F.col(json_col).contains(field) | F.col(json_col).contains("\\")
    s_id, s_zone, elems = spare_names(exec_rows.columns, "s_id", "s_zone", "elems")
    zones = zones.withColumnsRenamed({"s_id": s_id, "s_zone": s_zone})
    parsed = F.try_variant_get(F.try_parse_json(F.when(may, F.col(json_col))), "$", "array<map<string,variant>>")
    j = left_join(exec_rows, zones, [("staff_id", s_id)]).withColumn(elems, F.when(F.col(s_id).isNotNull(), parsed))
    touch = F.coalesce(F.exists(elems, lambda e: e["field_name"].cast("string") == F.lit(field)), F.lit(False))
    zone = zone_name(F.col(s_zone))

    def fix(e):
        name = e["field_name"].cast("string")
        val = e["value"].cast("string")
        utc = iso_utc_text(local_to_utc(val.cast("timestamp_ntz"), zone))
        replaced = F.map_concat(F.map_filter(e, lambda k, _: k != F.lit("value")),
                                F.create_map(F.lit("value"), utc.cast("variant")))
        return F.when((name == F.lit(field)) & val.isNotNull(), replaced).otherwise(e)

    new_json = F.when(touch, F.to_json(F.transform(elems, fix))).otherwise(F.col(json_col))
    return j.select(*[new_json.alias(c) if c == json_col else F.col(c) for c in exec_rows.columns])
