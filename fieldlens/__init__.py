"""fieldlens: field-service operations pipelines on Spark.

Every public pipeline takes DataFrames (plus plain Python parameters) and
returns DataFrames; all work is expressed with built-in Spark SQL
expressions so Catalyst can prune, push down and plan it.

Public API
----------
plans.severity     severity_summary (P1), severity_pivot (P2), to_json_rows (P3),
                   severity_trend (P4), manager_report / write_manager_report (P24),
                   closed_counts (shared input of P1/P2/P24)
plans.grid         daily_staff_summary (P5)
plans.search       search_hires (P6), search_hires_spec (P7)
plans.changes      staff_change_history (P8), apply_staging (P9), assign_by_date_range (P10)
plans.jsonfields   build_field_json (P11), validate_field_json (P12),
                   field_time_to_utc (P13), rewrite_field_time_to_utc (P14)
plans.projects     next_project_cycles (P15), project_skeleton (P16), advance_definitions (P17)
plans.jobs         job_slots (P18), apply_job_events (P19)
plans.quality      schema_diff_tables (P20), schema_diff_columns (P21), pair_diff_flags (P22),
                   long_values / long_value_findings (P23), recent_rows (P25)
plans.mail         sorted_recipients (P26)
sources            reference_data.state_master (P27), catalog (column catalogs, JDBC),
                   fixtures (domain tables derived from the test parquet)
streaming          job_ledger (P19 over a stream)
sql_functions      the reference's SQL table functions on Spark SQL
"""

__version__ = "0.1.0"
