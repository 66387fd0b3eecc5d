"""Regenerate FIXTURES.md section 3 from fieldlens/sources/fixtures.py."""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fieldlens.sources.fixtures import RECIPES  # noqa: E402

INTRO = (
    "The recipes are the code in `fieldlens/sources/fixtures.py` (this section is generated from it by "
    "`tools/fixtures_doc.py`). Spark runs each through `spark.sql` with its inputs bound as `{name}` DataFrame "
    "arguments; the DuckDB oracle inlines the same text as CTEs (braces removed). `{ts}` is a timestamp literal: "
    "`timestamp_ntz` in Spark, `timestamp` in DuckDB; `{{`/`}}` are literal braces.\n\n"
    "Changes from the first survey draft, so that every registered query grows with the test tables and no recipe "
    "drops rows: `project_definition` derives from `part` (it was 25 nation rows; it now also carries "
    "`cycle_start_date`, invalid and NULL recurrences, rare `Global` scopes and empty scope lists); "
    "`project_execution_cycles` has one row per project, holding the exact next cycle for some projects and a "
    "cycle that never comes next for the rest; `staff_staging` keeps every staff row but gives some an emp_id "
    "that matches no master row; `fts_job_master` uses `month` for one job; `source_columns`/`target_columns` "
    "derive from `lineitem` (they were 4 literal rows; the target renames some tables and columns and changes "
    "some attributes, so every diff kind occurs); `recipients` groups 40 customers per message (bounded "
    "recipient lists; `% 40` made each list grow with the data).\n"
)


def main():
    path = os.path.join(ROOT, "FIXTURES.md")
    s = open(path).read()
    start, end = s.index("## 3. Recipes"), s.index("## 4. Parameters")
    body = ["## 3. Recipes", "", INTRO]
    for name, sql in RECIPES.items():
        body.append(f"```sql\n-- {name}\n{sql.strip()}\n```\n")
    open(path, "w").write(s[:start] + "\n".join(body) + "\n" + s[end:])


if __name__ == "__main__":
    main()
