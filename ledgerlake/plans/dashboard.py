"""Dashboard queries over a gold table.

A dashboard spec is a plain dict ``{"charts": [{"id", "type", "title", "sql"}], ...}``
(in the reference an external service writes it; here it is an input).  Each chart's
SQL runs with ``spark.sql`` against the gold table bound as the parameter
``{df_facts}``, so it stays a distributed DataFrame; only chart-sized results are ever
collected by a caller.  Filters are applied to the input DataFrame *before* the chart
SQL, with values bound as literals (never spliced into SQL text).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS_PARAM = "df_facts"


def parse_spec(text: str) -> dict:
    """Parse and check a dashboard spec given as JSON text."""
    import json
    spec = json.loads(text)
    charts = spec.get("charts")
    if not isinstance(charts, list) or not charts:
        raise ValueError("spec needs a non-empty 'charts' list")
    for c in charts:
        missing = {"id", "type", "sql"} - set(c)
        if missing:
            raise ValueError(f"chart {c.get('id')!r} lacks {sorted(missing)}")
        if c["type"] not in ("bar", "line", "pie"):
            raise ValueError(f"chart type {c['type']!r} is not supported")
    spec.setdefault("summary", "")
    spec.setdefault("recommendations", "")
    return spec


def category_filter(df: DataFrame, value: str | None, column: str = "category") -> DataFrame:
    """keep rows whose category contains ``value`` as literal text; a mart without
    categories is not filtered."""
    if not value or column not in df.columns:
        return df
    return df.filter(F.col(column).contains(F.lit(value)))


def date_filter(df: DataFrame, start=None, end=None,
                column: str = "transaction_month") -> DataFrame:
    """inclusive date range on the month column (either bound optional); a mart
    without months is not filtered."""
    if column not in df.columns:
        return df
    c = F.col(column)
    if start is not None:
        df = df.filter(c >= F.lit(start))
    if end is not None:
        df = df.filter(c <= F.lit(end))
    return df


def drilldown(df: DataFrame, value: str) -> DataFrame:
    """rows whose first column, as text, equals the clicked value."""
    return df.filter(F.col(f"`{df.columns[0]}`").cast("string") == F.lit(str(value)))


def _bind(sql: str) -> str:
    if "{" + FACTS_PARAM + "}" in sql:
        return sql
    return re.sub(rf"\b{FACTS_PARAM}\b", "{" + FACTS_PARAM + "}", sql)


def chart_frame(spark: SparkSession, sql: str, facts: DataFrame) -> DataFrame:
    """Run one chart query against the bound gold table.  It is parsed as a subquery, where
    only a query can stand: a command, or more than one statement, does not parse."""
    return spark.sql(f"SELECT * FROM (\n{_bind(sql)}\n)", **{FACTS_PARAM: facts})


def run_dashboard(spark: SparkSession, facts: DataFrame, spec: dict, *,
                  category: str | None = None, start=None, end=None,
                  clicked: str | None = None) -> dict[str, DataFrame]:
    """``{chart id: DataFrame}``; filters first, then each chart's SQL, then the
    optional drill-down on each chart's own first column.  Charts are aggregates, so
    their size is the number of groups."""
    base = date_filter(category_filter(facts, category), start, end)
    out = {}
    for chart in spec["charts"]:
        frame = chart_frame(spark, chart["sql"], base)
        out[chart["id"]] = frame if clicked is None else drilldown(frame, clicked)
    return out
