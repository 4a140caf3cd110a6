"""SQL surface: register DataFrames as temp views and run parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, views: dict[str, DataFrame], query: str,
            args: dict | None = None) -> DataFrame:
    """Run ``query`` over ``views``, which are registered only while it is
    analysed; a temp view of the session that has one of these names is put back
    afterwards. Values go in as named parameter markers (``:name``), never
    pasted into the text."""
    held = {name: spark.table(name) for name in views if _is_temp_view(spark, name)}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(query, args=args or None)
    finally:
        for name in views:
            if name in held:
                held[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _is_temp_view(spark: SparkSession, name: str) -> bool:
    return any(t.isTemporary and t.name.lower() == name.lower() for t in spark.catalog.listTables(pattern=name))


def in_list_markers(prefix: str, values) -> tuple[str, dict]:
    """``(:p0, :p1, ...)`` text plus the matching ``args`` for an IN list; an
    empty list gives ``(NULL)``, which matches nothing."""
    args = {f"{prefix}{i}": v for i, v in enumerate(values)}
    return "(" + (", ".join(f":{k}" for k in args) or "NULL") + ")", args
