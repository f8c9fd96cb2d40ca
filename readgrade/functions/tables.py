"""Small fixed tables as DataFrames."""

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return f"{value}L"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A local relation, so that Spark knows its exact size when it plans a join."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(f'`{c}`' for c in columns)})")
