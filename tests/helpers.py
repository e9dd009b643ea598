from __future__ import annotations

from stratalake.schemas import TableSpec


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().treeString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def batch(spark, spec: TableSpec, *dicts):
    """A batch of text rows; columns left out are NULL."""
    schema = ", ".join(f"{c} string" for c in spec.batch_columns)
    return spark.createDataFrame([tuple(d.get(c) for c in spec.batch_columns) for d in dicts], schema)


def bronze(spark, spec: TableSpec, *dicts):
    names = spec.bronze_schema.names
    return spark.createDataFrame([tuple(d.get(c) for c in names) for d in dicts], spec.bronze_schema)
