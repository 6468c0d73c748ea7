"""Physical plans as text."""


def plan_of(df) -> str:
    """The formatted physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
