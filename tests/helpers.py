"""Rows and plans of results, for the tests."""


def rows(df, *order):
    """The rows as tuples, sorted."""
    return sorted(map(tuple, df.collect()), key=repr)


def executed_plan(df) -> str:
    """The final physical plan, after AQE, of a run over the whole result."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
