"""What several test modules share besides fixtures."""

HOST = "gw.example"


def plan_of(df):
    """The physical plan as text, after adaptive execution where it ran."""
    return df._jdf.queryExecution().executedPlan().toString()
