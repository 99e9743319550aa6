"""Text of physical plans, for assertions on what a query would do at scale."""


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with; runs the query."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(text):
    return text.count("Exchange hashpartitioning") - text.count("ReusedExchange")
