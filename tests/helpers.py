"""Small helpers of the tests."""


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def plan(df):
    return df._jdf.queryExecution().toString()
