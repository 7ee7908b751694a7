import datetime as dt

from pyspark.sql import functions as F


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def rows(df, *cols):
    """Sorted plain tuples of the given columns."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def plan_text(df) -> str:
    """Formatted physical plan (what ``df.explain("formatted")`` prints)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def no_row(df):
    return df.limit(1).count() == 0


def ntz(s):
    return F.lit(s).cast("timestamp_ntz")
