import math
import re


def by_event(df, *columns):
    """Column values in event order."""
    rows = sorted(df.select("event_id", *columns).collect(), key=lambda r: r["event_id"])
    return [r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in rows]


def same(a, b, digits=7):
    """Equal row sets, doubles compared after rounding."""

    def rows(df):
        plain = [
            tuple(round(v, digits) + 0.0 if isinstance(v, float) and not math.isnan(v) else v for v in r)
            for r in df.select(*sorted(df.columns)).collect()
        ]
        return sorted(plain, key=repr)

    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)


def exchanges(df):
    """Exchanges that rows pass: those of tables that are broadcast are left out."""
    found, inside = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(re.match(r"[\s:+\-]*", line)[0])
        if inside is not None and depth > inside:
            continue
        inside = depth if "BroadcastExchange" in line else None
        found += re.findall(r"\bExchange (\S+)\(", line)
    return found
