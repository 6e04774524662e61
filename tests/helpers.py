"""Order-insensitive comparison of result sets (as the driver compares)."""

from __future__ import annotations

import decimal
import math
from collections import Counter


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return repr(v)


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def same_result(df, duck, sql):
    cols, rows = spark_rows(df)
    res = duck.execute(sql)
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols), (cols, ocols)
    assert len(rows) == len(orows)
    a, b = multiset(cols, rows), multiset(ocols, orows)
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
    return rows
