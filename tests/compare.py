"""Compare a Spark result with a DuckDB result, order aside, values exact."""

from __future__ import annotations

import datetime as dt
import decimal


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def same_rows(df, duck, sql):
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(df.columns)
    right = [tuple(_plain(dict(zip(names, r))[c]) for c in order) for r in want.fetchall()]
    left = [tuple(_plain(v) for v in r) for r in df.select(*order).collect()]
    assert len(left) == len(right)
    left.sort(key=_key)
    right.sort(key=_key)
    for a, b in zip(left, right):
        assert a == b, dict(zip(order, zip(a, b)))
    return len(left)
