"""Rows of two frames as comparable values: columns by name, numbers as floats, nulls and NaN alike."""

import math


def value(x):
    if x is None:
        return None
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return tuple(value(v) for v in x)
    if isinstance(x, bool) or isinstance(x, str) or isinstance(x, (bytes, bytearray)):
        return x
    try:
        f = float(x)
    except (TypeError, ValueError):
        return str(x)
    return None if math.isnan(f) else f


def spark_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(value(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(rel):
    at = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return sorted((tuple(value(r[i]) for i in at) for r in rel.fetchall()), key=repr)
