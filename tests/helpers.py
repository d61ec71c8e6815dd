import math


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=sort_key)
