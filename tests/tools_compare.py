"""Order-insensitive row comparison shared by the tests (floats to 9 significant digits)."""
import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return float(f"{v:.9g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


def same_rows(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    return canon(a) == canon(b)
