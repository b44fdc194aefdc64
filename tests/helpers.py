"""Small frames and plain-Python models that results are compared with."""

import datetime as dt

UTC = dt.timezone.utc


def at(text: str) -> dt.datetime:
    """A UTC instant from ISO text."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def wilder(bars, period):
    """ATR by a plain loop over (high, low, close)."""
    ranges, last = [], None
    for high, low, close in bars:
        ranges.append(high - low if last is None else max(high - low, abs(high - last), abs(low - last)))
        last = close
    out = [None] * len(ranges)
    if len(ranges) >= period:
        level = sum(ranges[:period]) / period
        out[period - 1] = level
        for i in range(period, len(ranges)):
            level = (level * (period - 1) + ranges[i]) / period
            out[i] = level
    return out


def missing_runs(seconds, step, origin=0):
    """Gaps by walking the whole grid, bucket by bucket."""
    present = {s - (s - origin) % step for s in seconds}
    runs, bucket = [], min(present)
    while bucket <= max(present):
        weekday = dt.datetime.fromtimestamp(bucket, UTC).weekday()
        if weekday < 5 and bucket not in present:
            if runs and runs[-1][1] == bucket:
                runs[-1][1] = bucket + step
            else:
                runs.append([bucket, bucket + step])
        bucket += step
    return [tuple(r) for r in runs]
