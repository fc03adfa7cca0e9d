"""Small tables on a made-up day, with clock times as microseconds."""

from datetime import UTC, datetime, timedelta

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY0 = int(datetime(2024, 1, 10, tzinfo=UTC).timestamp()) * 1_000_000


def at(clock: str, day: int = 0) -> int:
    h, m = clock.split(":")
    return DAY0 + day * 24 * HOUR + int(h) * HOUR + int(m) * MINUTE


def clock(us: int) -> str:
    when = datetime(1970, 1, 1) + timedelta(microseconds=us)
    return f"{when.day - 10}d{when:%H:%M}"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())
