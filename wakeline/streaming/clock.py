"""Times of rows that stateful processors emit."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def moment(millis: int) -> datetime:
    """The event time of an emitted row, from epoch milliseconds; it carries its zone, so the session's does not matter."""
    return _EPOCH + timedelta(milliseconds=millis)
