"""Progress of long driver-side loops, and run times that all rows of a run share."""

from __future__ import annotations

from datetime import UTC, datetime


def eta(done: int, total: int, seconds: float) -> str:
    """What is left at the speed so far, as 1h02m03s, 2m03s or 3s; a question mark before anything is done."""
    if done <= 0:
        return "?"
    left = max(0, round(seconds / done * (total - done)))
    hours, rest = divmod(left, 3600)
    minutes, rest = divmod(rest, 60)
    return f"{hours}h{minutes:02d}m{rest:02d}s" if hours else f"{minutes}m{rest:02d}s" if minutes else f"{rest}s"


def run_time() -> str:
    """Now in UTC, to be passed to a run once."""
    return datetime.now(UTC).isoformat(timespec="seconds")
