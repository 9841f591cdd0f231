"""Outside services (embedding and language models) as plain functions: pacing, retries, and where they plug in.

Nothing here calls a network. A provider is ``texts -> vectors`` or ``text -> reply``; it runs in the tasks, so pacing is
per task: divide a global rate by the number of tasks that run at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

#: Waits between the attempts of a call that was refused for its rate, in seconds.
WAITS = (60, 120, 240, 480)


def over_quota(error: Exception) -> bool:
    """Whether an error says that calls come too fast."""
    t = str(error).lower()
    return "429" in t or "quota" in t or "rate" in t


class Paced:
    """A call at most ``rpm`` times a minute, evenly spaced."""

    def __init__(self, call: Callable[..., Any], rpm: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.call, self.gap, self.clock, self.sleep, self.next = call, 60.0 / rpm, clock, sleep, 0.0

    def __call__(self, *args: Any) -> Any:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap
        return self.call(*args)


class Patient:
    """A call tried again after growing waits while it is refused for its rate; other errors go through at once."""

    def __init__(self, call: Callable[..., Any], waits: tuple[float, ...] = WAITS, sleep: Callable[[float], None] = time.sleep) -> None:
        self.call, self.waits, self.sleep = call, waits, sleep

    def __call__(self, *args: Any) -> Any:
        for wait in self.waits:
            try:
                return self.call(*args)
            except Exception as e:
                if not over_quota(e):
                    raise
                self.sleep(wait)
        return self.call(*args)
