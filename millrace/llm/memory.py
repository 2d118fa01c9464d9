"""What operators remember from task to task in a Python worker.

Spark's workers go on from one stage to the next. An operator that needs memory of its own lets go of what others have
remembered there; they fill it anew if they come back.
"""

from __future__ import annotations

from collections.abc import Callable

_caches: dict[str, Callable[[], None]] = {}


def remembers(operator: str, clear: Callable[[], None]) -> None:
    _caches[operator] = clear


def forget_others(operator: str) -> None:
    for name, clear in _caches.items():
        if name != operator:
            clear()
