"""What a Python worker has built once (an automaton, a dictionary) and other tasks can use again."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable
from typing import Any

_KEPT: OrderedDict[str, Any] = OrderedDict()


def once(key: str, make: Callable[[], Any], most: int = 4) -> Any:
    """``make()``, or what it gave this worker before; at most ``most`` things are kept."""
    if key not in _KEPT:
        _KEPT[key] = make()
        while len(_KEPT) > most:
            _KEPT.popitem(last=False)
    _KEPT.move_to_end(key)
    return _KEPT[key]
