"""What a Python worker keeps from one task to the next: of one kind of operator at a time.

A worker outlives its tasks and the operators that ran in it. Tables of powers and opened bitmaps serve
all operators on words, unit caches those on tokens; when a worker turns from one kind to the other,
what the first left is dropped and its memory is given back."""

from __future__ import annotations

import ctypes
import gc
from typing import Any

WORDS, TOKENS = "words", "tokens"

_KEPT: dict[str, dict[str, Any]] = {}


def of(kind: str) -> dict[str, Any]:
    """What is kept for operators of this kind; others' is dropped."""
    if kind not in _KEPT:
        others = bool(_KEPT)
        _KEPT.clear()
        _KEPT[kind] = {}
        if others:
            gc.collect()
            give_back()
    return _KEPT[kind]


def give_back() -> None:
    """Free memory to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
