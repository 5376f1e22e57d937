"""Words of a text as bytes, split in C; used inside tasks only."""

from __future__ import annotations

#: a-z, 0-9 and every byte of a character beyond ASCII make words; A-Z is lower-cased first.
_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def flat(text: bytes) -> bytes:
    """The text with A-Z lower-cased and one blank for every byte that is in no word; same length."""
    return text.translate(_KEPT)


def words_of(text: bytes | None) -> list[bytes]:
    """The words; a null text has none."""
    return text.translate(_KEPT).split() if text else []


_WORKER: dict[str, object] = {}


def kept(key: str, make):
    """What `make` returns, kept by a Python worker from task to task: one object, so memory has the bound of one."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]
