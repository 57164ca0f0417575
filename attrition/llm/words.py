"""Words of texts in UTF-8: runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""

from __future__ import annotations

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c + 32 * (65 <= c <= 90) in _WORD else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in order (null or no words: none)."""
    return text.translate(_FOLD).split() if text else []
