"""Words of a text, as bytes and as hashes.

A word is a run of ASCII letters and digits and of any characters beyond ASCII; A to Z
count as a to z. In UTF-8 those are the bytes of the letters and digits and all from 0x80.
"""

from __future__ import annotations

import re

import numpy as np

#: A word in the original text, before lower-casing.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_PRIME = 0x100000001B3
_SEGMENT = 1 << 20


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    return encoded(text).translate(_KEPT).split()


def normal(found: list[bytes]) -> str:
    """Words with a space before, between and after; one character a byte."""
    return (b" " + b" ".join(found) + b" ").decode("latin-1") if found else " "


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values, so that near inputs give unlike results."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_PRIME, _SEGMENT)
_DOWN = _powers(pow(_PRIME, -1, 1 << 64), _SEGMENT)


def _hashes(piece: np.ndarray) -> np.ndarray:
    """Hashes of the words of normal bytes: a polynomial of each word's own bytes."""
    inside = piece != 32
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    place = np.arange(len(piece)) % _SEGMENT
    terms = np.where(inside, piece, 0).astype(np.uint64) * _UP[place]
    return mixed(np.add.reduceat(terms, starts) * _DOWN[place[starts]])


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word, in order; long texts go piece by piece."""
    data = encoded(text).translate(_KEPT)
    out, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > _SEGMENT:
            cut = data.rfind(b" ", at, at + _SEGMENT)
            end = cut if cut > at else (data.find(b" ", at) if data.find(b" ", at) > 0 else end)
        out.append(_hashes(np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)))
        at = max(end, at + 1)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)
