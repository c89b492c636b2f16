"""Word shingles of texts as sorted sets of 64-bit hashes, computed in numpy inside tasks.

Words are runs of anything but ASCII white space, A-Z lower-cased.  A word's hash is a
polynomial over its bytes taken from running sums, so a batch of texts is hashed at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_powers.get("up", ())):
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of one piece."""
    raw = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUES[raw] * up[:len(raw)])])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], bytes]]:
    """(end of each text in the piece, bytes): texts joined up to the size, long ones cut between words."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if size and size + len(data) > PIECE_BYTES:
            yield _ends(waiting), b" ".join(waiting)
            waiting, size = [], 0
        while len(data) > PIECE_BYTES and (cut := _SPACE.search(data, PIECE_BYTES)):
            # A part that does not end its text has no end in the piece.
            yield [], data[:cut.start()]
            data = data[cut.start():]
        waiting.append(data)
        size += len(data) + 1
    if waiting:
        yield _ends(waiting), b" ".join(waiting)


def _ends(parts: list[bytes]) -> list[int]:
    return (np.cumsum([len(p) + 1 for p in parts]) - 1).tolist()


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    out: list[np.ndarray] = []
    open_: list[np.ndarray] = []
    for ends, data in _pieces(texts):
        starts, hashes = _hash_words(data)
        if not ends:
            open_.append(hashes)
            continue
        for part in np.split(hashes, np.searchsorted(starts, ends))[:-1]:
            out.append(np.concatenate([*open_, part]) if open_ else part)
            open_ = []
    return out


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    mixed = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for k in range(width):
        mixed = mix(mixed * np.uint64(_BASE) + words[k:k + len(mixed)])
    return mixed


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle."""
    out = []
    for words in word_hashes(texts):
        width = min(size, len(words))
        out.append(np.unique(window_hashes(words, width)) if width else np.zeros(0, np.uint64))
    return out
