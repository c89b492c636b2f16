"""Plain Python versions of the operators' results."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def confirmed(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, text) if confirmed(k, m.group())]


def shingles(text: str | None, size: int) -> frozenset:
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def groups(rows: list[tuple[int | None, str | None]], size: int, percent: int) -> list[int | None]:
    """component_id of each row, over all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)].append(name)
    return [min(least[find(i)], default=None) if sets[i] else rows[i][0] for i in range(len(rows))]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def tokens(texts: list[str]) -> list[list[int]]:
    from tokenizers import Tokenizer

    from jobtide.llm.tokens import default_tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
