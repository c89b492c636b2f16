"""Token ids of texts by a public tokenizer file, inside tasks.

Byte-level pre-tokenisation never joins a word with what stands before the blank or line end in
front of it.  So the ids of a text are those of its parts, cut before every blank and line
end, one after another.  Parts repeat a lot: each is encoded by the tokenizer once and looked up
afterwards, by two 64-bit hashes that are computed for a whole batch at a time, in a memo of
bounded size.  A text with a blank or line end before other white space or at its end, or with
other white space at its start, is encoded whole, as there a cut could fall inside a token.  So is a
text that holds an added token of the file, special ones included: as is the library's default, it
becomes the id of that token.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np

from jobtide.llm.common import keep_between_tasks
from jobtide.llm.shingles import mix, powers

MEMO_PARTS, RECENT_PARTS, POOL_IDS, PIECE_BYTES, LONG_BYTES = 1_500_000, 50_000, 12_000_000, 1 << 19, 1 << 21
_BLANK_RUN, _LINE_RUN, _CUT = re.compile(r" \s"), re.compile(r"\n\s"), re.compile(rb"[ \n]")
_BYTE_VALUES = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), np.uint64) | np.uint64(1)


def _unsafe(text: str) -> bool:
    return (
        text[-1:] in (" ", "\n") or (text[:1].isspace() and text[0] not in " \n")
        or _BLANK_RUN.search(text) is not None or _LINE_RUN.search(text) is not None)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Column:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self._data, self.size = np.zeros(1 << 12, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self._data):
            room = max(self.size + len(values), len(self._data) * 3 // 2)
            self._data = np.concatenate([self._data[:self.size], np.zeros(room - self.size, self._data.dtype)])
        self._data[self.size:self.size + len(values)] = values
        self.size += len(values)

    def values(self) -> np.ndarray:
        return self._data[:self.size]


class Encoder:
    """Ids of many texts at once, with a bounded memo of parts."""

    def __init__(self, path: str, memo_parts: int = MEMO_PARTS):
        from tokenizers import Tokenizer

        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        # No match in any text without added tokens.
        self._added = re.compile("|".join(added) or r"(?!)")
        vocabulary = self._tokenizer.get_vocab()
        # Byte-level files write a blank and a line end as these letters; they open a part.
        self._opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self._opens[[i for token, i in vocabulary.items() if token[0] in "ĠĊ"]] = True
        self._limit = memo_parts
        self._clear()

    def _clear(self) -> None:
        # Hashes of known parts, sorted, with their numbers; those of the last batches in a dict.
        self._keys, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._recent: dict[int, int] = {}
        self._checks, self._starts, self._lengths = _Column(np.uint64), _Column(np.int32), _Column(np.int32)
        self._pool = _Column(np.uint16 if len(self._opens) <= 1 << 16 else np.uint32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of sorted hashes, -1 for new ones."""
        at = np.minimum(np.searchsorted(self._keys, keys), max(len(self._keys) - 1, 0))
        found = np.full(len(keys), -1, np.int64)
        if len(self._keys):
            found = np.where(self._keys[at] == keys, self._numbers[at], found)
        absent = np.flatnonzero(found < 0)
        found[absent] = [self._recent.get(k, -1) for k in keys[absent].tolist()]
        return found

    def _remember(self, keys: np.ndarray) -> None:
        self._recent.update(zip(keys.tolist(), range(self._checks.size - len(keys), self._checks.size)))
        if len(self._recent) >= RECENT_PARTS:
            all_keys = np.concatenate([self._keys, np.fromiter(self._recent.keys(), np.uint64, len(self._recent))])
            numbers = np.concatenate([self._numbers, np.fromiter(self._recent.values(), np.int32, len(self._recent))])
            order = np.argsort(all_keys, kind="stable")
            self._keys, self._numbers, self._recent = all_keys[order], numbers[order], {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, np.uint32) for e in encoded]

    def _learn(self, keys: np.ndarray, checks: np.ndarray, parts: list[bytes]) -> None:
        """Encode new parts as one text; the ids of a part start where one opens a part.

        Parts from the start of a text stand behind a line end here, which has an id of its own.
        """
        bare = np.fromiter((p[0] not in b" \n" for p in parts), bool, len(parts))
        joined = b"".join(b"\n" + p if b else p for p, b in zip(parts, bare.tolist()))
        ids = self.whole([joined.decode("utf-8", "surrogatepass")])[0]
        starts = np.flatnonzero(self._opens[ids])
        if len(starts) != len(parts):
            raise ValueError("the tokenizer joins a blank with what stands before it")
        self._starts.extend(starts + bare + self._pool.size)
        self._lengths.extend(np.diff(starts, append=len(ids)) - bare)
        self._pool.extend(ids)
        self._checks.extend(checks)
        self._remember(keys)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, uint32."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        odd = [i for i, t in enumerate(texts) if _unsafe(t) or self._added.search(t)]
        for i, ids in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = ids
        skip = set(odd)
        runs: dict[int, list[np.ndarray]] = {}
        for owners, pieces in _pieces((i, t) for i, t in enumerate(texts) if i not in skip):
            for i, ids in zip(owners, self._by_parts(pieces)):
                runs.setdefault(i, []).append(ids)
        for i, found in runs.items():
            out[i] = found[0] if len(found) == 1 else np.concatenate(found)
        return out

    def _by_parts(self, pieces: list[bytes]) -> list[np.ndarray]:
        data = b"".join(pieces)
        raw = np.frombuffer(data, np.uint8)
        edges = np.cumsum([0] + [len(p) for p in pieces])
        opens = (raw == 0x20) | (raw == 0x0A)
        opens[edges[:-1][np.diff(edges) > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(raw))
        up, down = powers(len(raw) + 1)
        hashes = []
        for values in _BYTE_VALUES:
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values[raw] * up[:len(raw)])])
            hashes.append(mix((sums[ends] - sums[starts]) * down[starts]))
        keys, first, which = np.unique(hashes[0], return_index=True, return_inverse=True)
        checks = hashes[1][first]
        if self._checks.size > self._limit or self._pool.size > POOL_IDS:
            self._clear()
        at = self._find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            at[new] = np.arange(self._checks.size, self._checks.size + len(new))
            self._learn(keys[new], checks[new], [data[a:b] for a, b in spans])
        part_starts, lengths, pool = self._starts.values(), self._lengths.values(), self._pool.values()
        if (self._checks.values()[at] != checks).any() or (checks[which] != hashes[1]).any():
            # Two parts share a hash.
            return self.whole([p.decode("utf-8", "surrogatepass") for p in pieces])
        at = at[which]
        sizes = lengths[at].astype(np.int64)
        places = np.concatenate([[0], np.cumsum(sizes)])
        ids = pool[np.repeat(part_starts[at] - places[:-1], sizes) + np.arange(places[-1])].astype(np.uint32)
        cuts = places[np.searchsorted(starts, edges)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _pieces(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(owners, texts) of some hundred thousand bytes; a long text comes in several pieces, each
    from a blank or line end on."""
    owners, pieces, size = [], [], 0
    for i, text in texts:
        data = text.encode("utf-8", "surrogatepass")
        while len(data) > LONG_BYTES and (cut := _CUT.search(data, PIECE_BYTES)):
            owners.append(i)
            pieces.append(data[:cut.start()])
            yield owners, pieces
            owners, pieces, size, data = [], [], 0, data[cut.start():]
        owners.append(i)
        pieces.append(data)
        size += len(data)
        if size >= PIECE_BYTES:
            yield owners, pieces
            owners, pieces, size = [], [], 0
    if owners:
        yield owners, pieces


@cache
def encoder(path: str) -> Encoder:
    """One encoder per task process and file, as long as tasks that use it follow each other."""
    return Encoder(path)


keep_between_tasks("encoder", encoder.cache_clear)
