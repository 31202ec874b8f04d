"""Vocabularies of byte-pair encoders, and exact merging with a heap over a linked list."""

from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass, field

# Vocabularies that a worker keeps parsed.
KEPT_VOCABULARIES = 4
_PARSED: dict[bytes, Vocabulary] = {}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files of byte-level encoders.

    Fixed rule of the format: printable Latin-1 bytes stand for themselves, the others take the
    code points from 256 on in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """What merging needs: ids of tokens, and rank and result of every merge."""

    ids: dict[str, int]
    merges: dict[tuple[int, int], tuple[int, int]]  # (left, right) -> (rank, merged)
    specials: dict[str, int]
    end_of_word: str
    byte_ids: list[int] = field(default_factory=list)
    final_byte_ids: list[int] = field(default_factory=list)

    @property
    def tokens(self) -> list[str]:
        """Token text by id; special tokens included."""
        everything = {**self.ids, **self.specials}
        texts = [""] * (max(everything.values()) + 1)
        for token, number in everything.items():
            texts[number] = token
        return texts


def parse_vocabulary(content: bytes) -> Vocabulary:
    """A vocabulary from the bytes of a JSON tokenizer file; kept for the next tasks of the worker."""
    key = hashlib.blake2b(content).digest()
    if key not in _PARSED:
        described = json.loads(content)
        model = described["model"]
        ids = model["vocab"]
        merges = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            merges[ids[left], ids[right]] = rank, ids[left + right]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        while len(_PARSED) >= KEPT_VOCABULARIES:
            _PARSED.pop(next(iter(_PARSED)))
        _PARSED[key] = Vocabulary(
            ids=ids,
            merges=merges,
            specials={t["content"]: t["id"] for t in described["added_tokens"]},
            end_of_word=end,
            byte_ids=[ids[c] for c in letters],
            final_byte_ids=[ids[c + end] for c in letters],
        )
    return _PARSED[key]


def merge_symbols(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> tuple[list[int], int]:
    """Merge neighbours, lowest rank first and leftmost among equals, until none is left to merge.

    The symbols form a linked list over their first positions; the heap holds (rank, position) of
    neighbours. An entry is out of date if the pair at its position now has another rank. Returns
    the list as it stands, with -1 where a symbol went into its left neighbour, and the number of
    merges.
    """
    n = len(symbols)
    nxt = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i))
    heapq.heapify(heap)
    merged = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = nxt[i]
        if symbols[i] < 0 or j >= n:
            continue
        found = merges.get((symbols[i], symbols[j]))
        if not found or found[0] != rank:
            continue
        symbols[i], symbols[j] = found[1], -1
        merged += 1
        after = nxt[i] = nxt[j]
        if after < n:
            prev[after] = i
            found = merges.get((symbols[i], symbols[after]))
            if found:
                heapq.heappush(heap, (found[0], i))
        before = prev[i]
        if before >= 0:
            found = merges.get((symbols[before], symbols[i]))
            if found:
                heapq.heappush(heap, (found[0], before))
    return symbols, merged


def split_specials(text: str, specials: dict[str, int]) -> list[tuple[str, int | None]]:
    """(text between, id of the special token after it or None) in order."""
    parts = []
    rest = text
    while True:
        at, token = min(
            ((found, -len(s), s) for s in specials if (found := rest.find(s)) >= 0), default=(-1, 0, None)
        )[::2]
        if token is None:
            parts.append((rest, None))
            return parts
        parts.append((rest[:at], specials[token]))
        rest = rest[at + len(token):]
