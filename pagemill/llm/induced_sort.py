"""Induced sorting of suffixes with common-prefix values, in blocks that may lie on disk.

A suffix is placed by its first character and the place of the suffix behind it: from the sorted
suffixes that begin one character later, a queue keyed by the character gives the next layer. Its
tuples carry what neighbours have in common; the value of two tuples that become neighbours is one
more than the least value between them. Layer by layer the order goes from the end of the texts to
their start, so no text is compared with another.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

# Tuples of a block, and bytes of tuples that a queue holds before it writes blocks to its file.
BLOCK = 1 << 18
QUEUE_BYTES = 64 * 1024 * 1024
# Bytes of text beyond which texts lie in a file as well.
TEXT_BYTES = 128 * 1024 * 1024
NONE = np.iinfo(np.int32).max


class TextStore:
    """Rows of equal width, appended and then read by number; large ones lie in an unnamed file."""

    def __init__(self, width: int):
        self.width = width
        self.parts: list[bytes] = []
        self.held = 0
        self.file = None
        self.rows = 0

    def append(self, rows: np.ndarray) -> None:
        self.parts.append(rows.tobytes())
        self.held += rows.size
        self.rows += len(rows)
        if self.held >= TEXT_BYTES:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.writelines(self.parts)
            self.parts, self.held = [], 0

    def table(self) -> np.ndarray:
        if self.file is None:
            return np.frombuffer(b"".join(self.parts), np.uint8).reshape(self.rows, self.width)
        self.file.writelines(self.parts)
        self.file.flush()
        self.parts, self.held = [], 0
        return np.memmap(self.file, np.uint8, "r", shape=(self.rows, self.width))


class LayerQueue:
    """Tuples (number of the text, value in common with the tuple before) by first character.

    Tuples of one character leave in the order in which they came. Beyond `QUEUE_BYTES` blocks are
    written to an unnamed file, which goes with the queue.
    """

    def __init__(self, memory: int = QUEUE_BYTES):
        self.memory = memory
        self.buckets: dict[int, list] = {}
        self.held = 0
        self.file = None

    def push(self, character: int, numbers: np.ndarray, common: np.ndarray) -> None:
        self.buckets.setdefault(character, []).append((numbers, common))
        self.held += numbers.nbytes + common.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for blocks in self.buckets.values():
            for n, block in enumerate(blocks):
                if isinstance(block[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(block[0].tobytes())
                    self.file.write(block[1].tobytes())
                    blocks[n] = (at, len(block[0]))
        self.held = 0

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples, smallest character first, in blocks of bounded length."""
        numbers, common, held = [], [], 0
        for character in sorted(self.buckets):
            for block in self.buckets[character]:
                if not isinstance(block[0], np.ndarray):
                    at, count = block
                    self.file.seek(at)
                    block = (
                        np.frombuffer(self.file.read(4 * count), np.int32),
                        np.frombuffer(self.file.read(4 * count), np.int32),
                    )
                numbers.append(block[0])
                common.append(block[1])
                held += len(block[0])
                if held >= BLOCK:
                    yield np.concatenate(numbers), np.concatenate(common)
                    numbers, common, held = [], [], 0
        if held:
            yield np.concatenate(numbers), np.concatenate(common)


def induce(
    layer: Iterator[tuple[np.ndarray, np.ndarray]], first: Callable[[np.ndarray], np.ndarray], limit: int,
    memory: int = QUEUE_BYTES,
) -> LayerQueue:
    """The layer of the suffixes that begin one character before those of `layer`.

    `first(numbers)` is the character before each; 0 means that the text ends there, which is equal
    to nothing. Values in common are counted up to `limit`.
    """
    queue = LayerQueue(memory)
    # Least value since the last tuple of each character; the character is there once it has one.
    since: dict[int, int] = {}
    for numbers, common in layer:
        characters = first(numbers)
        order = np.argsort(characters, kind="stable")
        ordered = characters[order]
        cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        whole = int(common.min())
        present = set()
        for at, stop in zip(cuts, [*cuts[1:], len(ordered)]):
            character, places = int(ordered[at]), order[at:stop]
            present.add(character)
            if character == 0:
                queue.push(0, numbers[places], np.zeros(len(places), np.int32))
                continue
            least = np.minimum.reduceat(common[: places[-1] + 1], np.concatenate([[0], places[:-1] + 1]))
            value = np.minimum(least + 1, limit).astype(np.int32)
            value[0] = min(min(since[character], int(least[0])) + 1, limit) if character in since else 0
            queue.push(character, numbers[places], value)
            rest = common[places[-1] + 1 :]
            since[character] = int(rest.min()) if len(rest) else NONE
        for character in since.keys() - present:
            since[character] = min(since[character], whole)
    return queue


def later_ones(layer: Iterator[tuple[np.ndarray, np.ndarray]], length: int) -> Iterator[np.ndarray]:
    """Of the texts whose suffixes share `length` characters, all numbers but the smallest of each run."""

    def rest(parts: list[np.ndarray]) -> Iterator[np.ndarray]:
        run = np.concatenate(parts)
        if len(run) > 1:
            yield run[run != run.min()]

    open_run: list[np.ndarray] = [np.empty(0, np.int32)]
    for numbers, common in layer:
        starts = np.flatnonzero(common < length)
        if not len(starts):
            open_run.append(numbers)
            continue
        # What stands before the first start belongs to the run of the block before; the last run is open.
        yield from rest([*open_run, numbers[: starts[0]]])
        inner = numbers[starts[0] : starts[-1]]
        if len(inner):
            cuts = starts[:-1] - starts[0]
            least = np.repeat(np.minimum.reduceat(inner, cuts), np.diff([*cuts, len(inner)]))
            yield inner[inner != least]
        open_run = [numbers[starts[-1] :]]
    yield from rest(open_run)
