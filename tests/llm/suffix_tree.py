"""The suffix tree of small texts in memory, from exact counts by name: what the tables of ``pst`` are compared with."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import xxhash

from tillwright.llm.pst import DEPTH, DISCOUNT, STEP, Chunk, lookup

hashed = xxhash.xxh64_intdigest


def frequent(chunk: Chunk, least: float) -> list[bytes]:
    """The runs of 2 to DEPTH + 1 symbols that occur ``least`` times or more; the parts of a frequent run are frequent."""
    names, numbers, place = chunk.arrays()
    code = numbers.astype(np.int64)
    alive = np.bincount(numbers)[numbers] >= least
    found: list[bytes] = []
    for size in range(2, DEPTH + 2):
        at = np.flatnonzero(alive[1:] & alive[:-1] & (place[1:] >= size - 1)) + 1
        if not len(at):
            break
        pairs = code[at - 1] * (int(code.max()) + 1) + code[at]
        order = np.sort(pairs)
        first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
        often = order[first][np.diff(np.append(first, len(order))) >= least]
        slot, there = lookup(often, pairs)
        at, slot = at[there], slot[there]
        one = np.zeros(len(often), np.int64)
        one[slot] = at
        found += [b" ".join([names[k] for k in numbers[i - size + 1:i + 1]]) for i in one]
        alive = np.zeros(len(numbers), bool)
        alive[at] = True
        code[at] = slot
    return found


def code_of(run: bytes) -> int:
    """The code of a run: the sum of its hashed symbols times STEP to the power of their distance from its end, plus one."""
    return sum(hashed(w) * pow(int(STEP), k, 1 << 64) for k, w in enumerate(reversed(run.split(b" ")), 1)) % (1 << 64)


class Runs:
    """Codes of runs in order; the single words among them by name. The names of longer runs aren't held."""

    def __init__(self, words: list[bytes], longer: list[int] | np.ndarray):
        own = np.array([code_of(w) for w in words], np.uint64)
        self.codes = np.unique(np.concatenate([own, np.asarray(longer, np.uint64)]))
        slots = np.searchsorted(self.codes, own)
        self.single = dict(zip(words, slots.tolist()))
        self.hashes = np.zeros(len(self.codes), np.uint64)
        self.hashes[slots] = np.array([hashed(w) for w in words], np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Slots of single words, -1 for words that are in no run."""
        return np.array([self.single.get(w, -1) for w in words], np.int64)

    def ending(self, single: np.ndarray, place: np.ndarray) -> Iterator[np.ndarray]:
        """For sizes 1 to DEPTH + 1: the slots of the runs that end at each symbol, -1 for none. ``single``: the symbols' own slots."""
        yield single
        alive = np.flatnonzero(single >= 0)
        codes = np.zeros(len(single), np.uint64)
        codes[alive] = self.hashes[single[alive]] * STEP
        for size in range(2, DEPTH + 2):
            alive = alive[place[alive] >= size - 1]
            front = single[alive - (size - 1)]
            alive, front = alive[front >= 0], front[front >= 0]
            codes[alive] += self.hashes[front] * np.uint64(pow(int(STEP), size, 1 << 64))
            slot, there = lookup(self.codes, codes[alive])
            alive = alive[there]
            slots = np.full(len(single), -1)
            slots[alive] = slot[there]
            yield slots


@dataclasses.dataclass
class Tree:
    """Per run: as a context, the weight of its suffix (1 if it isn't retained); as context and next symbol, what it adds."""

    runs: Runs
    rest: np.ndarray
    adds: np.ndarray

    def log10(self, single: np.ndarray, place: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 P of every symbol given what stands before it; ``base``: their probabilities at the root."""
        found, before = base.copy(), None
        for ends in self.runs.ending(single, place):
            if before is not None:  # contexts one symbol shorter, which end before the symbol; the shortest come first
                at = np.flatnonzero((before[:-1] >= 0) & (place[1:] > 0)) + 1
                rest = self.rest[before[at - 1]]
                add = np.where(ends[at] >= 0, self.adds[ends[at]], 0.0)
                found[at] = np.where(rest < 1, found[at] * rest + add, found[at])
            before = ends
        return np.log10(found)


def grow(counts: dict[bytes, int], root: dict[bytes, float], gain: float) -> Tree:
    """The tree of exact counts of runs (single words too) and the root's probabilities of their words."""
    following: dict[bytes, list[tuple[bytes, int]]] = {}
    for run, n in counts.items():
        context, _, word = run.rpartition(b" ")
        if context and context in counts:
            following.setdefault(context, []).append((word, n))
    rest: dict[bytes, float] = {}
    adds: dict[bytes, float] = {}

    def probability(context: bytes, word: bytes) -> float:
        """P(word | longest retained suffix of context)."""
        while context and context not in rest:
            context = context.partition(b" ")[2]
        if not context:
            return root[word]
        return adds.get(context + b" " + word, 0.0) + rest[context] * probability(context.partition(b" ")[2], word)

    for context in sorted(following, key=lambda c: (c.count(b" "), c)):
        total, shorter = counts[context], context.partition(b" ")[2]
        own = {w: (n - DISCOUNT) / total for w, n in following[context]}
        left = 1 - sum(own.values())
        gained = sum(n * np.log((own[w] + left * p) / p) for w, n in following[context] for p in [probability(shorter, w)])
        gained += (total - sum(n for _, n in following[context])) * np.log(max(left, 1e-9))
        if gained >= gain:
            rest[context] = left
            adds |= {context + b" " + w: p for w, p in own.items()}
    names = sorted(counts, key=code_of)
    runs = Runs([r for r in names if b" " not in r], [code_of(r) for r in names])
    return Tree(runs, np.array([rest.get(r, 1.0) for r in names]), np.array([adds.get(r, 0.0) for r in names]))
