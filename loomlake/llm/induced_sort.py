"""External induced sorting of suffixes, in whole arrays.

Suffixes are typed L (larger than their successor) or S (smaller); an S suffix after an L one is S*. The S* suffixes are
sorted by naming the stretches between them and sorting the string of names: by recursion while it is long, else in
memory by doubling. From them two sweeps induce the rest. A sweep takes the buckets of first symbols in order; what a
bucket holds arrives in order, so its predecessors can be handed on to their buckets in one step per batch. The
queues between buckets carry (position, common prefix with the entry queued before) and go to an unnamed scratch file of
the task when they outgrow ``memory``; the file vanishes with the task, and a task that is lost starts anew.

Common prefixes: of two entries handed on one after the other, 1 + the least common prefix among the entries scanned
between them, a range minimum; where the L and the S part of a bucket meet, the shorter run of the bucket's symbol.
They are counted up to CAP.

The string has symbol 0 at its end and wherever a piece ends; no two ends are equal, they are ordered by position, and
no common prefix reaches beyond one. Order is exact to ``depth`` symbols; beyond it neighbours are in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

CAP = 255
PAD = np.uint64(0xFF)


class Queues:
    """First-in first-out queues of (position, common prefix), one for each symbol, backed by a scratch file."""

    def __init__(self, memory: int):
        self.memory, self.used, self.file = memory, 0, None
        self.held: dict[int, list] = {}

    def push(self, symbol: int, at: np.ndarray, prefix: np.ndarray) -> None:
        self.held.setdefault(symbol, []).append((at, prefix))
        self.used += at.nbytes + prefix.nbytes
        if self.used > self.memory:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.held.values():
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    start = self.file.tell()
                    for x in part:
                        self.file.write(x.tobytes())
                    parts[i] = (start, len(part[0]), part[0].dtype)
        self.used = 0

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            return part
        start, n, kind = part
        self.file.seek(start)
        at = np.frombuffer(self.file.read(n * kind.itemsize), kind)
        return at, np.frombuffer(self.file.read(n), "u1")

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that the queue of ``symbol`` holds now, in order; the queue is empty afterwards."""
        parts = [self._load(x) for x in self.held.pop(symbol, ())]
        if not parts:
            return None
        return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])


def range_least(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(x[first : last + 1]) for each pair, first <= last."""
    table, levels = [x], int((last - first + 1).max()).bit_length() if len(first) else 0
    for k in range(1, levels):
        half = 1 << (k - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]) if len(table[-1]) > half else table[-1][:0])
    level = np.frexp(last - first + 1)[1] - 1
    out = np.empty(len(first), x.dtype)
    for k in range(levels):
        use = level == k
        if use.any():
            out[use] = np.minimum(table[k][first[use]], table[k][last[use] - (1 << k) + 1])
    return out


def refine(rank: np.ndarray, key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Split groups of equal rank by ``key`` among the entries ``at``, in place; returns the entries still tied.

    A rank is the number of entries in smaller groups; ``at`` must hold whole groups.
    """
    old = rank[at]
    order = np.argsort(key)  # ties get one rank, so they may come in any order
    if len(old) and (old != old[0]).any():
        sorted_ = key[order]
        place = np.empty(len(at), "i8")
        place[order] = np.cumsum(np.concatenate([[False], sorted_[1:] != sorted_[:-1]]))
        order = np.argsort(old.astype("i8") << 32 | place)
    at, key, old = at[order], key[order], old[order]
    group = np.concatenate([[True], old[1:] != old[:-1]])
    first = group | np.concatenate([[True], key[1:] != key[:-1]])
    places = np.arange(len(at))
    head = np.maximum.accumulate(np.where(group, places, 0))
    own = np.maximum.accumulate(np.where(first, places, 0))
    rank[at] = old + own - head
    return at[~(first & np.concatenate([first[1:], [True]]))]


def _stretch_ranks(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of text[start : end + 1] in the order that S* stretches need: a proper prefix comes after what it begins."""
    rank, tied, size = np.zeros(len(starts), "i8"), np.arange(len(starts)), ends - starts + 1
    if text.dtype == np.uint8:
        wide = np.concatenate([text, np.full(8, 255, "u1")])
        step = 8
    else:
        step = 1
    done = 0
    while len(tied):
        left = size[tied] - done
        if not (left > 0).any():
            break
        at = np.minimum(starts[tied] + done, len(text) - 1)
        if step == 8:
            word = np.zeros(len(tied), "u8")
            for b in range(8):
                word = word << np.uint64(8) | np.where(left > b, wide[at + b], PAD).astype("u8")
        else:
            word = np.where(left > 0, text[at], np.iinfo("i8").max)
        tied = refine(rank, word, tied)
        done += step
    return rank


def _doubled(rank: np.ndarray, depth: int) -> np.ndarray:
    """Suffix ranks of a string given the ranks of its symbols, exact to ``depth`` symbols."""
    rank, reach = rank.copy(), 1
    tied = np.argsort(rank)
    same = rank[tied][1:] == rank[tied][:-1]
    tied = tied[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    while len(tied) and reach < depth:
        after = tied + reach
        key = np.where(after < len(rank), rank[np.minimum(after, len(rank) - 1)], -1)
        tied, reach = refine(rank, key, tied), 2 * reach
    return rank


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S, length of the run of equal symbols that starts here); ends (symbol 0) are S and runs of their own."""
    n = len(text)
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (text[1:] == 0)])
    first = np.flatnonzero(new)
    symbol = text[first]
    small = np.concatenate([symbol[:-1] < symbol[1:], [True]]) | (symbol == 0)
    length = np.diff(np.concatenate([first, [n]]))
    run = np.repeat(first + length, length) - np.arange(n)
    return np.repeat(small, length), np.minimum(run, CAP).astype("u1")


def sort_starred(text: np.ndarray, small: np.ndarray, depth: int, base: int, memory: int) -> np.ndarray:
    """The S* positions in suffix order, ends first by position."""
    star = np.flatnonzero(small & np.concatenate([[False], ~small[:-1]]) | (text == 0))
    if len(star) < 2:
        return star
    ends = np.concatenate([star[1:], [len(text) - 1]])
    rank = _stretch_ranks(text, star, ends)
    is_end = text[star] == 0
    inner = np.flatnonzero(~is_end)
    rank[is_end] = np.arange(is_end.sum())  # ends are different symbols; all others are larger
    base_rank = is_end.sum()
    if len(inner):
        order = np.argsort(rank[inner])
        sorted_ = rank[inner][order]
        fresh = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        rank[inner[order]] = base_rank + heads[fresh]
    if len(np.unique(rank)) == len(rank):
        return star[np.argsort(rank)]
    if len(rank) <= base:
        return star[np.argsort(_doubled(rank, depth), kind="stable")]
    # the string of names, its own ends kept apart as symbol 0 of a new problem
    names = np.unique(rank, return_inverse=True)[1].astype("i8")
    reduced = np.where(is_end, 0, names + 1)
    place = np.full(len(reduced), -1, "i8")
    order = np.concatenate([x for x, _ in suffix_order(reduced, depth, base, memory)][::-1])
    place[order] = np.arange(len(order))
    return star[np.argsort(place)]


def common_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Common prefix, up to CAP, of each suffix in ``order`` with the one before; none reaches the end of a piece."""
    out = np.zeros(len(order), "u1")
    if len(order) < 2:
        return out
    a, b = order[:-1], order[1:]
    most = np.minimum(room[a], room[b]).astype("i8")
    same = np.zeros(len(a), "i8")
    live = np.flatnonzero(most > 0)
    done = 0
    while len(live):
        equal = text[a[live] + done] == text[b[live] + done]
        live = live[equal]
        done += 1
        same[live] = done
        live = live[most[live] > done]
    out[1:] = same
    return out


def _sweep(text: np.ndarray, wanted: np.ndarray, seeds: dict[int, tuple[np.ndarray, np.ndarray]], symbols: list[int], run: np.ndarray, memory: int, first: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """One sweep over the buckets in the order of ``symbols``. Yields (symbol, positions, common prefixes) in scan order.

    wanted: the positions that this sweep induces. seeds: for each symbol what the sweep finds sorted, scanned after
    the induced entries of the bucket. ``first``: seeds are S*, else L entries in reverse order.
    """
    queues, top = Queues(memory), int(text.max()) + 1
    least = np.full(top, CAP, "u1")  # the least common prefix scanned since the last hand-over to each symbol

    def scan(at: np.ndarray, prefix: np.ndarray) -> None:
        before = at - 1
        good = before >= 0
        good[good] = wanted[before[good]]
        i = np.flatnonzero(good)
        if len(i):
            target = text[before[i]]
            order = np.argsort(target, kind="stable")
            i, target = i[order], target[order]
            new = np.concatenate([[True], target[1:] != target[:-1]])
            start = np.where(new, 0, np.concatenate([[0], i[:-1] + 1]))
            got = range_least(prefix, start, i)
            heads = np.flatnonzero(new)
            got[heads] = np.minimum(got[heads], least[target[heads]])
            got = np.minimum(got, CAP - 1) + np.uint8(1)
            cuts = [*heads.tolist(), len(i)]
            if len(prefix):
                np.minimum(least, prefix.min(), out=least)
            for a, b in zip(cuts, cuts[1:], strict=False):
                d, last = int(target[a]), int(i[b - 1]) + 1
                least[d] = prefix[last:].min() if last < len(prefix) else CAP
                queues.push(d, before[i[a:b]], got[a:b])
        elif len(prefix):
            np.minimum(least, prefix.min(), out=least)

    for c in symbols:
        induced, last, fresh = [], None, True
        while (batch := queues.pop(c)) is not None:
            at, prefix = batch
            prefix = prefix.copy()
            if fresh:
                prefix[0] = 0  # the bucket before has another first symbol
            fresh = False
            scan(at, prefix)
            induced.append((at, prefix))
            last = at[-1]
        at, prefix = (np.concatenate([x[k] for x in induced]) for k in (0, 1)) if induced else (np.empty(0, "i8"), np.empty(0, "u1"))
        yield c, at, prefix
        if c in seeds and len(seeds[c][0]):
            found, prefix = seeds[c][0], seeds[c][1].copy()
            prefix[0] = 0 if last is None else min(run[last], run[found[0]])
            scan(found, prefix)


class _Backwards:
    """The L part of each bucket, taken back from the queues when its turn comes, last entry first."""

    def __init__(self, queues: Queues, kept: set[int]):
        self.queues, self.kept, self.now = queues, kept, (None, None)

    def __contains__(self, c: int) -> bool:
        return c in self.kept

    def __getitem__(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        if self.now[0] != c:
            at, common = self.queues.pop(c)
            self.now = c, (at[::-1], np.concatenate([[0], common[:0:-1]]).astype("u1"))
        return self.now[1]


def suffix_order(text: np.ndarray, depth: int, base: int = 1 << 22, memory: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefix of each with the one before it) by bucket and type, from the largest suffix down.

    Within what is yielded the order is ascending; the first common prefix of a part is 0. Parts of one bucket meet in
    suffixes whose common prefix is the shorter run of their first symbol.
    """
    small, run = _types(text)
    kind = np.int32 if len(text) < 1 << 31 else np.int64
    end = np.flatnonzero(text == 0)
    room = np.minimum(end[np.searchsorted(end, np.arange(len(text)))] - np.arange(len(text)), CAP).astype("u1")
    star = sort_starred(text, small, depth, base, memory)
    prefix = common_prefixes(text, star, room)
    symbol = text[star]
    cuts = [0, *(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1).tolist(), len(star)]
    seeds = {}
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = prefix[a:b].copy()
        own[:1] = 0
        seeds[int(symbol[a])] = (star[a:b].astype(kind), own)
    ends = seeds.pop(0)
    present = np.unique(text).tolist()
    large, kept = Queues(memory), set()
    for c, at, common in _sweep(text, ~small, {0: ends} | seeds, present, run, memory, True):
        if len(at):
            kept.add(c)
            large.push(c, at.astype(kind), common)
    del star, prefix, seeds

    back = _Backwards(large, kept)
    wanted = small & (text != 0)
    for c, at, common in _sweep(text, wanted, back, present[::-1], run, memory, False):
        if len(at):
            yield at[::-1], np.concatenate([[0], common[:0:-1]]).astype("u1")
        if c in kept:
            found, common = back[c]
            yield found[::-1], np.concatenate([[0], common[:0:-1]]).astype("u1")
    yield ends[0], np.zeros(len(ends[0]), "u1")
