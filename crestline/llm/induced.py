"""Suffix order and common prefixes of one shard by external induced sorting, with numpy.

The suffixes that begin a run of rising symbols after a falling one (LMS suffixes) are sorted
first: the substrings between them are named by rank and the string of names is sorted by
doubling.  From their order the falling (L) suffixes are induced in one pass over the symbols
upwards, then the rising (S) ones in a pass downwards.  A suffix that is taken from the queue of
its first symbol puts the suffix one place longer into the queue of that one's symbol; as
suffixes are taken in order, first-in-first-out queues by symbol act as the priority queue of
(symbol, rank).  Each queued tuple carries the suffix and its common prefix with the one queued
before it, which is one more than the least common prefix taken in between.

Queues go to unlinked scratch files beyond ``IN_MEMORY`` tuples, as does every array of that
size.  Order and common prefixes are exact to ``DEPTH`` symbols, which is all that is asked for.
"""

from __future__ import annotations

import tempfile

import numpy as np

DEPTH = 200
IN_MEMORY = 32 << 20
TOP = 255  # common prefixes are kept in a byte
SEPARATOR = 0
BLOCK = 32  # bytes of symbols compared at a time
PAIRS = 1 << 18  # of suffixes compared at a time


def array(n: int, dtype) -> np.ndarray:
    """An array in memory, or in a scratch file if it is long."""
    if n <= IN_MEMORY:
        return np.empty(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


class Queue:
    """Tuples (suffix, common prefix with the tuple before), first in, first out."""

    def __init__(self, in_memory: int):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.most, self.file, self.stored = 0, in_memory, None, []

    def put(self, suffixes: np.ndarray, common: np.ndarray) -> None:
        self.parts.append((suffixes, common))
        self.held += len(suffixes)
        if self.held > self.most:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for s, c in self.parts:
                s.tofile(self.file)
                c.tofile(self.file)
                self.stored.append(len(s))
            self.parts, self.held = [], 0

    def take(self):
        """The tuples in parts as long as memory allows: each part is one step of a pass."""
        if self.file:
            self.file.seek(0)
            some: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for n in self.stored:
                some.append((np.fromfile(self.file, np.int64, n), np.fromfile(self.file, np.uint8, n)))
                held += n
                if held > self.most:
                    yield self._joined(some)
                    some, held = [], 0
            self.file.close()
            self.parts = some + self.parts
        if self.parts:
            yield self._joined(self.parts)
        self.parts = []

    @staticmethod
    def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([s for s, _ in parts]), np.concatenate([c for _, c in parts])


def _types(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are rising (S), and how often each one's first symbol repeats (to TOP)."""
    n = len(t)
    last = np.flatnonzero(np.append(t[1:] != t[:-1], True))  # last place of each run
    run = np.diff(last, prepend=-1)
    rising = np.append(t[last[:-1]] < t[last[1:]], False)
    s = array(n, bool)
    s[:] = np.repeat(rising, run)
    left = array(n, np.uint8)
    left[:] = np.minimum(np.repeat(last, run) - np.arange(n) + 1, TOP)
    return s, left


def _narrow(t: np.ndarray) -> np.ndarray:
    """The symbols in a byte each if the highest byte is left over, as it is for UTF-8."""
    if t.dtype.itemsize == 1 or int(t.max()) >= TOP:
        return t
    out = array(len(t), np.uint8)
    out[:] = t
    return out


def _word(t: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The symbols of eight bytes from each place; beyond its end the highest, for a suffix that
    ends in an LMS place there is greater than one that goes on falling."""
    out = np.zeros(len(at), np.uint64)
    width = 8 * t.dtype.itemsize
    for k in range(64 // width):
        p = at + k
        sym = np.where(p < end, t[np.minimum(p, len(t) - 1)].astype(np.uint64), np.uint64((1 << width) - 1))
        out = out << np.uint64(width) | sym
    return out


def _refine(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split the classes of the active members by key; a rank is the first place of a class.

    Returns the members whose class still has others."""
    order = np.argsort(key)
    if rank[active].any():
        # By rank and then key, as one number: keys count by their order.
        k = key[order]
        dense = np.empty(len(key), np.int64)
        dense[order] = np.cumsum(np.append(False, k[1:] != k[:-1]))
        order = np.argsort(rank[active] * (int(dense[order[-1]]) + 1) + dense)
    who = active[order]
    r, k = rank[who], key[order]
    new_class = np.append(True, r[1:] != r[:-1])
    new = new_class | np.append(True, k[1:] != k[:-1])
    place = np.arange(len(who))
    first_of_class = np.maximum.accumulate(np.where(new_class, place, 0))
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank[who] = r + (first - first_of_class)
    alone = new & np.append(new[1:], True)
    return who[~alone]


def _sorted_lms(t: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """LMS suffixes in order: substrings named by rank, names doubled until DEPTH is covered."""
    m = len(lms)
    rank = np.zeros(m, np.int64)
    if m < 2:
        return lms
    step = 8 // t.dtype.itemsize
    end = np.append(lms[1:] + 1, len(t))
    size = np.minimum(end - lms, DEPTH + step)
    active = np.arange(m)
    for at in range(0, int(size.max()), step):
        if not len(active):
            break
        active = _refine(rank, active, _word(t, lms[active] + at, end[active]))
        # Classes without a longer substring are equal to their end.
        longer = np.zeros(m, bool)
        longer[rank[active[size[active] > at + step]]] = True
        active = active[longer[rank[active]]]
    active = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1)
    h = 1
    while len(active):
        there = active + h
        reach = np.where(there < m, lms[np.minimum(there, m - 1)], len(t) + DEPTH) - lms[active]
        if (reach >= DEPTH).all():
            break
        key = np.where(there < m, rank[np.minimum(there, m - 1)] + 1, 0)
        active = _refine(rank, active, key)
        h *= 2
    return lms[np.argsort(rank, kind="stable")]


def _common(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of pairs of suffixes, to DEPTH; a block of symbols of both at a time."""
    width, words = t.dtype.itemsize, BLOCK // 8
    step = BLOCK // width
    padded = np.append(t, np.zeros(step, t.dtype))
    blocks = np.ndarray((len(t) + 1,), f"V{BLOCK}", padded.data, 0, (width,))
    out = np.zeros(len(a), np.int64)
    for low in range(0, len(a), PAIRS):
        x, y = a[low : low + PAIRS], b[low : low + PAIRS]
        todo, own = np.arange(len(x)), np.zeros(len(x), np.int64)
        for at in range(0, DEPTH, step):
            diff = blocks[np.minimum(x[todo] + at, len(t))].view("<u8") ^ blocks[np.minimum(y[todo] + at, len(t))].view("<u8")
            differs = (diff != 0).reshape(-1, words)
            ends = differs.any(1)
            word = differs[ends].argmax(1)
            last = diff.reshape(-1, words)[ends, word]
            bit = np.log2((last & (~last + np.uint64(1))).astype(np.float64)).astype(np.int64)
            own[todo[ends]] = at + word * (8 // width) + bit // (8 * width)
            todo = todo[~ends]
            if not len(todo):
                break
        own[todo] = TOP
        out[low : low + PAIRS] = own
    # What follows the end of the text is not common.
    return np.minimum(np.minimum(out, -(-DEPTH // 4) * 4), len(t) - np.maximum(a, b)).astype(np.uint8)


class _Pass:
    """One inducing pass: suffixes are shown in order, the ones before them are queued."""

    def __init__(self, t: np.ndarray, wanted: np.ndarray, symbols: int):
        self.t, self.wanted = t, wanted
        self.queues = [Queue(IN_MEMORY // 64) for _ in range(symbols)]
        self.least = np.full(symbols, TOP, np.int64)  # common prefix since the last one queued
        self.begun = np.zeros(symbols, bool)

    def show(self, suffixes: np.ndarray, common: np.ndarray) -> None:
        """``common``: with the suffix shown before."""
        if not len(suffixes):
            return
        before = suffixes - 1
        ok = np.flatnonzero((before >= 0) & self.wanted[before])
        symbol = self.t[before[ok]]
        order = np.argsort(symbol, kind="stable")
        at, symbol = ok[order], symbol[order]
        cuts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(at) else np.zeros(0, np.int64)
        all_least = int(common.min())
        shown = self.least
        np.minimum(shown, all_least, out=(passed := shown.copy()))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
            s, own = int(symbol[a]), at[a:b]
            starts = np.append(0, own + 1)
            tail = starts[-1] == len(common)
            m = np.minimum.reduceat(common, starts[:-1] if tail else starts).astype(np.int64)
            since = TOP if tail else int(m[-1])
            m = m[: len(own)]
            m[0] = min(int(m[0]), int(shown[s]))
            m = np.minimum(m + 1, TOP)
            if not self.begun[s]:
                m[0], self.begun[s] = 0, True
            self.queues[s].put(before[own], m.astype(np.uint8))
            passed[s] = since
        self.least = passed

    def drain(self, symbol: int):
        """What is queued for a symbol, each part shown as it is taken, with what that adds."""
        while True:
            queue, self.queues[symbol] = self.queues[symbol], Queue(IN_MEMORY // 64)
            some = False
            for suffixes, common in queue.take():
                some = True
                self.show(suffixes, common)
                yield suffixes, common
            if not some:
                return


def repeated(t: np.ndarray) -> np.ndarray:
    """Which places of ``t`` begin DEPTH symbols that also begin elsewhere.

    ``t`` holds symbols as uint16 with SEPARATOR between texts; what holds a separator never
    counts as repeated because places without DEPTH symbols before one are left out by callers.
    """
    n = len(t)
    flags = np.zeros(n, bool)
    if n < 2:
        return flags
    symbols = int(t.max()) + 1
    rising, runs = _types(t)
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    narrow = _narrow(t)
    lms = _sorted_lms(narrow, lms)
    lms_common = np.zeros(len(lms), np.uint8)
    if len(lms) > 1:
        lms_common[1:] = _common(narrow, lms[1:], lms[:-1])
    del narrow
    first = t[lms]
    edges = np.searchsorted(first, np.arange(symbols + 1))

    # Upwards: L suffixes.
    up = _Pass(t, ~rising, symbols)
    falling: list[Queue] = []
    last_l = np.full(symbols, -1, np.int64)
    up.show(np.array([n], np.int64), np.zeros(1, np.uint8))
    for s in range(symbols):
        kept = Queue(IN_MEMORY // 64)
        for suffixes, common in up.drain(s):
            kept.put(suffixes, common)
            last_l[s] = suffixes[-1]
        falling.append(kept)
        own = lms[edges[s] : edges[s + 1]]
        if len(own):
            common = lms_common[edges[s] : edges[s + 1]].copy()
            common[0] = min(runs[last_l[s]], runs[own[0]]) if last_l[s] >= 0 else 0
            up.show(own, common)

    # Downwards: S suffixes, then each symbol's L suffixes from their end.
    down = _Pass(t, rising, symbols)
    for s in range(symbols - 1, -1, -1):
        leftmost = -1
        for suffixes, common in down.drain(s):
            hit = common >= DEPTH  # with the right neighbour, shown before
            flags[suffixes[hit]] = True
            pair = np.flatnonzero(hit)
            flags[suffixes[pair[pair > 0] - 1]] = True
            if leftmost >= 0 and hit[0]:
                flags[leftmost] = True
            leftmost = int(suffixes[-1])
        parts = list(falling[s].take())
        right = min(runs[parts[-1][0][-1]], runs[leftmost]) if parts and leftmost >= 0 else 0
        if right >= DEPTH:
            flags[leftmost] = True
        for suffixes, common in reversed(parts):
            hit = common >= DEPTH  # with the left neighbour
            flags[suffixes[hit]] = True
            pair = np.flatnonzero(hit)
            flags[suffixes[pair[pair > 0] - 1]] = True
            if right >= DEPTH:
                flags[suffixes[-1]] = True
            shown = np.append(common[1:], np.uint8(min(int(right), TOP)))
            right = int(common[0])
            down.show(suffixes[::-1], shown[::-1])
        falling[s] = Queue(0)
    return flags
