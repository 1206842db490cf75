"""Sets of word shingles of whole texts, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from crestline.llm.spans import mix64, short_hashes

RUN_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def runs(texts: list[str | None]) -> Iterator[list[bytes]]:
    """ASCII-lowered UTF-8 texts in runs of bounded volume; a longer text is a run of its own."""
    run, volume = [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass").lower()
        if run and volume + len(raw) > RUN_BYTES:
            yield run
            run, volume = [], 0
        run.append(raw)
        volume += len(raw)
    if run:
        yield run


def word_hashes(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in turn, and how many each text has."""
    data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1, append=1))
    starts, ends = edge[0::2], edge[1::2]
    text_end = np.cumsum([len(r) + 1 for r in run])
    counts = np.diff(np.searchsorted(starts, text_end), prepend=0)
    return short_hashes(data, starts, ends), counts


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The set of each text; fewer words than the width are one shingle, no words are none."""
    for run in runs(texts):
        words, counts = word_hashes(run)
        at = np.concatenate([[0], np.cumsum(counts)])
        rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width):
            rolled = mix64(rolled * _STEP + words[k : k + len(rolled)])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:
                one = np.zeros(1, np.uint64)
                for w in words[a:b]:
                    one = mix64(one * _STEP + w)
                yield one + np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)
