"""Periodic runs of words, found by catching squares online in dyadic blocks, and their collapse to one period.

A square is a stretch of words followed by itself.  Words are appended; level ``h`` (a power of two) looks after
squares of periods ``h`` to ``2h - 1``:

* Every completed block of ``2h`` words that starts at a multiple of ``h`` becomes a catcher.  A square of exponent 4
  and such a period ``p`` holds a catcher's block together with its repetition ``p`` words later.
* An appended word completes one window of ``2h`` words at each level, and exactly one catcher of the level lies ``h``
  to ``2h - 1`` words before that window.  The word's only comparison there is the hash of this window with that catcher.
* Equal hashes report a square.  If a known run of this level or a lower one holds it, it is part of that run (or has a
  multiple of its period) and merges into it; otherwise it opens a run, which is compared word by word to both sides, and further to the right as
  words are appended.

So a word costs one comparison a level, however repetitive the text is.  All comparisons of one appended portion and level
are made at once.  Memory: the words, and hashes of the last ``4h`` windows of each level.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import slices
from ledgerlark.llm.hashing import mix

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words appended at once.
PORTION = 1 << 16

_U = np.uint64


class SquareCatchers:
    """Runs of an appended sequence of integers.  Periods above ``longest`` are not looked for."""

    def __init__(self, longest: int):
        self.levels = max(0, longest).bit_length()
        self.size = 0
        self.words = np.zeros(PORTION, dtype=np.int64)
        self.tails: list[np.ndarray] = [np.zeros(0, dtype=_U) for _ in range(self.levels + 1)]  # hashes of windows of 2**k words
        self.starts: list[int] = []  # of the runs, rising
        self.runs: list[list[int]] = []  # [start, end, period] in the order of starts
        self.open: list[list[int]] = []  # runs that reach the last word

    def append(self, ids: np.ndarray) -> None:
        old, self.size = self.size, self.size + len(ids)
        if self.size > len(self.words):
            self.words = np.concatenate([self.words[:old], np.zeros(max(old, self.size - old), dtype=np.int64)])
        self.words[old : self.size] = ids
        still = []
        for run in self.open:
            self._grow_right(run)
            if run[1] == self.size:
                still.append(run)
        self.open = still

        first = old  # of the windows that the new words complete
        new = mix(ids.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(1))
        for k in range(self.levels + 1):
            width = 1 << k
            seen = np.concatenate([self.tails[k], new])
            base = first - len(self.tails[k])  # start of the first window in ``seen``
            if k and len(new):
                self._catch(seen, base, first, width // 2)
            if k < self.levels:  # windows of twice the width
                first = max(0, old - 2 * width + 1)
                stop = self.size - 2 * width + 1
                if stop > first:
                    left, right = seen[first - base : stop - base], seen[first + width - base : stop + width - base]
                    new = mix(left * _U(0xD6E8FEB86659FD93) + (right ^ (right >> _U(29))))
                else:
                    new = np.zeros(0, dtype=_U)
            self.tails[k] = seen[-2 * width :].copy()

    def _catch(self, seen: np.ndarray, base: int, first: int, h: int) -> None:
        """Compare the windows from ``first`` on with the catchers of level ``h``."""
        at = np.arange(max(first, h), base + len(seen))
        catcher = at // h * h - h
        hit = np.flatnonzero(seen[at - base] == seen[catcher - base])
        if not len(hit):
            return
        at, catcher = at[hit], catcher[hit]
        ends = at + 2 * h
        known = np.array([r for r in self.runs if r[2] < 2 * h]).reshape(-1, 3)
        if len(known):
            reach = np.maximum.accumulate(known[:, 1])
            place = np.searchsorted(known[:, 0], catcher, side="right") - 1
            fresh = np.flatnonzero((place < 0) | (reach[place] < ends))
            at, catcher, ends = at[fresh], catcher[fresh], ends[fresh]
        last: dict[int, int] = {}  # period: end of the run found last
        for s, end, p in zip(catcher.tolist(), ends.tolist(), (at - catcher).tolist(), strict=True):
            if last.get(p, -1) < end and (run := self._open_run(s, p, 2 * h)) is not None:
                last[p] = run[1]

    def _open_run(self, s: int, p: int, width: int) -> list[int] | None:
        w = self.words
        if not np.array_equal(w[s : s + width], w[s + p : s + p + width]):
            return None  # equal hashes of different words
        run, step = [s, s + p + width, p], 32
        while run[0]:
            lo = max(0, run[0] - step)
            differs = np.flatnonzero(w[lo : run[0]] != w[lo + p : run[0] + p])
            if len(differs):
                run[0] = lo + int(differs[-1]) + 1
                break
            run[0], step = lo, 2 * step
        self._grow_right(run)
        place = bisect_right(self.starts, run[0])
        self.starts.insert(place, run[0])
        self.runs.insert(place, run)
        if run[1] == self.size:
            self.open.append(run)
        return run

    def _grow_right(self, run: list[int]) -> None:
        w, p, step = self.words, run[2], 32
        while run[1] < self.size:
            hi = min(self.size, run[1] + step)
            differs = np.flatnonzero(w[run[1] : hi] != w[run[1] - p : hi - p])
            if len(differs):
                run[1] += int(differs[0])
                return
            run[1], step = hi, 2 * step


def _accept(length: int, period: int) -> bool:
    return length >= max(MIN_LENGTH, MIN_EXPONENT * period)


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period.

    The texts are appended one after the other, with a sign between them that occurs once.
    """
    longest = max(map(len, texts), default=0) // MIN_EXPONENT
    catchers = SquareCatchers(longest)
    number: dict[bytes, int] = {}
    for words in texts:
        number.update(dict.fromkeys(words, 0))
    number = {w: i for i, w in enumerate(number)}
    edges, waiting, size = [], [], 0

    def hand_over() -> None:
        nonlocal waiting, size
        joined = np.concatenate(waiting)
        for at in range(0, len(joined), PORTION):
            catchers.append(joined[at : at + PORTION])
        waiting, size = [], 0

    total = 0
    for i, words in enumerate(texts):
        edges.append(total)
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        waiting += [ids, np.array([-1 - i], dtype=np.int64)]
        size += len(ids) + 1
        total += len(ids) + 1
        if size >= PORTION:
            hand_over()
    if size:
        hand_over()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in catchers.runs:
        if _accept(end - start, period):
            text = bisect_right(edges, start) - 1
            out[text].append((start - edges[text], end - start, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist(), strict=False) if not d]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exponent; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start: long, length: long, period: long>"


def _groups(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for t in texts:
        words = (t or b"").split()  # bytes are split at the six ASCII white-space characters only
        if group and size + len(words) > PORTION:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _find(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for rb in slices(batches):
        at = 0
        for group in _groups(rb.column(rb.num_columns - 1).to_pylist()):
            found = runs_of(group)
            as_rows = lambda rs: [dict(zip(("start", "length", "period"), r, strict=True)) for r in rs]
            best = [strongest(rs) for rs in found]
            cols = [
                *rb.slice(at, len(group)).columns[:-1],
                pa.array([len(words) for words in group], pa.int64()),
                pa.array([as_rows(rs) for rs in found], pa.list_(_RUN)),
                pa.array([None if b is None else as_rows([b])[0] for b in best], _RUN),
            ]
            names = [*rb.schema.names[:-1], "n_words", "runs", "strongest"]
            if with_text:
                cols.append(pa.array([b" ".join(kept_words(w, rs)) for w, rs in zip(group, found, strict=True)], pa.binary()))
                names.append("collapsed")
            at += len(group)
            yield pa.RecordBatch.from_arrays(cols, names=names)


def find_runs(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, strongest[, collapsed].

    ``runs``: (start, length, period) in words, by start, then period, of every stretch with smallest period q and
    length of at least max(6, 4 q) that no neighbouring word extends.  ``strongest``: the run of the greatest
    exponent (ties: smallest start, then period), null without runs.  ``collapsed``: the words, joined by one space, that no run
    holds after its first period.

    Reads doc_id and text only, so other columns never clash.  A null, empty or blank text has no words, no runs and an empty
    ``collapsed``.  Repeated rows and null ids are judged each on its own; an empty table gives an empty result.  A very long
    text is appended in portions; its words are held once by the task that reads it.  Nothing is shuffled or collected.
    """
    schema = f"doc_id long, n_words long, runs array<{_RUN_SQL}>, strongest {_RUN_SQL}" + (", collapsed binary" if with_text else "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = read.mapInArrow(partial(_find, with_text=with_text), schema)
    return out.withColumn("collapsed", F.col("collapsed").cast("string")) if with_text else out
