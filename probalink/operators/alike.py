"""The most alike names of a block, exactly, without a row for each of its pairs.

All names of the right side are compared with a left one at once: a name is a word of bits, one a character, and Myers' recurrence (1999,
in Hyyrö's form for whole strings) takes all words a character of the left name further by some 16 operations on arrays. Left names are
taken in their order, so that what a name begins with in common with the one before isn't computed again. It stays a comparison
of all pairs, at some 10 to 100 million a second and core.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from os.path import commonprefix

import numpy as np
import pyarrow as pa

#: Characters of a name that words of bits hold; longer names are compared by rows of the plain recurrence.
WORD = 64
#: Names of the plain recurrence that are compared at once.
ROWS = 1024


class Bank:
    """Right names of up to `bits` characters, and the state of their comparison with a left one. Distances are given less its length."""

    def __init__(self, names: Sequence[str], bits: int):
        kind = np.dtype(f"u{bits // 8}")
        n, most = len(names), max(map(len, names))
        codes = np.array(names, f"U{most or 1}").view(np.uint32).reshape(n, -1)
        found, place = np.unique(codes, return_inverse=True)
        place = place.reshape(codes.shape)
        equal = np.zeros((len(found), n), kind)
        for k in range(most):
            equal[place[:, k], np.arange(n)] |= kind.type(1 << k)
        self.equal = dict(zip(found.tolist(), equal))
        self.mask = np.array([(1 << len(name)) - 1 for name in names], kind)
        self.none, self.one = np.zeros(n, kind), kind.type(1)
        self.states = [(np.full(n, ~kind.type(0)), np.zeros(n, kind))]
        self.space = [np.empty(n, kind) for _ in range(5)]

    def step(self, character: str, before: tuple[np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray]) -> None:
        eq = self.equal.get(ord(character), self.none)
        (pv, mv), (p, m) = before, after
        xv, xh, ph, mh, _ = self.space
        np.bitwise_or(eq, mv, out=xv)
        np.bitwise_and(eq, pv, out=xh)
        np.add(xh, pv, out=xh)
        np.bitwise_xor(xh, pv, out=xh)
        np.bitwise_or(xh, eq, out=xh)
        np.bitwise_or(xh, pv, out=ph)
        np.invert(ph, out=ph)
        np.bitwise_or(ph, mv, out=ph)
        np.bitwise_and(pv, xh, out=mh)
        np.left_shift(ph, self.one, out=ph)
        np.bitwise_or(ph, self.one, out=ph)
        np.left_shift(mh, self.one, out=mh)
        np.bitwise_or(xv, ph, out=p)
        np.invert(p, out=p)
        np.bitwise_or(p, mh, out=p)
        np.bitwise_and(ph, xv, out=m)

    def distances(self, name: str, same: int) -> np.ndarray:
        """Distances + WORD - len(name), of a name that begins with the same `same` characters as the one before."""
        del self.states[min(same, WORD) + 1 :]
        at = self.states[-1]
        for character in name[len(self.states) - 1 :]:
            after = (np.empty_like(at[0]), np.empty_like(at[1]))
            self.step(character, at, after)
            at = after
            if len(self.states) <= WORD:
                self.states.append(at)
        up, down = self.space[0], self.space[1]
        np.bitwise_and(at[0], self.mask, out=up)
        np.bitwise_and(at[1], self.mask, out=down)
        return np.bitwise_count(up) + (np.uint8(WORD) - np.bitwise_count(down))


class LongBank:
    """Right names of any length, compared by the plain recurrence."""

    def __init__(self, names: Sequence[str]):
        self.lengths = np.array([len(name) for name in names])
        self.codes = np.array(names, f"U{self.lengths.max()}").view(np.uint32).reshape(len(names), -1)

    def distances(self, name: str, same: int) -> np.ndarray:
        out = np.empty(len(self.codes), np.int64)
        steps = np.arange(self.codes.shape[1] + 1)
        for begin in range(0, len(out), ROWS):
            codes = self.codes[begin : begin + ROWS]
            row = np.broadcast_to(steps, (len(codes), len(steps)))
            for n, character in enumerate(name, 1):
                new = np.empty(row.shape, np.int64)
                new[:, 0] = n
                new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (codes != ord(character)))
                row = np.minimum.accumulate(new - steps, axis=1) + steps
            out[begin : begin + ROWS] = row[np.arange(len(codes)), self.lengths[begin : begin + ROWS]]
        return out + WORD - len(name)


def least(values: np.ndarray, k: int) -> np.ndarray:
    """The places of the k least values, of equal ones the first."""
    if len(values) <= k:
        return np.arange(len(values))
    most = values.min()
    while np.count_nonzero(within := values <= most) < k:
        most += 1
    places = np.flatnonzero(within)
    return places[np.argsort(values[places], kind="stable")[:k]]


def most_alike(left_ids: Sequence, left_names: Sequence[str | None], right_ids: Sequence, right_names: Sequence[str | None], k: int, within: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(left place, right places): for each left record the k right ones of the highest similarity of names, 1 less the edit distance over
    the longer length and 0 without a name, ties to the lower id; within: of those with a greater id."""
    order = sorted(range(len(right_ids)), key=right_ids.__getitem__)
    ids = np.empty(len(order), object)
    ids[:] = [right_ids[j] for j in order]
    first = np.searchsorted(ids, np.array([*left_ids, None], object)[:-1], side="right") if within else np.zeros(len(left_ids), np.int64)
    given = [x for x in (*left_names, *right_names) if x is not None]
    begun = len(commonprefix([min(given), max(given)])) if given else 0
    groups: dict[int, list[int]] = {}  # places in the order of ids, by length; -1: without a name
    for place, j in enumerate(order):
        groups.setdefault(-1 if right_names[j] is None else len(right_names[j]) - begun, []).append(place)
    nameless = np.array(groups.pop(-1, []), np.int64)
    places = {n: np.array(own) for n, own in groups.items()}
    banks, span = [], {}
    for low, bits in ((0, 16), (17, 32), (33, 64), (65, 0)):
        own = [n for n in sorted(groups) if low <= n and (n <= bits or not bits)]
        if own:
            at = 0
            for n in own:
                span[n] = (len(banks), at, at := at + len(groups[n]))
            names = [right_names[order[p]][begun:] for n in own for p in groups[n]]
            banks.append(Bank(names, bits) if bits else LongBank(names))
    order = np.array(order, np.int64)
    before, found = "", []
    for i in sorted((i for i, x in enumerate(left_names) if x is not None), key=left_names.__getitem__):
        name = left_names[i][begun:]
        if not found or name != before:
            same = len(commonprefix([before, name]))
            found = [bank.distances(name, same) for bank in banks]
            before = name
        best: list[tuple[float, int]] = []
        for n in sorted(groups, key=lambda n: abs(n - len(name))):
            longer = max(n, len(name)) + begun or 1
            if len(best) == k and 1 - abs(n - len(name)) / longer < -best[-1][0]:
                continue  # too short or too long, whatever its letters
            bank, a, e = span[n]
            start = int(np.searchsorted(places[n], first[i])) if within else 0
            values = found[bank][a + start : e]
            chosen = least(values, k)
            edits = values[chosen].astype(np.int64) + len(name) - WORD
            best = sorted([*best, *zip((edits / longer - 1).tolist(), places[n][start + chosen].tolist())])[:k]
        without = nameless[np.searchsorted(nameless, first[i]) :][:k]
        best = sorted([*best, *((-0.0, p) for p in without.tolist())])[:k]
        yield i, order[[p for _, p in best]]
    for i, x in enumerate(left_names):
        if x is None:
            yield i, order[first[i] : first[i] + k]


def in_cell(left: pa.Table, right: pa.Table, k: int, within: bool) -> pa.Table:
    """(a_id, b_id) of a cell with left (a_id, a_name_norm) and right (b_id, b_name_norm) records, in this order of columns."""
    a, b = left.column(0).combine_chunks(), right.column(0).combine_chunks()
    pairs = list(most_alike(a.to_pylist(), left.column(1).to_pylist(), b.to_pylist(), right.column(1).to_pylist(), k, within)) if len(a) and len(b) else []
    own = np.repeat(np.array([i for i, _ in pairs], np.int64), np.array([len(found) for _, found in pairs], np.int64))
    others = np.concatenate([found for _, found in pairs]) if pairs else np.zeros(0, np.int64)
    return pa.table({"a_id": a.take(pa.array(own)), "b_id": b.take(pa.array(others.astype(np.int64)))})
