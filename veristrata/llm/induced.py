"""Suffix sorting by recursive induction over bulk priority queues kept on disk.

A suffix enters the queue of its first character when its successor leaves: queues are
emptied in order of characters, first in first out, so what leaves is sorted. With a suffix
goes its common prefix with the one before it in its queue: one more than the least common
prefix among all that left since the last entry, up to a cap. Queue sizes are known by
counting, so all queues of a level share one array of suffixes and one of prefixes. The
substrings between leftmost smaller suffixes are sorted by one such pass, named, and the
string of their names is sorted by the same procedure; its common prefixes, in names, become
prefixes of the text by the distance that the names span and the characters after it.

Every array of a level that has more than ``limit`` elements lies in an unnamed file in the
executor's temporary folder and is filled and read in pieces: text with types, queues,
prefixes, names and the bounds of the queues. Beside them a level holds a batch.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

#: Elements up to which an array stays in memory, and elements of a piece.
IN_MEMORY, PIECE = 8_000_000, 1 << 18
#: Suffixes that leave together, from as many neighbouring queues as hold them.
#: The number follows how often one enters a queue that leaves with it.
BATCH, LEAST = 32_768, 1024
#: Up to this length suffixes leave one at a time.
SMALL = 200_000
#: Common prefixes are counted up to this.
CAP = 100
_ZERO = np.zeros(1, np.int64)


def allocate(n: int, dtype, limit: int) -> np.ndarray:
    if n <= limit:
        return np.empty(n, dtype)
    with tempfile.TemporaryFile() as f:
        f.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(f, dtype, "r+", shape=(n,))


def pieces(n: int, limit: int) -> Iterator[slice]:
    """Slices of an array of n elements: one, if it is in memory."""
    step = n if n <= limit else min(PIECE, max(limit, 1))
    for i in range(0, n, step or 1):
        yield slice(i, min(i + step, n))


def _coded(t: np.ndarray, limit: int) -> np.ndarray:
    """Twice each character, and one more where the suffix is smaller than the next one; the
    last, a sentinel, is."""
    n = len(t)
    code = allocate(n, np.int32 if int(t.max()) < 1 << 29 else np.int64, limit)
    after = True
    for s in reversed(list(pieces(n, limit))):
        x = np.asarray(t[s.start : min(s.stop + 1, n)]).astype(code.dtype)
        y, x = x[1:], x[: s.stop - s.start]
        less, differ = np.ones(len(x), bool), np.ones(len(x), bool)
        less[: len(y)], differ[: len(y)] = x[: len(y)] < y, x[: len(y)] != y
        at = np.minimum.accumulate(np.where(differ, np.arange(len(x)), len(x))[::-1])[::-1]
        small = np.r_[less, after][at]
        code[s] = x << 1 | small
        after = small[0]
    return code


def _leftmost(code: np.ndarray, limit: int) -> np.ndarray:
    """Suffixes smaller than the next one whose predecessor isn't, in order of the text."""
    n = len(code)

    def found(s: slice) -> np.ndarray:
        small = code[max(s.start - 1, 0) : s.stop] & 1 == 1
        return np.nonzero(small[1:] & ~small[:-1])[0] + max(s.start, 1)

    parts = list(pieces(n, limit))
    if len(parts) == 1:
        return found(parts[0])
    out = allocate(sum(len(found(s)) for s in parts), np.int64, limit)
    at = 0
    for s in parts:
        x = found(s)
        out[at : at + len(x)] = x
        at += len(x)
    return out


def _bounds(chars, sigma: int, limit: int) -> np.ndarray:
    """First place of each character's queue, and the end; chars: pieces of characters."""
    out = allocate(sigma + 1, np.int64, limit)
    out[:] = 0
    for x in chars:
        values, many = np.unique(x, return_counts=True)
        out[values + 1] += many
    total = 0
    for s in pieces(sigma + 1, limit):
        out[s] = np.cumsum(out[s]) + total
        total = int(out[s.stop - 1])
    return out


def agree(code: np.ndarray, a: np.ndarray, b: np.ndarray, most) -> np.ndarray:
    """Common prefixes of pairs of suffixes, by their characters, up to most."""
    out = np.zeros(len(a), np.int64)
    most = np.broadcast_to(most, out.shape)
    live, k = np.nonzero(most > 0)[0], 0
    while len(live):
        live = live[code[a[live] + k] >> 1 == code[b[live] + k] >> 1]
        k += 1
        out[live] = k
        live = live[most[live] > k]
    return out


class _Queues:
    """The queues of one pass. entry: next place of each queue; step: +1 from its start on, -1
    from its end back. Common prefixes of what leaves are remembered for what enters later:
    a queue knows the batch of its last entry and the least prefix of that batch after it,
    and ``latest`` the last batch that had a prefix of each length or less."""

    def __init__(self, queue, prefix, entry, step: int, limit: int):
        self.queue, self.prefix, self.entry, self.step = queue, prefix, entry, step
        if prefix is not None:
            self.batch, self.latest = 0, np.full(CAP + 1, -1, np.int64)
            self.when, self.least = allocate(len(entry), np.int64, limit), allocate(len(entry), np.uint8, limit)
            self.when[:] = -1

    def enter(self, chars: np.ndarray, items: np.ndarray, at: np.ndarray, left: np.ndarray | None) -> None:
        """Items enter the queues of their characters, in order. left: common prefix of each
        suffix of the batch with the one that left before; at: which of them brought an item."""
        if len(items):
            order = np.argsort(chars, kind="stable")
            chars, items, at = chars[order], items[order], at[order]
            cuts = np.concatenate([_ZERO, (chars[1:] != chars[:-1]).nonzero()[0] + 1])
            size = np.concatenate([cuts[1:], [len(chars)]]) - cuts
            which = chars[cuts]
            place = np.repeat(self.entry[which], size) + self.step * (np.arange(len(chars)) - np.repeat(cuts, size))
            self.queue[place] = items
            if left is not None:
                self._prefixes(which, cuts, size, place, at, left)
            self.entry[which] += self.step * size
        if left is not None and len(left):
            self.latest[int(left.min()) :] = self.batch
            self.batch += 1

    def _prefixes(self, which, cuts, size, place, at, left) -> None:
        value = np.empty(len(at), np.int64)
        again = np.ones(len(at), bool)
        again[cuts] = False
        if again.any():  # the least prefix between two entries of one batch
            j = np.nonzero(again)[0]
            low, high = at[j - 1] + 1, at[j]
            level = np.frexp(high - low + 1)[1] - 1
            rows, found = left, np.empty(len(j), left.dtype)
            for k in range(int(level.max()) + 1):
                now = np.nonzero(level == k)[0]
                found[now] = np.minimum(rows[low[now]], rows[high[now] - (1 << k) + 1])
                rows = np.minimum(rows[: len(rows) - (1 << k)], rows[1 << k :]) if len(rows) > 1 << k else rows
            value[j] = found
        before = self.when[which]
        since = np.minimum(np.searchsorted(self.latest, before, "right"), CAP)
        ahead = np.minimum.accumulate(left)[at[cuts]]
        value[cuts] = np.minimum(np.minimum(since, ahead), np.where(before < 0, CAP, self.least[which]))
        value = np.minimum(value + 1, CAP)
        if self.step > 0:
            value[cuts[before < 0]] = 0
            self.prefix[place] = value
        else:  # of the entry before, which stands behind
            known = np.ones(len(at), bool)
            known[cuts[before < 0]] = False
            self.prefix[place[known] + 1] = value[known]
        last = at[cuts + size - 1]
        after = np.full(len(left) + 1, CAP, np.uint8)
        after[:-1] = np.minimum.accumulate(left[::-1])[::-1]
        self.when[which], self.least[which] = self.batch, after[last + 1]


def _induce(code, seeds, seed_at, seed_prefix, starts, queue, prefix, limit: int) -> None:
    """seeds: sorted leftmost smaller suffixes, seed_at: where those of each character begin,
    seed_prefix: common prefixes of neighbours. Fills queue with the sorted suffixes and prefix
    with their common prefixes; both prefixes may be None.

    Neighbouring queues are emptied together as long as nothing that leaves them enters one
    of them; a queue that feeds itself is emptied in rounds."""
    n, sigma = len(code), len(starts) - 1

    step = min(PIECE, max(limit, 1))

    def fresh(first: int) -> np.ndarray:
        out = allocate(sigma, np.int64, limit)
        for s in pieces(sigma, limit):
            out[s] = starts[s.start + first : s.stop + first] - first
        return out

    def brought(items: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters, suffixes and bringers of the predecessors of a kind."""
        at = np.nonzero(items > 0)[0]
        prev = items[at] - 1
        to = code[prev]
        go = to & 1 == kind
        return to[go] >> 1, prev[go], at[go]

    def seams(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return agree(code, first.astype(np.int64), second.astype(np.int64), CAP)

    q = _Queues(queue, prefix, fresh(0), 1, limit)
    heads = q.entry

    def seeds_of(c: int, e: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Seeds of queues c to e, and their prefixes with what leaves before each."""
        own = np.asarray(seeds[seed_at[c] : seed_at[e]])
        if prefix is None:
            return own, None
        left = np.array(seed_prefix[seed_at[c] : seed_at[e]])
        which = np.arange(c, e)
        which = which[(seed_at[c:e] < seed_at[c + 1 : e + 1]) & (heads[c:e] > starts[c:e])]
        if len(which):
            first = seed_at[which]
            left[first - seed_at[c]] = seams(queue[heads[which] - 1], seeds[first])
        return own, left

    c, batch = 0, BATCH
    while c < sigma:
        e = max(c + 1, int(np.searchsorted(starts, starts[c] + batch, "right")) - 1)
        if e > c + 1:
            at = np.arange(starts[c], starts[e])
            of = np.repeat(np.arange(c, e), np.diff(starts[c : e + 1]))
            live = at < heads[of]
            own, left = seeds_of(c, e)
            items = np.concatenate([queue[at[live]], own])
            key = np.concatenate([2 * of[live], 2 * np.repeat(np.arange(c, e), np.diff(seed_at[c : e + 1])) + 1]) - 2 * c
            order = np.argsort(key.astype(np.uint16 if e - c < 1 << 15 else np.int64), kind="stable")  # short keys are radix-sorted
            items, key = items[order], (key[order] >> 1) + c
            if prefix is not None:
                left = np.concatenate([prefix[at[live]], left])[order]
            chars, prev, by = brought(items, 0)
            inside = chars[chars < e]
            batch = max(LEAST, batch // 2) if len(inside) else min(BATCH, batch * 2)
            if len(inside) and (e := int(inside.min())) > c:
                go = key[by] < e
                chars, prev, by = chars[go], prev[go], by[go]
            if e > c:
                q.enter(chars, prev, by, left[: np.searchsorted(key, e)] if left is not None else None)
                c = e
                continue
        done = starts[c]
        while done < heads[c]:
            s = slice(done, min(heads[c], done + step))
            done = s.stop
            q.enter(*brought(np.array(queue[s]), 0), np.array(prefix[s]) if prefix is not None else None)
        for i in range(seed_at[c], seed_at[c + 1], step):
            s = slice(i, min(i + step, seed_at[c + 1]))
            own, left = np.asarray(seeds[s]), None
            if prefix is not None:
                left = np.array(seed_prefix[s])
                if i == seed_at[c] and heads[c] > starts[c]:
                    left[0] = seams(queue[heads[c] - 1 : heads[c]], own[:1])[0]
            q.enter(*brought(own, 0), left)
        c += 1

    ends = heads  # of the larger suffixes of each queue
    q = _Queues(queue, prefix, fresh(1), -1, limit)
    tails = q.entry

    def join(b: int, c: int) -> None:
        """Prefixes of the first smaller suffix of queues b to c with the last larger one."""
        if prefix is None:
            return
        which = np.arange(b, c)
        which = which[(ends[b:c] > starts[b:c]) & (tails[b:c] < starts[b + 1 : c + 1] - 1)]
        if len(which):
            prefix[tails[which] + 1] = seams(queue[ends[which] - 1], queue[tails[which] + 1])
        which = np.arange(b, c)
        which = which[(ends[b:c] == starts[b:c]) & (tails[b:c] < starts[b + 1 : c + 1] - 1)]
        prefix[tails[which] + 1] = 0

    def behind(at: np.ndarray) -> np.ndarray | None:
        """Prefixes of what leaves from these places, in falling order, with what left before."""
        if prefix is None:
            return None
        out = np.zeros(len(at), np.uint8)
        some = at + 1 < n
        out[some] = prefix[at[some] + 1]
        return out

    c, batch = sigma, BATCH
    while c > 0:
        b = min(c - 1, int(np.searchsorted(starts, starts[c] - batch, "left")))
        if b < c - 1:
            at = np.arange(starts[c] - 1, starts[b] - 1, -1)
            of = np.repeat(np.arange(c - 1, b - 1, -1), np.diff(starts[b : c + 1])[::-1])
            live = (at > tails[of]) | (at < ends[of])
            at, key = at[live], of[live]
            chars, prev, by = brought(queue[at], 1)
            inside = chars[chars >= b]
            batch = max(LEAST, batch // 2) if len(inside) else min(BATCH, batch * 2)
            if len(inside) and (b := int(inside.max()) + 1) < c:
                go = key[by] >= b
                chars, prev, by = chars[go], prev[go], by[go]
            if b < c:
                join(b, c)
                q.enter(chars, prev, by, behind(at[: len(key) - np.searchsorted(key[::-1], b)]))
                c = b
                continue
        c -= 1
        done = starts[c + 1] - 1
        while done > tails[c]:
            low = max(tails[c], done - step)
            at = np.arange(done, low, -1)
            done = low
            q.enter(*brought(queue[at], 1), behind(at))
        join(c, c + 1)
        for i in range(ends[c], starts[c], -step):
            at = np.arange(i - 1, max(starts[c], i - step) - 1, -1)
            q.enter(*brought(queue[at], 1), behind(at))
    queue[0] = n - 1
    if prefix is not None:
        prefix[0] = 0


def _induce_small(code, seeds, seed_prefix, starts, queue, prefix) -> None:
    """The same for short strings, one suffix at a time: their queues hold few."""
    n = len(code)
    chars, small, out = (code >> 1).tolist(), (code & 1 == 1).tolist(), [-1] * n
    first, last = starts[:-1].tolist(), (starts[1:] - 1).tolist()
    heads, tails = list(first), list(last)
    shared = [0] * n
    for i, p in zip(reversed(seeds.tolist()), reversed(seed_prefix.tolist() if prefix is not None else [0] * len(seeds)), strict=True):
        c = chars[i]
        out[tails[c]], shared[tails[c]] = i, p
        tails[c] -= 1
    if prefix is None:
        for k in range(n):
            if (j := out[k] - 1) >= 0 and not small[j]:
                c = chars[j]
                out[heads[c]] = j
                heads[c] += 1
        for k in range(n - 1, -1, -1):
            if (j := out[k] - 1) >= 0 and small[j]:
                c = chars[j]
                out[last[c]] = j
                last[c] -= 1
        out[0] = n - 1
        queue[:] = out
        return

    def same(a: int, b: int) -> int:
        k = 0
        while k < CAP and chars[a + k] == chars[b + k]:
            k += 1
        return k

    # times, values: of the prefixes that no smaller one has followed, so the first after a time is the least since
    when, times, values, before = [-1] * len(first), [], [], -1
    for k in range(n):
        i = out[k]
        if i < 0:
            continue
        if before < 0 or chars[before] != chars[i]:
            p = 0
        else:
            p = same(before, i) if small[i] and not small[before] else shared[k]
        before = i
        while values and values[-1] >= p:
            values.pop()
            times.pop()
        values.append(p)
        times.append(k)
        if i and not small[i - 1]:
            c = chars[i - 1]
            at = heads[c]
            out[at] = i - 1
            shared[at] = min(CAP, values[bisect_right(times, when[c])] + 1) if at > first[c] else 0
            when[c] = k
            heads[c] = at + 1
    when, times, values, before, tails = [-1] * len(first), [], [], -1, list(last)
    for k in range(n - 1, -1, -1):
        i = out[k]
        if before < 0 or chars[before] != chars[i]:
            p = 0
        else:
            if small[before] and not small[i]:
                shared[k + 1] = same(i, before)
            p = shared[k + 1]
        before = i
        while values and values[-1] >= p:
            values.pop()
            times.pop()
        values.append(p)
        times.append(n - k)
        if i > 0 and small[i - 1]:
            c = chars[i - 1]
            at = tails[c]
            out[at] = i - 1
            if at < last[c]:
                shared[at + 1] = min(CAP, values[bisect_right(times, when[c])] + 1)
            when[c] = n - k
            tails[c] = at - 1
    queue[:], prefix[:] = out, shared
    prefix[starts[:-1][starts[:-1] < starts[1:]]] = 0


def _names(code, lms, order, limit: int) -> tuple[np.ndarray, int]:
    """Name of each leftmost smaller substring, in order of the text, and their number."""
    m = len(lms)
    names = allocate(m, np.int32 if m < 1 << 31 else np.int64, limit)
    count = 0
    for s in pieces(m, limit):
        begin = np.asarray(order[max(s.start - 1, 0) : s.stop])
        place = np.searchsorted(lms, begin)
        length = np.where(place + 1 < m, lms[np.minimum(place + 1, m - 1)] - begin + 1, 1)
        if s.start == 0:
            names[place[0]] = 0
        a, b, same, length, place = begin[:-1], begin[1:], length[1:] == length[:-1], length[1:], place[1:]
        live, k = np.nonzero(same)[0], 0
        while len(live):
            ok = code[a[live] + k] >> 1 == code[b[live] + k] >> 1
            same[live[~ok]] = False
            k += 1
            live = live[ok & (length[live] > k)]
        found = count + np.cumsum(~same)
        names[place] = found
        count = int(found[-1]) if len(found) else count
    return names, count + 1


def suffix_array(t: np.ndarray, limit: int = IN_MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of t, small non-negative integers whose last one, 0, occurs once, and
    the common prefix of each with the one before it, up to CAP."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    sigma = int(t.max()) + 1
    code = _coded(t, limit)
    starts = _bounds((code[s] >> 1 for s in pieces(n, limit)), sigma, limit)
    lms = _leftmost(code, limit)
    m = len(lms)
    seed_at = _bounds((code[lms[s]] >> 1 for s in pieces(m, limit)), sigma, limit)
    kind = np.int64 if n > 1 << 31 else np.int32
    seeds, entry = allocate(m, kind, limit), allocate(sigma, np.int64, limit)
    entry[:] = seed_at[:-1]
    by_char = _Queues(seeds, None, entry, 1, limit)
    for s in pieces(m, limit):
        x = np.asarray(lms[s])
        by_char.enter(code[x] >> 1, x, np.arange(len(x)), None)
    queue, prefix = allocate(n, kind, limit), allocate(n, np.uint8, limit)

    def induce(seeds, seed_prefix, prefix) -> None:
        if n <= SMALL < limit:
            _induce_small(code, seeds, seed_prefix, starts, queue, prefix)
        else:
            _induce(code, seeds, seed_at, seed_prefix, starts, queue, prefix, limit)

    induce(seeds, None, None)
    order, at = allocate(m, np.int64, limit), 0
    for s in pieces(n, limit):
        x = np.asarray(queue[s])
        x = x[x > 0]
        x = x[(code[x] & 1 == 1) & (code[x - 1] & 1 == 0)]
        order[at : at + len(x)] = x
        at += len(x)
    names, k = _names(code, lms, order, limit)
    if k < m:
        ranks, common = suffix_array(names, limit)
    shared = allocate(m, np.uint8, limit)
    for s in pieces(m, limit):
        low = max(s.start - 1, 0)
        if k < m:
            y = np.asarray(ranks[low : s.stop])
            order[s] = lms[y[s.start - low :]]
            r = common[s][1 - (s.start - low) :].astype(np.int64)  # names in common
            span = lms[y[1:] + r] - lms[y[1:]]
            begin = lms[y]
        else:
            begin = np.asarray(order[low : s.stop])
            span = np.zeros(len(begin) - 1, np.int64)
        span = np.minimum(span, CAP)
        span = span + agree(code, begin[:-1] + span, begin[1:] + span, CAP - span)
        shared[s] = span if s.start else np.r_[0, span]
    induce(order, shared, prefix)
    return queue, prefix
