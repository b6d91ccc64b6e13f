"""SentencePiece encoding and decoding as weighted finite-state transduction.

Four machines are compiled from a model file:

* the normaliser, a deterministic transducer over characters: the dummy prefix on its first
  arc, the blank's sign for blanks, and states that swallow runs of blanks where the model
  squeezes them;
* the piece transducer, a trie whose arcs read characters; a state that ends a piece has an
  arc back to the start that writes the piece's id and weighs its negative score;
* the byte fallback, an arc at the start for every character that is no piece of its own,
  which writes the ids of its UTF-8 bytes (or the unknown id) and weighs more than any piece;
* the grammar, an acceptor of piece sequences. For unigram models it has one state and weighs
  nothing. Models of merged pairs rank merges, not paths: there the state is the last piece,
  pieces weigh nothing, and an arc weighs 0 if merging the two pieces' characters gives just
  these pieces again, else infinity. A sequence all of whose pairs weigh 0 is the model's own
  and the only one. Its arcs are compiled when first met.

An input is a linear acceptor. It is composed with the machines on demand, state by state,
and the tropical-semiring shortest path to the end is the encoding. The composed states are
(position, grammar state); every arc leads to a later position. For unigram models they are
relaxed in the order of positions, and of paths of equal weight the one with the longer last
piece wins. For merged pairs all finite weights are 0: Dijkstra's search goes on from the
state settled last, by its longest arc, and weighs a grammar arc only when it comes up.

The input is cut where no piece can cross, so that paths of the whole are paths of the parts
one after the other: before a blank that follows another character, around line ends if no
piece has one, and between two characters that follow each other in no piece. Parts seen
before are looked up. Of many texts, the parts that were not seen before are searched
abreast: each step takes the next waiting arc of every part that has not reached its end.
"""

from __future__ import annotations

import re
import struct
import sys
from array import array
from itertools import pairwise

import numpy as np

BLANK = "▁"
UNIGRAM, PAIRS = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Parts and pairs that a worker remembers before it starts anew.
MEMORY, PAIR_MEMORY, LONG_PART = 400_000, 500_000, 64
#: Characters of texts that are encoded together, parts searched abreast, and how few of them are left to be searched one by one.
TOGETHER, ABREAST, FEW = 1_000_000, 20_000, 24
#: Characters whose arcs are remembered together, and how many of such strings.
HEAD, HEADS = 4, 50_000
#: Bits of a character or symbol in a key; symbols are piece ids, then characters.
SHIFT = 21
NONE = (1 << SHIFT) - 1
INFINITY = float("inf")
#: Weights are multiples of 1 / GRAIN, so that sums are exact and ties are ties.
GRAIN = 1 << 24


def _fields(buf: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    i, n = 0, len(buf)

    def varint() -> int:
        nonlocal i
        x = s = 0
        while True:
            b = buf[i]
            i += 1
            x |= (b & 127) << s
            s += 7
            if b < 128:
                return x

    while i < n:
        tag = varint()
        if (kind := tag & 7) == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, buf[i : i + size]
            i += size


def _characters(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value is in the sorted keys, -1 if nowhere."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    at[keys[at] != wanted] = -1
    return at


def _equal(c: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the parts of c between the places at: the first of each kind of equal ones, and the kind of each."""
    begin, size = at[:-1], np.diff(at)
    inside = np.arange(len(c)) - np.repeat(begin, size)
    factor = np.random.default_rng(42).integers(1 << 63, size=int(size.max()), dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        key = np.add.reduceat((c + 1) * factor[inside], begin)
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    same = size == size[first][of]
    if same.all():
        same = c == c[np.repeat(begin[first][of], size) + inside]
    if not same.all():  # two kinds have one key
        return np.arange(len(begin)), np.arange(len(begin))
    return first, of


class _Parts(dict):
    """Ids of the parts seen lately: a part that is met again outlives the others."""

    def __init__(self, find, inside, find_many):
        self.find, self.inside, self.older, self.find_many = find, inside, {}, find_many
        self.pairs = np.sort(np.array([ord(x[0]) << SHIFT | ord(x[1]) for x in inside], np.int64))
        letters = sorted({ord(a) for x in inside for a in x})
        self.sort = None
        if len(letters) < 4000:  # else the table is too large
            self.sort = np.zeros(sys.maxunicode + 1, np.int32)
            self.sort[letters] = np.arange(1, len(letters) + 1)
            self.table = np.zeros((len(letters) + 1, len(letters) + 1), bool)
            self.table[self.sort[self.pairs >> SHIFT], self.sort[self.pairs & NONE]] = True

    def __missing__(self, part: str):
        ids = self.older.get(part)
        if ids is None:
            if self.inside.issuperset(map(str.__add__, part, part[1:])):
                ids = self.find(part)
            else:
                cuts = [i for i, x in enumerate(map(str.__add__, part, part[1:]), 1) if x not in self.inside]  # no piece holds both
                ids = b"".join([self[part[i:j]] for i, j in pairwise([0, *cuts, len(part)])])
        if len(part) <= LONG_PART:
            if 2 * len(self) >= MEMORY:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def many(self, text: str, ends: list[int]) -> list[np.ndarray]:
        """Ids of texts that stand in one string, cut wherever no piece can cross. Equal parts
        are looked up once, and what is not remembered is searched together."""
        if not text:
            return [np.zeros(0, np.int32)] * len(ends)
        c = _characters(text)
        cut = np.ones(len(c) + 1, bool)
        cut[1:-1] = ~self.held(c)
        cut[ends] = True
        at = np.flatnonzero(cut)
        first, of = _equal(c, at)
        starts, stops = at[first].tolist(), at[first + 1].tolist()
        parts = [text[i:j] for i, j in zip(starts, stops, strict=True)]
        found = [self.get(p) for p in parts]
        new = []
        for i, p in enumerate(parts):
            if found[i] is None:
                found[i] = self.older.get(p)
                if found[i] is None:
                    new.append(i)
                elif len(p) <= LONG_PART:
                    self[p] = found[i]
        for i, ids in zip(new, self.find_many([parts[i] for i in new]), strict=True):
            found[i] = ids
            if len(parts[i]) <= LONG_PART:
                self[parts[i]] = ids
        if 2 * len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin, n = (np.cumsum(sizes) - sizes)[of], sizes[of]
        stop = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), np.int32)[np.arange(stop[-1]) + np.repeat(begin - stop + n, n)]
        stop = np.r_[0, stop][np.searchsorted(at, ends)].tolist()
        return [ids[i:j] for i, j in pairwise([0, *stop])]

    def held(self, c: np.ndarray) -> np.ndarray:
        """Whether a piece holds each two characters that follow each other."""
        if self.sort is None:
            return _place(self.pairs, c[:-1] << SHIFT | c[1:]) >= 0
        k = self.sort[c]
        return self.table[k[:-1], k[1:]]


class Normaliser:
    """Deterministic transducer of a text's characters: (state, is blank) -> (output before the
    character's own, whether it is written, next state)."""

    START, TEXT, GAP = range(3)

    def __init__(self, dummy: bool, squeeze: bool):
        first = BLANK if dummy else ""
        if squeeze:
            self.arcs = {
                (self.START, True): ("", False, self.START), (self.START, False): (first, True, self.TEXT), (self.TEXT, True): ("", False, self.GAP),
                (self.TEXT, False): ("", True, self.TEXT), (self.GAP, True): ("", False, self.GAP), (self.GAP, False): (BLANK, True, self.TEXT)}
        else:
            self.arcs = {(q, blank): (first if q == self.START else "", True, self.TEXT) for q in (self.START, self.TEXT) for blank in (True, False)}

    def apply(self, text: str) -> str:
        out, state = [], self.START
        for at, c in enumerate(text):
            before, own, state = self.arcs[state, c == " "]
            out.append(before + (BLANK if c == " " else c) if own else before)
            if state == self.TEXT and self.arcs[state, True][1:] == (True, state):  # every arc is a loop from here on
                return "".join(out) + text[at + 1 :].replace(" ", BLANK)
        return "".join(out)


class Pieces:
    """The piece transducer and the byte fallback at its start."""

    def __init__(self, pieces: list[str], ids: dict[str, int], weight: list[float] | None):
        self.next: dict[int, int] = {}  # state << SHIFT | character -> state
        self.final = [-1]  # piece that ends in a state
        self.heads: dict[str, tuple] = {}  # arcs of the first HEAD characters
        self.arrays = None
        self.size, self.weight, self.longest = len(pieces), weight, max(map(len, ids), default=1)
        self.fallback = max(weight, default=0.0) + 10 if weight else 0.0
        for p, i in ids.items():
            state = 0
            for c in p:
                key = state << SHIFT | ord(c)
                if (to := self.next.get(key)) is None:
                    to = self.next[key] = len(self.final)
                    self.final.append(-1)
                state = to
            self.final[state] = i

    def head(self, s: str) -> tuple[tuple[tuple[int, int], ...], int | None]:
        """(length, symbol) of the paths that read no more than s, and the state after all of it."""
        out, state = [], 0
        for k, c in enumerate(s, 1):
            state = self.next.get(state << SHIFT | ord(c))
            if state is None:
                break
            if (i := self.final[state]) >= 0:
                out.append((k, i))
        if not out or out[0][0] != 1:
            out.insert(0, (1, self.size + ord(s[0])))
        return tuple(out), state

    def steps(self, s: str, at: int) -> tuple[tuple[int, int], ...]:
        """(length, symbol) of the paths from the start back to it that read s from at, shortest first."""
        found = self.heads.get(key := s[at : at + HEAD])
        if found is None:
            if len(self.heads) >= HEADS:
                self.heads.clear()
            found = self.heads[key] = self.head(key)
        out, state = found
        if state is not None:
            follow, final = self.next.get, self.final
            for k, c in enumerate(s[at + HEAD : at + self.longest], HEAD + 1):
                state = follow(state << SHIFT | ord(c))
                if state is None:
                    break
                if (i := final[state]) >= 0:
                    out = (*out, (k, i))
        return out

    def arcs(self, s: str, at: int) -> list[tuple[int, int]]:
        """The same with ends instead of lengths."""
        return [(at + k, x) for k, x in self.steps(s, at)]

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The trie's arcs as arrays: sorted state and character, next state; the piece that ends in each state."""
        if self.arrays is None:
            keys = np.fromiter(self.next, np.int64, len(self.next))
            order = np.argsort(keys)
            self.arrays = keys[order], np.fromiter(self.next.values(), np.int64, len(self.next))[order], np.array(self.final)
        return self.arrays

    def weigh(self, symbol: int) -> float:
        return self.weight[symbol] if symbol < self.size else self.fallback

    def __getstate__(self):
        return self.__dict__ | {"heads": {}, "arrays": None}


class Bigrams:
    """The grammar of models of merged pairs. Its state is the last symbol."""

    def __init__(self, pieces: list[str], ids: dict[str, int], score: list[float]):
        self.pieces, self.ids, self.score = pieces, ids, score
        self.known: dict[int, float] = {}
        self.keys, self.finite = np.zeros(0, np.int64), np.zeros(0, bool)  # the same as sorted arrays

    def text(self, symbol: int) -> str:
        return "" if symbol == NONE else self.pieces[symbol] if symbol < len(self.pieces) else chr(symbol - len(self.pieces))

    def merged(self, s: str) -> list[str]:
        """What merging makes of the characters of two pieces: best score first, then leftmost."""
        out = list(s)
        while len(out) > 1:
            best = min(((-self.score[i], k) for k in range(len(out) - 1) if (i := self.ids.get(out[k] + out[k + 1])) is not None), default=None)
            if best is None:
                break
            out[best[1] : best[1] + 2] = [out[best[1]] + out[best[1] + 1]]
        return out

    def arc(self, last: int, symbol: int) -> float:
        key = last << SHIFT | symbol
        weight = self.known.get(key)
        if weight is None:
            if len(self.known) >= PAIR_MEMORY:
                self.known.clear()
            a, b = self.text(last), self.text(symbol)
            stay = (not a or a + b not in self.ids) and self.merged(a + b) == ([a, b] if a else [b])  # two that make a piece don't stay apart
            weight = self.known[key] = 0.0 if stay else INFINITY
        return weight

    def arcs_finite(self, keys: np.ndarray, fresh: dict[int, bool]) -> np.ndarray:
        """Whether the arcs (last << SHIFT | symbol) weigh 0; those not in the arrays are added to fresh."""
        at = _place(self.keys, keys)
        out = self.finite[at] if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(at < 0)
        if len(new):
            ask, of = np.unique(keys[new], return_inverse=True)
            ask = ask.tolist()
            for key in ask:
                if key not in fresh:
                    fresh[key] = self.arc(key >> SHIFT, key & NONE) == 0
            out[new] = np.array([fresh[key] for key in ask])[of]
        return out

    def add(self, fresh: dict[int, bool]) -> None:
        if len(self.keys) >= PAIR_MEMORY:
            self.keys, self.finite = self.keys[:0], self.finite[:0]
        keys = np.r_[self.keys, np.fromiter(fresh, np.int64, len(fresh))]
        order = np.argsort(keys, kind="stable")
        self.keys, self.finite = keys[order], np.r_[self.finite, np.fromiter(fresh.values(), bool, len(fresh))][order]

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "keys": self.keys[:0], "finite": self.finite[:0]}


class Transducer:
    """Compiled from the bytes of a model file; a plain object that can be sent to workers."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        kinds, scores = [], []
        self.kind, self.dummy, squeeze, self.fallback = UNIGRAM, True, True, False
        for k, v in _fields(model):
            if k == 1:
                f = dict(_fields(v))
                self.pieces.append(f[1].decode())
                scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                kinds.append(f.get(3, NORMAL))
            elif k == 2:
                f = dict(_fields(v))
                self.kind, self.fallback = f.get(3, UNIGRAM), bool(f.get(35, 0))
            elif k == 3:
                f = dict(_fields(v))
                if f.get(2):
                    raise ValueError("a normaliser with a character map is not supported")
                self.dummy, squeeze = bool(f.get(3, 1)), bool(f.get(4, 1))
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or self.kind not in (UNIGRAM, PAIRS):
            raise ValueError("only unigram and pair-merging models of normal, control and byte pieces are supported")
        ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        if self.kind == UNIGRAM and any(scores[i] > 0 for i in ids.values()):
            raise ValueError("scores of a unigram model are logarithms of probabilities")
        self.normaliser = Normaliser(self.dummy, squeeze)
        self.machine = Pieces(self.pieces, ids, [round(-x * GRAIN) / GRAIN for x in scores] if self.kind == UNIGRAM else None)
        self.grammar = Bigrams(self.pieces, ids, scores) if self.kind == PAIRS else None
        self.bytes = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i, (p, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind == BYTE:
                self.bytes[int(p[3:5], 16)] = i
                self.byte_of[i] = int(p[3:5], 16)
        self.unknown = kinds.index(UNKNOWN)
        control = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        self.text_of = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else " ⁇ " if i == self.unknown else "" if i in control else p.replace(BLANK, " ") for i, p in enumerate(self.pieces)]
        self.high = frozenset(i for i, b in self.byte_of.items() if b > 127)
        self.splits = not any(BLANK in p.lstrip(BLANK) for p in ids)
        self.lines = not any("\n" in p for p in ids)
        self.inside = frozenset(p[i : i + 2] for p in ids for i in range(len(p) - 1))
        self._start()

    def _start(self) -> None:
        self.parts = _Parts(lambda part: self._encode(part) if part else b"", self.inside, self._encode_many)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "parts"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def shortest_path(self, s: str) -> tuple[float, list[int]]:
        """Weight and symbols of the tropical-semiring shortest path through s, the pieces, the
        byte fallback and the grammar."""
        if not s:
            return 0.0, []
        return self._by_weight(s) if self.grammar is None else self._by_distance(s, self.grammar)

    def _by_weight(self, s: str) -> tuple[float, list[int]]:
        """The grammar has one state, so the composed states are positions."""
        n, machine = len(s), self.machine
        best: list[tuple[float, int, int]] = [(INFINITY, 0, NONE)] * (n + 1)  # weight, from where, by which symbol
        best[0] = (0.0, 0, NONE)
        for at in range(n):  # positions are in topological order
            weight = best[at][0]
            for k, x in machine.steps(s, at):
                if (w := weight + machine.weigh(x)) < best[at + k][0]:
                    best[at + k] = (w, at, x)
        out, at = [], n
        while at:
            _, before, x = best[at]
            out.append(x)
            at = before
        return best[n][0], out[::-1]

    def _by_distance(self, s: str, grammar: Bigrams) -> tuple[float, list[int]]:
        """All finite weights are 0, so of the arcs that wait Dijkstra's search may take any: the
        longest from the state settled last. Its grammar arc is weighed only then."""
        n, steps, known = len(s), self.machine.steps, grammar.known.get
        symbols, back = [NONE], [0]  # of the states that are settled
        waiting: list[tuple[int, int, int]] = []  # end, symbol, from which state
        settled, at, here = set(), 0, 0
        while at < n:
            for k, x in steps(s, at):
                waiting.append((at + k, x, here))
            while True:
                end, x, before = waiting.pop()
                weight = known(symbols[before] << SHIFT | x)
                if weight is None:
                    weight = grammar.arc(symbols[before], x)
                if not weight and (state := end << SHIFT | x) not in settled:
                    break
            settled.add(state)
            at, here = end, len(symbols)
            symbols.append(x)
            back.append(before)
        out = []
        while here:
            out.append(symbols[here])
            here = back[here]
        return 0.0, out[::-1]

    def _abreast(self, parts: list[str], grammar: Bigrams) -> tuple[np.ndarray, list[int]]:
        """Symbols of the shortest paths of all parts, one after the other, and where each part's
        end. The same search in step: every part tries the longest arc that waits at its
        position; where none is left it goes back. All sequences of finite weight that end at a
        position are the model's own for what is before it, so a position is settled once."""
        keys, to, final = self.machine.table()
        deepest, base = self.machine.longest, self.machine.size
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        start = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        end = start + sizes
        c = np.full(int(end[-1]) + 1 + deepest, NONE, np.int64)  # NONE stands after each part: no arc reads it
        inner = np.ones(int(end[-1]) + 1, bool)
        inner[end] = False
        c[: len(inner)][inner] = _characters("".join(parts))
        n = len(inner)
        back, symbol, waiting = np.full(n, -1), np.full(n, NONE, np.int64), np.zeros(n, np.int64)
        length, arc = np.empty((n, deepest), np.int8), np.empty((n, deepest), np.int32)
        back[start] = start

        def arrive(at: np.ndarray) -> None:
            """The arcs that wait at positions, the longest last."""
            arc[at, 0] = base + c[at]  # unless it is a piece of its own
            length[at, 0] = waiting[at] = 1
            state, here = np.zeros(len(at), np.int64), at
            for d in range(deepest):
                found = _place(keys, state << SHIFT | c[here + d])
                state, here = to[found[found >= 0]], here[found >= 0]
                if not len(here):
                    return
                piece = final[state]
                p, piece = here[piece >= 0], piece[piece >= 0]
                k = waiting[p] if d else 0
                arc[p, k], length[p, k] = piece, d + 1
                waiting[p] = k + 1

        fresh: dict[int, bool] = {}
        at, active = start.copy(), np.arange(len(parts))
        arrive(at)
        while len(active) > FEW:
            here = at[active]
            left = waiting[here] - 1
            stuck = left < 0
            at[active[stuck]] = back[here[stuck]]
            going = active[~stuck]
            here, left = here[~stuck], left[~stuck]
            waiting[here] = left
            x = arc[here, left].astype(np.int64)
            there = here + length[here, left]
            ok = back[there] < 0
            ok[ok] = grammar.arcs_finite(symbol[here[ok]] << SHIFT | x[ok], fresh)
            going, here, there = going[ok], here[ok], there[ok]
            back[there], symbol[there], at[going] = here, x[ok], there
            arrived = there == end[going]
            arrive(there[~arrived])
            if arrived.any():
                active = active[at[active] != end[active]]
        if fresh:
            grammar.add(fresh)
        for i in active.tolist():
            before = start[i]
            for x in self._by_distance(parts[i], grammar)[1]:
                there = before + (len(self.pieces[x]) if x < base else 1)
                back[there], symbol[there], before = before, x, there
        last = np.zeros(n, bool)  # of a symbol of a path
        at = end
        while len(at):
            last[at] = True
            at = back[at]
            at = at[at != back[at]]
        last[start] = False
        return symbol[last], np.cumsum(last)[end].tolist()

    def _encode_many(self, parts: list[str]) -> list[bytes]:
        """Ids of each part."""
        if self.grammar is None or self.machine.longest > LONG_PART or len(parts) <= FEW:
            return [self._encode(p) if p else b"" for p in parts]
        out = []
        for i in range(0, len(parts), ABREAST):
            some = parts[i : i + ABREAST]
            short = [p for p in some if 0 < len(p) <= LONG_PART]
            symbols, ends = self._abreast(short, self.grammar) if short else (np.zeros(0, np.int64), [])
            written, unusual = symbols.astype(np.int32).tobytes(), np.r_[0, np.cumsum(symbols >= len(self.pieces))]
            begin, of = 0, {}
            for p, end, special in zip(short, ends, np.diff(unusual[[0, *ends]]).tolist(), strict=True):
                of[p] = self._write(symbols[begin:end].tolist()) if special else written[4 * begin : 4 * end]
                begin = end
            out += [of[p] if p in of else self._encode(p) if p else b"" for p in some]
        return out

    def _encode(self, s: str) -> bytes:
        """Ids of a part, as int32: what the arcs of its shortest path write."""
        return self._write(self.shortest_path(s)[1])

    def _write(self, symbols: list[int]) -> bytes:
        out: list[int] = []
        for x in symbols:
            if x < len(self.pieces):
                out.append(x)
            elif self.fallback:
                out += [self.bytes[b] for b in chr(x - len(self.pieces)).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return array("i", out).tobytes()

    def encode_array(self, text: str) -> np.ndarray:
        """Piece ids of a whole text (int32); none for an empty one."""
        text = self.normaliser.apply(text)
        if not text:
            return np.zeros(0, np.int32)
        if self.splits and self.lines and BLANK + BLANK not in text and " " not in text:
            parts = text.replace(BLANK, " " + BLANK).replace("\n", " \n ").split(" ")
        elif self.splits:
            parts = re.findall(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n" if self.lines else f"{BLANK}*[^{BLANK}]+|{BLANK}+", text)
        else:
            parts = [text]
        return self._tidy(np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), np.int32))

    def _tidy(self, ids: np.ndarray) -> np.ndarray:
        if not self.fallback and len(ids):  # a run of unknown characters is one id, across parts as well
            ids = ids[np.r_[True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)]]
        return ids

    def encode_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """The same of many texts, whose new parts are searched together."""
        out, held, ends, size = [], [], [], 0
        for i, text in enumerate(texts, 1):
            held.append(self.normaliser.apply(text))
            size += len(held[-1])
            ends.append(size)
            if size >= TOGETHER or i == len(texts):
                out += map(self._tidy, self.parts.many("".join(held), ends))
                held, ends, size = [], [], 0
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def decode(self, ids) -> str:
        """The text of piece ids; bytes that are not UTF-8 become U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        if self.high.isdisjoint(ids):
            text = "".join(map(self.text_of.__getitem__, ids))
        else:
            out, held = [], bytearray()
            for i in ids:
                if (b := self.byte_of.get(i)) is not None:
                    held.append(b)
                    continue
                if held:
                    out.append(held.decode("utf-8", "replace"))
                    held.clear()
                out.append(self.text_of[i])
            out.append(held.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if self.dummy and text.startswith(" ") else text


def load(path: str | None = None) -> Transducer:
    """A transducer of the model file at path, or of the public one with 32,000 pieces."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return Transducer(f.read())
