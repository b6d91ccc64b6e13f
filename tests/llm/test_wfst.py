"""The transducers against the library and against all paths."""

from __future__ import annotations

import random
import struct
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from veristrata.llm import wfst


def field(number: int, value) -> bytes:
    if isinstance(value, int):
        return bytes([number << 3 & 127 | (128 if number > 15 else 0), *([number >> 4] if number > 15 else []), value])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    size, out = len(value), []
    while True:
        out.append(size & 127 | (128 if size > 127 else 0))
        size >>= 7
        if not size:
            return bytes([number << 3 | 2, *out]) + value


def model(pieces, kind=1, fallback=False, dummy=True, squeeze=True) -> bytes:
    """A model file by hand: (piece, score) after the unknown and control pieces."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if fallback] + [(p, s, 1) for p, s in pieces]
    out = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in rows)
    return out + field(2, field(3, kind) + field(35, int(fallback))) + field(3, field(1, b"identity") + field(3, int(dummy)) + field(4, int(squeeze)) + field(5, 1))


def pieces_of(r: random.Random, n: int):
    chars = "abcde\u2581é你"
    out = {c: 0 for c in chars}
    while len(out) < n:
        out["".join(r.choice(chars) for _ in range(r.randrange(2, 6)))] = 0
    return [(p, -r.uniform(0.5, 12.0)) for p in out]


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram(fallback, squeeze):
    """Ids are the library's, and the path's weight is the least of all paths'."""
    r = random.Random(11 + squeeze)
    for _ in range(6):
        raw = model(pieces_of(r, 60), 1, fallback, r.random() < 0.7, squeeze)
        lib, m = sentencepiece.SentencePieceProcessor(model_proto=raw), wfst.Transducer(raw)
        texts = ["", " ", "  a  b ", "xyz", "éé你 你", "a" * 300] + ["".join(r.choice("abcde é你xy\u00fc") for _ in range(r.randrange(60))) for _ in range(150)]
        for t in texts:
            assert m.encode(t) == lib.encode(t), t
        for t in texts[6:40]:
            s = m.normaliser.apply(t)[:9]

            @cache
            def least(at, s=s):
                return 0.0 if at == len(s) else min(m.machine.weigh(x) + least(e) for e, x in m.machine.arcs(s, at))

            weight, path = m.shortest_path(s)
            assert weight == pytest.approx(least(0)) and "".join(m.pieces[x] if x < len(m.pieces) else chr(x - len(m.pieces)) for x in path) == s


def test_merged_pairs_have_one_path():
    """Every path through pieces and grammar, by enumeration: one of weight 0, which is merging's own."""
    r = random.Random(5)
    m = wfst.load()
    words = [m.pieces[r.randrange(300, 32000)] for _ in range(400)]
    for _ in range(300):
        s = ("".join(r.choices(words, k=2)) + r.choice(["", "7", "é", "zq"]))[:10]

        def paths(at, last, s=s):
            if at == len(s):
                yield []
            for e, x in m.machine.arcs(s, at) if at < len(s) else ():
                if m.grammar.arc(last, x) == 0:
                    yield from ([x, *rest] for rest in paths(e, x))

        found = list(paths(0, wfst.NONE))
        assert len(found) == 1 and m.shortest_path(s) == (0.0, found[0])
        assert [m.grammar.text(x) for x in found[0]] == m.grammar.merged(s)


def test_normaliser():
    assert wfst.Normaliser(True, True).apply("  a  b ") == "▁a▁b" and wfst.Normaliser(True, True).apply("   ") == ""
    assert wfst.Normaliser(True, False).apply(" a  b") == "▁▁a▁▁b" and wfst.Normaliser(False, False).apply(" a") == "▁a" and wfst.Normaliser(True, False).apply("") == ""


def test_refused_models():
    for raw in (model([("a", 1.0)]), model([("a", -1.0)], kind=3), field(3, field(2, b"map"))):
        with pytest.raises(ValueError):
            wfst.Transducer(raw)
    assert wfst.Transducer(model([("a", 1.0)], kind=2)).encode("a") and public_tokenizers.path("piece_bpe_32k.model")


def test_many_texts_are_searched_abreast(monkeypatch):
    """Ids are the library's, and few of the new parts are searched one by one."""
    r = random.Random(7)
    lib, m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), wfst.load()
    syllables = ["th", "on", "ti", "er", "ße", "éa", "ing", "E", "***", "7", "你好", "ж", "\U0001f600", "\x00", ",", "."]
    texts = [" ".join("".join(r.choices(syllables, k=r.randrange(1, 9))) for _ in range(r.randrange(40))) + r.choice(["", "\n", "  ", " \u2581\u2581x"]) for _ in range(400)]
    texts += ["", " ", "\n\n", "ab" * 300, "the " * 50, "q" * 65]
    searched = []
    monkeypatch.setattr(wfst.Transducer, "_by_distance", lambda self, s, g, own=wfst.Transducer._by_distance: searched.append(s) or own(self, s, g))
    monkeypatch.setattr(wfst, "MEMORY", 3000)
    monkeypatch.setattr(wfst, "PAIR_MEMORY", 400)
    assert [i.tolist() for i in m.encode_arrays(texts)] == lib.encode(texts)
    assert len(searched) < 100 and len({w for t in texts for w in t.split()}) > 5000
    for size in (1, 50, 5000):
        monkeypatch.setattr(wfst, "TOGETHER", size)
        assert [i.tolist() for i in m.encode_arrays(texts[:60])] == lib.encode(texts[:60])
    assert m.encode_arrays([]) == []


@pytest.mark.parametrize("fallback", [False, True])
def test_many_texts_by_models_made_by_hand(fallback):
    r = random.Random(3)
    for kind in (1, 2):
        m = wfst.Transducer(model(pieces_of(r, 60), kind, fallback))
        texts = ["".join(r.choice("abcde é你xy\u00fc") for _ in range(r.randrange(60))) for _ in range(300)]
        assert [i.tolist() for i in m.encode_arrays(texts)] == [wfst.Transducer.encode(m, t) for t in texts]
        one = wfst.Transducer(model([("a", -1.0)], kind, fallback))
        assert [i.tolist() for i in one.encode_arrays(texts)] == [one.encode(t) for t in texts]


def test_parts_with_one_key_are_told_apart(monkeypatch):
    class Ones:
        def integers(self, low, size, dtype):
            return np.ones(size, dtype)

    monkeypatch.setattr(np.random, "default_rng", lambda seed: Ones())
    m, texts = wfst.load(), ["ab ba", "ba ab", "abc cab", "ab", ""]
    assert [i.tolist() for i in m.encode_arrays(texts)] == [m.encode(t) for t in texts]
