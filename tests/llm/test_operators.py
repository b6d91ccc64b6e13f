"""Operators against brute force on small tables with nulls, empties, ties and repeats."""

import hashlib
import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from veristrata.llm import common, ctph, induced, lm_score, mixing, queries, repeats, simhash, tokens, toxicity, url_filter, vectors, wfst
from veristrata.llm.components import connected_components, stars

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score long"
TEXTS = [(1, "the quick brown fox jumps over the lazy dog " * 9), (2, "the quick brown fox jumps over the lazy dog " * 9), (3, None), (4, ""), (5, " \t\n "), (6, "a" * 3000), (7, "word"), (7, "word"), (None, "no id here at all"),
         (9, "é ü 你好 " * 60), (10, "x" * 99 + " The Quick brown fox jumps " + "y" * 300)]


@pytest.fixture
def docs(spark):
    common.prepare(spark)
    rows = [(i, t, "en", s, len(t or ""), "k", 1) for (i, t), s in zip(TEXTS, ["a", "b", None, "a", "b", "c", "a", "a", None, "B", "a"], strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(pairs, nodes):
    root = stars([*pairs, *((n, n) for n in nodes)])
    return {n: root[n] for n in nodes}


@pytest.mark.parametrize("small", [0, 10_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr("veristrata.llm.components.SMALL", small)
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(900, k) for k in range(901, 950)] + [(None, 1), (5, 5)]
    want = groups([e for e in edges if None not in e], {x for e in edges if None not in e and e[0] != e[1] for x in e})
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors(spark):
    common.prepare(spark)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] + rng.normal(size=8) * rng.choice([0.0, 0.15, 0.5])).tolist(), int(i % 12 % 2)) for i in range(150)]
    odd = [(200, None, 0), (201, [0.0] * 8, 0), (202, [float("nan")] * 8, 0), (203, [1.0, None] * 4, 0), (204, rows[0][1], None), (205, [], 0), (206, rows[0][1], 0), (206, rows[0][1], 0), (None, rows[0][1], 0), (207, [1.0, 2.0], 0), (208, [1.0, 2.0, 3.0], 0), (208, [3.0, -2.0, 1.0], 0)]
    got = {}
    for r in vectors.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int"), block=20).collect():
        got.setdefault(r.vec_id, []).append(tuple(r)[1:])
    fine = [r for r in rows + odd if r[0] is not None and r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    unit = [np.array(r[1]) / np.linalg.norm(r[1]) for r in fine]
    link = [(i, j) for i in range(len(fine)) for j in range(len(fine)) if i != j and fine[i][2] == fine[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    root = groups([(fine[i][0], fine[j][0]) for i, j in link], {r[0] for r in fine})
    assert len(link) > 100
    for i, r in enumerate(fine):
        assert got[r[0]][0] == (sum(a == i for a, _ in link), root[r[0]], r[0] == root[r[0]])
    assert got[200] == [(0, 200, True)] and got[204] == [(0, 204, True)] and got[None] == [(0, None, False)] and len(got[206]) == 2 and got[208] == [(0, 208, True)] * 2
    a = rng.normal(size=(40, 33))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    near, bound = vectors.products(vectors.quantise(a), vectors.quantise(a))
    assert (np.abs(near - a @ a.T) <= bound).all() and bound.max() < 0.1
    for t in (-0.2, 0.1, 0.4):
        found = [(i, j, s) for x in vectors.tile_pairs(vectors.quantise(a), 40, True, t) for i, j, s in zip(*(c.tolist() for c in x), strict=True)]
        true = {(i, j) for i in range(40) for j in range(i + 1, 40) if a[i] @ a[j] >= t}
        assert {x[:2] for x in found if x[2]} <= true <= {x[:2] for x in found} and any(not x[2] for x in found)
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int, codes int, rep int, v string")).count() == 0


def test_simhash(spark, docs, nothing, monkeypatch):
    assert simhash.fingerprint(b"") == 0 == simhash.fingerprint(b" \n\x0b")
    assert simhash.fingerprint(b"A b C d") == simhash.fingerprint(b"a\tb c d") != 0
    r = random.Random(1)
    seeds = [r.getrandbits(64) for _ in range(60)]
    fps = sorted({s ^ sum({1 << r.randrange(64) for _ in range(r.randrange(6))}) for s in seeds for _ in range(8)} | {seeds[0] ^ (1 << k) for k in range(24)})
    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3]
    want = groups(near, fps)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fps)], "fp long, rep long")
    for hot, pairwise, at_once in ((2048, 16384, 50), (2048, 16384, 10**6), (1, 16384, 10**6), (1, 2, 10**6)):
        monkeypatch.setattr(simhash, "PAIRS", at_once)
        monkeypatch.setattr(simhash, "HOT", hot)
        monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
        found = [(fps[e.u], fps[e.v]) for e in simhash.links(frame).collect()]
        assert set(found) <= {x for p in near for x in (p, p[::-1])} or all(want[a] == want[b] for a, b in found)
        assert groups(found, fps) == want
    # the tally against all pairs of a list: it rejects pairs that share the key only, before any bit is counted
    positions, low = np.array([sorted({*range(8)} - {*simhash.KEYS[0]})] * 300), np.uint64((1 << 40) - 1)
    alike = np.array([r.getrandbits(40) for _ in range(20)], np.uint64)
    members = (np.array([r.choice(alike) for _ in range(300)], np.uint64) ^ np.array([r.getrandbits(40) & r.getrandbits(40) & r.getrandbits(40) for _ in range(300)], np.uint64)) & low
    lists = np.sort(np.array([r.randrange(4) for _ in range(300)]))
    i, j = simhash.tally(lists, positions, members)
    by = members.astype(">u8").view(np.uint8).reshape(-1, 8)
    pairs = [(a, b) for a in range(300) for b in range(a + 1, 300) if lists[a] == lists[b]]
    enough = [(a, b) for a, b in pairs if (by[a] == by[b]).sum() >= 5]
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == enough and 0 < len(enough) < len(pairs) // 4
    near = simhash.close(members, i, j)
    assert 0 < near.sum() < len(near) and near.sum() == sum(int(members[a] ^ members[b]).bit_count() <= 3 for a, b in pairs)
    for t in [t or "" for _, t in TEXTS] + ["A B  c", "é x", "a b c d a b c d"]:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
        h = [xxhash.xxh64(b" ".join(w[k : k + 3]), seed=42).intdigest() for k in range(max(1, len(w) - 2))] if w else []
        assert simhash.fingerprint(t.encode()) == sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    got = [tuple(x) for x in simhash.simhash_groups(docs).collect()]
    comp = {}
    for i, _, c in got:
        comp.setdefault(i, []).append(c)
    assert len(got) == len(TEXTS) and comp[2] == [1] and comp[3] == comp[4] == comp[5] == [3] and comp[7] == [7, 7] and comp[None] == [None]
    assert simhash.simhash_groups(nothing).count() == 0


def test_tokens(spark, docs, nothing):
    for n in (1, 2, 3, 10, 257, 5000):
        assert sorted(tokens.permute(np.arange(n), n).tolist()) == list(range(n))
    machine = tokens.load()
    got = tokens.materialise_order(docs).collect()
    want = sorted((i if i is not None else -1, k // 256, hashlib.sha256(np.array(ids[k : k + 256], "<u2").tobytes()).hexdigest()) for i, t in TEXTS for ids in [machine.encode_ordinary(t or "")] for k in range(0, max(1, len(ids)), 256))
    assert sorted((r.doc_id, r.seq, r.tokens_sha256) for r in got) == want
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert {(r.slot, r.tokens_sha256) for r in tokens.materialise_order(docs.repartition(3)).collect()} == {(r.slot, r.tokens_sha256) for r in got}
    assert tokens.materialise_order(nothing).count() == 0


def test_tokens_resume(spark, docs):
    """From any slot on, the records are those of the whole, and files are entered by a seek."""
    common.prepare(spark)
    machine = tokens.load()
    path = common.new_path(spark, "resume")
    manifest = tokens.write_shards(tokens.sequences(docs, machine, length=16, shard_text=500), path, 16)
    files = sorted(manifest.collect())
    size, first = tokens.stride(16), 0
    assert len(files) > 5 and [f.shard for f in files] == sorted({f.shard for f in files})
    for f in files:
        data = open(f.file.removeprefix("file://"), "rb").read()
        assert f.first_slot == first and len(data) == f.n_slots * size and hashlib.sha256(data).hexdigest() == f.sha256
        first += f.n_slots
    whole = sorted(tuple(r) for r in tokens.read_shards(manifest, length=16, read=3).collect())
    assert [r[0] for r in whole] == list(range(first))
    want = {(i if i is not None else -1, t or "") for i, t in TEXTS}
    text = {}
    for _, _, _, doc, seq, n, ids in whole:
        assert n * 2 == len(ids)
        text.setdefault(doc, []).append((seq, ids))
    for i, t in want:
        if sum(i == x for x, _ in want) == 1 and i != 7:  # 7 is there twice
            assert machine.decode(np.frombuffer(b"".join(x for _, x in sorted(text[i])), "<u2").tolist()) == t
    for slot in (1, files[2].first_slot, files[2].first_slot + 1, first - 1, first):
        assert sorted(tuple(r) for r in tokens.read_shards(manifest, slot, 16, 3).collect()) == whole[slot:]

    some = tokens.read_shards(manifest, files[3].first_slot + 1, 16).select("shard").distinct().collect()
    assert {r.shard for r in some} <= {f.shard for f in files[3:]}


def test_sentencepiece(spark, docs, nothing):
    import public_tokenizers

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    m = wfst.load()
    r = random.Random(2)
    texts = [t or "" for _, t in TEXTS] + ["  a  b ", "▁x y", "\n\n a\tb", "naïve 你好 ﬁ ​😀😀", "a\r\nb", "<s></s><unk><0x41>", "x" * 2000]
    texts += ["".join(r.choice("abcdefgh .,\n 'éß你▁1") for _ in range(r.randrange(200))) for _ in range(300)]
    for t in texts:
        assert m.encode(t) == lib.encode(t)
        assert m.decode(m.encode(t)) == lib.decode(lib.encode(t)) == t.replace("▁", " ")
    old, wfst.MEMORY = wfst.MEMORY, 5
    assert [m.encode(t) for t in texts] == [lib.encode(t) for t in texts]
    wfst.MEMORY = old
    rows = queries.sentencepiece_ids(docs).collect()
    assert len(rows) == len(TEXTS) and all(x.round_trip for x in rows)
    assert queries.sentencepiece_ids(nothing).count() == 0
    with pytest.raises(ValueError):
        wfst.Transducer(b"\x1a\x04\x12\x02ab")


@pytest.mark.parametrize("hot, group", [(1000, 1000), (1, 1000), (1000, 2), (1000, 4)])
@pytest.mark.parametrize("ids", [[1, 1, 7, None], []])
def test_lm_score(spark, docs, nothing, monkeypatch, hot, group, ids):
    monkeypatch.setattr(lm_score, "HOT", hot)
    target = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    texts = [(i, (t or "").encode().lower().split()) for i, t in TEXTS]
    words, pairs, starts = ([Counter(), Counter()] for _ in range(3))
    for i, w in texts:
        for m in (0, 1) if i in ids and i is not None else (0,):
            words[m].update(w)
            pairs[m].update(zip([None, *w], w))
            starts[m][None] += bool(w)
    n = [sum(c.values()) for c in words]

    def loss(i, w, m):
        scale, out = (1.0 if m or not n[1] else n[1] / n[0]), []
        own, twos = (Counter(w), Counter(zip([None, *w], w))) if not m or i in ids and i is not None else ({}, {})
        for u, v in zip([None, *w], w):
            p = ((words[m][v] - own.get(v, 0)) * scale + lm_score.UNSEEN) / (n[m] * scale + lm_score.UNSEEN * (n[1] or n[0]))
            before = starts[m][None] - bool(own) if u is None else words[m][u] - own.get(u, 0)
            out.append(-math.log(((pairs[m][u, v] - twos.get((u, v), 0)) * scale + lm_score.PRIOR * p) / (before * scale + lm_score.PRIOR)))
        return sum(out) / len(out)

    want = [(i, len(w), *((a := loss(i, w, 1), b := loss(i, w, 0), b - a) if w else (None, None, 0.0))) for i, w in texts]
    rows = lm_score.score(docs, target, block=300, bucket=50, group=group).collect()
    by = lambda r: (r[0] is None, r[0] or 0)
    assert len(rows) == len(want)
    for r, x in zip(sorted(rows, key=by), sorted(want, key=by), strict=True):
        assert tuple(r)[:2] == x[:2] and tuple(r)[2:] == (None, None, 0.0) if x[2] is None else tuple(r) == pytest.approx(x)
    assert lm_score.score(nothing, target).count() == 0


def test_url_filter(spark):
    common.prepare(spark)
    urls = ["http://Example.org/es/1?q#f", "http://a.example.org/en/12", "http://notexample.org/en/12", "https://x.COM/fr/1", "http://x.com/de/", "http://x.com/DE/", "http://org", "http://org/", "ftp://É.org/x", None, "", "nothing", "http://", "http://a..org/x", "http://example.org?x/es/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0])]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    rules = spark.createDataFrame([*queries.URL_RULES, (None, "/", "block")], "host string, path string, verdict string")

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = rest[:cut].translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
        path = rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"

    got = [tuple(r) for r in url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted([(i, *judge(u)) for i, u in rows], key=str)
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0), "block").collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_ctph(spark, docs, nothing, monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(500)]
    a, b = (" ".join(r.choice(words) for _ in range(800)) for _ in range(2))
    near = ctph.likeness(ctph.fingerprint(a.encode()), ctph.fingerprint(ctph.edit(a, b).encode()))
    assert near > 0.5 and ctph.likeness(ctph.fingerprint(a.encode()), ctph.fingerprint(b.encode())) < 0.1
    assert ctph._common("abcbdab", "bdcaba") == 4 and ctph.likeness("3:ab:c", "12:ab:c") == 0.0
    rows = TEXTS + [(7, "word")] * 9 + [(11, f"text {i} of one id") for i in range(7)] + [(None, f"another without an id {i}") for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    digest = {(x.t or ""): x.h for x in frame.select(F.col("text").alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ordered = sorted(((i if i is not None else -(10**9), t or "") for i, t in rows), key=lambda x: (-x[0], digest[x[1]]))
    want = []
    for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        e = (t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]).encode()
        f, g, h = (naive_fingerprint(x) for x in (t.encode(), e, nxt.encode()))
        want.append((i if i > -(10**9) else None, len(t), hashlib.sha256(e).hexdigest(), f, g, naive_likeness(f, g), naive_likeness(f, h)))
    for per in (1000, 2):
        monkeypatch.setattr(ctph, "PER_BUCKET", per)
        got = [tuple(x) for x in ctph.compare_with_next(frame.repartition(1 + per % 7)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert ctph.compare_with_next(nothing).count() == 0 and ctph.compare_with_next(docs.limit(1)).count() == 1
    for data in (b"x", b"ab" * 400, a.encode(), bytes(range(256)) * 9, r.randbytes(5000), b"\0" * 700):
        assert ctph.fingerprint(data) == naive_fingerprint(data)
    k, t = np.array([5, 5, -3, ctph.NO_ID, 2**62]), np.array([1, -1, 7, 0, 3])
    assert np.argsort(ctph._keys(k, t)).tolist() == [4, 1, 0, 2, 3]


def naive_fingerprint(data: bytes) -> str:
    """Byte by byte, with a window that rolls."""
    size = 3
    while size * 64 < len(data):
        size *= 2
    if not data:
        return f"{size}::"
    while True:
        out = []
        for block in (size, 2 * size):
            window, total, weighted, shifted, start, sign = [0] * 7, 0, 0, 0, 0, ""
            ends = 0
            for at, c in enumerate(data):
                weighted = (weighted - total + 7 * c) % 2**32
                total += c - window[at % 7]
                window[at % 7] = c
                shifted = 0
                for j in range(7):
                    shifted ^= (window[(at - j) % 7] << 5 * j) % 2**32
                if (total + weighted + shifted + 1) % 2**32 % block == 0:
                    ends += 1
                    if len(sign) < 63:
                        sign += ctph.ALPHABET[xxhash.xxh32(data[start : at + 1]).intdigest() & 63]
                        start = at + 1
            if start < len(data):
                sign += ctph.ALPHABET[xxhash.xxh32(data[start:]).intdigest() & 63]
            out.append((ends, sign))
        if out[0][0] + 1 >= 32 or size == 3:
            return f"{size}:{out[0][1]}:{out[1][1]}"
        size //= 2


def naive_likeness(x: str, y: str) -> float:
    def edits(a, b):  # insertions and deletions, by the table
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], last if c == d else 1 + min(row[j], row[j - 1])
        return row[-1]

    def score(a, b):
        if not a or not b or min(len(a), len(b)) >= 7 and not any(a[i : i + 7] in b for i in range(len(a) - 6)):
            return 0.0
        return (len(a) + len(b) - edits(a, b)) / (len(a) + len(b))

    if x == y:
        return 1.0
    (m, a, b), (n, c, d) = x.split(":"), y.split(":")
    found = [score(p, q) for k, p in ((int(m), a), (2 * int(m), b)) for h, q in ((int(n), c), (2 * int(n), d)) if k == h]
    return max(found, default=0.0)


def test_toxicity(spark, docs, nothing, monkeypatch):
    common.prepare(spark)
    r = random.Random(5)
    plain, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)], ["scumword", "idioty", "wretched"]
    rows = [(i, " ".join([r.choice(plain) for _ in range(60)] + ([r.choice(bad) for _ in range(4)] if i % 4 == 0 else [])), i % 4 == 0) for i in range(600)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(x)) for i, _, x in rows), (1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    assert set(bad) <= set(model.lexicon)
    got = toxicity.score(frame, model).withColumn("h", toxicity.held_out(F.col("doc_id"))).where("h").collect()
    assert got and all(x.predicted == int(x.doc_id % 4 == 0) for x in got)
    some = toxicity.score(docs, model, "source").collect()
    assert len(some) == len(TEXTS) and all(0 <= x.score <= 1 for x in some)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels.limit(0))).count() == 0
    # repeated rows don't multiply what is sent to the driver
    many = spark.range(6000).selectExpr("id % 2 as doc_id", "if(id % 2 = 0, 'scumword you', 'plain word') as text")
    two = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    assert toxicity._labelled(many, two, 20_000).count() <= 2 and 0 <= toxicity.score(many, toxicity.fit(many, two)).agg(F.max("score")).first()[0] <= 1
    texts = spark.range(500).selectExpr("1L as doc_id", "concat('w', id) as text")
    assert toxicity._labelled(texts, two, 30).count() == 30
    # a word that only one fold has can't help to score that fold
    rows = toxicity._labelled(frame, labels, 20_000)
    only = rows.where("fold = 0 and toxic = 1").withColumn("text", F.concat("text", F.lit(" onlyhere onlyhere")))
    lexicons = toxicity._lexicons(rows.where("not (fold = 0 and toxic = 1)").union(only))
    assert "onlyhere" in lexicons[0] and "onlyhere" not in lexicons[1] and "onlyhere" in lexicons[2]
    # a tree's splits against all splits
    g = np.random.default_rng(4)
    x = g.integers(0, 6, (80, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (g.random(80) < 0.1)).astype(float)
    monkeypatch.setattr(toxicity, "TREES", 1)
    monkeypatch.setattr(toxicity, "DEPTH", 1)
    tree = toxicity.grow(x, y)
    p = np.full(80, y.mean())
    gain = {}
    for j in range(3):
        for e in range(5):
            left = x[:, j] <= e
            if min(left.sum(), (~left).sum()) >= 5:
                gain[j, e] = sum((y - p)[m].sum() ** 2 / ((p * (1 - p))[m].sum() + 1) for m in (left, ~left))
    j, e = max(gain, key=gain.get)
    assert tree.feature[0, 0] == j and ((x[:, j] <= tree.edge[0, 0]) == (x[:, j] <= e)).all()
    leaf = [toxicity.RATE * (y - p)[m].sum() / ((p * (1 - p))[m].sum() + 1) for m in (x[:, j] <= e, x[:, j] > e)]
    assert tree.value[0] == pytest.approx(leaf) and tree.raw(x) == pytest.approx(tree.base + np.where(x[:, j] <= e, *leaf))
    raw, flags = g.normal(size=60), (g.random(60) < 0.4).astype(float)
    at, level = toxicity.isotonic(raw, flags)
    order = np.argsort(raw)
    ranked = flags[order]
    fit = [max(min(ranked[a : b + 1].mean() for b in range(k, 60)) for a in range(k + 1)) for k in range(60)]  # by the min-max formula
    assert sorted(set(np.round(fit, 12))) == pytest.approx(np.unique(np.round(level, 12)).tolist())
    x, y = toxicity.isotonic(np.array([3.0, 1, 2, 4]), np.array([0.0, 0, 1, 1]))
    assert (np.diff(y) > 0).all() and y.tolist() == [0.0, 0.5, 1.0]


def test_mixing(spark, docs, nothing):
    common.prepare(spark)
    r = random.Random(6)
    rows = [(i, " ".join("w" * r.randrange(1, 5) for _ in range(r.randrange(900))), f"s{min(i % 7, 3)}" if i % 11 else None) for i in range(300)] + [(1, "same words", "s1")] * 2 + [(None, None, "empty")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken(frame)
    rows_out = sorted(map(tuple, got.collect()), key=str)
    assert len(rows_out) == len(rows) and rows_out == sorted(map(tuple, mixing.taken(frame.repartition(5)).collect()), key=str)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, total = {}, set(order), 1.5 * sum(size.values())
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        free -= over
    per = {}
    for d in got.collect():
        assert 0 <= d.taken <= 2 * d.size
        per.setdefault((d.source_size, round(d.target, 6)), []).append(d.taken)
    assert {k: sum(v) for k, v in per.items()} == {(size[s], round(target[s], 6)): int(target[s] + 0.5) for s in order}
    mixed = mixing.mixed_documents(frame)
    assert mixed.agg(F.sum(common.word_count(F.col("text")))).first()[0] == sum(x[4] for x in rows_out) and mixed.columns == frame.columns
    assert mixing.taken(nothing).count() == 0 and mixing.taken(docs).count() == len(TEXTS)
    n = mixing.taken(spark.range(40).selectExpr("id as doc_id", "concat_ws(' ', array_repeat('w', 5000)) as text", "cast(null as string) as source"))
    assert n.agg(F.sum("taken")).first()[0] == 300_000


def brute_repeats(rows):
    seen, out = set(), []
    for k, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        b = (t or "").encode()
        hit = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in seen:
                hit[i] += 1
                hit[i + 100] -= 1
            seen.add(w)
        gone = hit.cumsum()[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((k, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, docs, nothing):
    rng = np.random.default_rng(7)
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in repeats.remove_repeats(docs).select(cols).collect()), key=str) == brute_repeats(TEXTS)
    base = "".join(rng.choice(list("ab cé"), 3000))
    rows = [(i, "".join(base[a : a + int(rng.integers(20, 400))] + "xy" * int(rng.integers(0, 3)) for a in rng.integers(0, 2800, 4))) for i in range(50)]
    rows += [(100, "a" * 700), (101, "a" * 350), (102, None), (104, "ab" * 300), (105, "x" * 100), (106, "x" * 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    head = "".join(rng.choice(list("abcdefgh"), 150))
    rows += [(200 + i, head + "".join(rng.choice(list("abcdefgh"), 120)) + head[int(rng.integers(0, 60)) :]) for i in range(40)]  # one gram, many classes
    rows += [(300 + i, f"{i:03d} " * 30 + head[20:] + f"{i % 7:03d}" * 50) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for shard, limit in ((5000, 8_000_000), (5000, 100), (700, 8_000_000), (150, 8_000_000)):
        got = repeats.remove_repeats(frame, shard=shard, limit=limit).select(cols).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_repeats(rows), shard
    assert repeats.remove_repeats(nothing).count() == 0


def test_pipeline(spark, docs):
    import corpus_pipeline as p

    d = docs
    for name, stage in p.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == docs.columns, name
        d = common.materialise(d, name)
    assert p.STAGES[-1][1](spark, d, SF).where("not round_trip").count() == 0
    kept = {r.doc_id for r in p.keep_one_of_near_copies(spark, docs, SF).collect()}
    assert kept == {1, 3, 6, 7, None, 9, 10}
    assert p.run(spark, SF).count() > 0
