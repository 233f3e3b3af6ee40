"""Joins, vectors and neighbours against brute force."""

import random
import re

import numpy as np
import pytest

from tunewright.llm import embed_dedup, jaccard, neighbours
from tunewright.llm.components import components


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _classes(ids, links):
    parent = {i: i for i in ids}
    for a, b in links:
        x, y = _find(parent, a), _find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {i: _find(parent, i) for i in ids}


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 300), rnd.randrange(100, 300)) for _ in range(150)]
    links += [(500, 500 + i) for i in range(1, 200)] + [(5, 5), (1, 0)]
    edges = spark.createDataFrame(links + [(None, 3)], "a LONG, b LONG")
    want = _classes({x for e in links for x in e}, links)
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {x: want[x] for e in links if e[0] != e[1] for x in e}
    assert components(edges.limit(0)).collect() == []


def _set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def _texts(seed):
    """Families of near copies of one text, of edits of edits, and of texts with a common passage."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = [None, "", "  ", "One", "one", "ONE two", "a b c", "a\tb\nc", "ä Ä"]
    for family in range(12):
        base = [f"{rnd.choice('abcdef')}{rnd.randrange(40)}" for _ in range(rnd.randrange(20, 160))]
        for _ in range(rnd.randrange(1, 14)):
            words = list(base) + (passage if family % 3 == 0 else [])
            for _ in range(rnd.randrange(0, 7)):
                words[rnd.randrange(len(words))] = f"{rnd.choice('xyz')}{rnd.randrange(30)}"
            if rnd.random() < 0.3:
                words = words[: -rnd.randrange(1, 9)]
            texts.append(" ".join(words))
            if rnd.random() < 0.2:
                base = words[: len(base)]
            if rnd.random() < 0.2:
                texts.append(texts[-1].upper())
    return list(enumerate(texts))


@pytest.mark.parametrize("n, percent, seed, few", [(3, 90, 1, 1), (3, 90, 2, 6), (5, 80, 3, 6), (5, 80, 5, 1), (2, 60, 4, 2)])
def test_jaccard_classes_are_exact(docs, monkeypatch, n, percent, seed, few):
    rows = _texts(seed)
    sets = {i: _set(t, n) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = _classes(sets, links)
    monkeypatch.setattr(jaccard, "FEW", few)  # lists of all lengths through leaders, or short ones in pairs
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(docs(rows), n=n, percent=percent).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_one_hot_family(docs):
    """Edits of one text that do not link with each other, and thousands of equal texts."""
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in range(4):
            words[(i * 7 + k * 25) % 100] = f"e{i}x{k}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:50])) for i in range(300)]
    sets = {i: _set(t, 3) for i, t in rows}
    links = [(a, b) for a in range(150) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = _classes(sets, links) | {1000 + i: 1000 for i in range(300)}
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(docs(rows)).collect()}
    assert got == want


def test_join_of_odd_rows(docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "x " * 300_000), (3, None)]
    got = sorted(tuple(r) for r in jaccard.jaccard_classes(docs(rows)).na.fill(-1).collect())
    assert got == [(-1, 2, -1), (1, 2, 1), (1, 2, 1), (2, 1, 2), (3, 0, 3)]
    assert jaccard.jaccard_classes(docs([])).collect() == []
    kept = jaccard.keep_one(docs([(1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (3, "")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"] and "_key" in kept.columns


def test_long_words_and_segments(monkeypatch):
    text = ("ab " * 50 + "z" * 300 + " C d\n" * 40 + "y" * 500).encode()
    whole = [x.tolist() for x in jaccard.shingles([text, None, b"one", text], 3)]
    assert whole[0] == whole[3] and len(whole[1]) == 0 and len(whole[2]) == 1
    monkeypatch.setattr(jaccard, "SEGMENT", 64)
    jaccard._places.cache_clear()
    starts, _ = jaccard.word_hashes(text)
    jaccard._places.cache_clear()
    assert starts.tolist() == [m.start() for m in re.finditer(rb"\S+", text)]


def test_words_of_one_polynomial_have_hashes_of_their_own():
    """Two words that every polynomial modulo 2^64 takes for one."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024)).encode()
    other = one.translate(bytes.maketrans(b"ab", b"ba"))
    _, hashes = jaccard.word_hashes(b" " + one + b"  " + other + b" " + one.upper() + b"\t" + b"a" + b" aa aaa ")
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 5


VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, id LONG, vector STRING, digest STRING"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, 0, "v", "d") for i, v, k in rows], VECTORS)


def test_near_vectors_are_exact(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 40)  # the driver's part: buckets in many blocks
    rnd = np.random.default_rng(4)
    rows = []
    for family in range(8):
        base = rnd.normal(size=16)
        for _ in range(30):
            rows.append((len(rows), [float(x) for x in np.float32(base + rnd.normal(size=16) * rnd.choice([0.02, 0.1, 0.2]))], family % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(90)]
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([k for _, _, k in rows])
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    ids = [i for i, _, _ in rows]
    want = _classes(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[0][1], None), (2004, [], 0), (2005, [1.0, 2.0], 0)]
    odd += [(2006, [float("inf")] + [1.0] * 15, 0), (2007, [None] + [1.0] * 15, 0)]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(_vectors(spark, rows + odd)).collect()}
    for at, i in enumerate(ids):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[at].sum(), want[i], want[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _, _ in odd)
    assert embed_dedup.near_duplicates(_vectors(spark, [])).collect() == []
    null = embed_dedup.near_duplicates(_vectors(spark, [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)])).collect()
    assert {r.vec_id: r.component_id for r in null} == {None: None, 1: 1}


def test_estimates_are_unbiased():
    rnd = np.random.default_rng(0)
    unit = rnd.normal(size=(400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    _, code, factor = embed_dedup._codes(unit, 4, 2)
    signs = (np.unpackbits(code, axis=1)[:, :64] * 2.0 - 1) / 8
    turned = unit @ embed_dedup.rotations(64, 1).T
    error = (signs @ turned.T) / factor[:, None] - unit @ unit.T
    slack = embed_dedup.BOUND * np.sqrt(1 - factor**2) / factor / np.sqrt(63)
    assert abs(error.mean()) < 0.002 and (error < slack[:, None]).mean() > 0.9999


def test_neighbours_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rnd.normal(size=24))], 0) for i in range(900)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(40)]
    odd = [(2000, None, 0), (2001, [0.0] * 24, 0), (2002, [1.0], 0), (None, rows[0][1], 0), (2100, [float("nan")] * 24, 0)]
    vectors = _vectors(spark, rows + odd)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")).collect()
    ids, data = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = total = 0
    for q in [i for i in ids if i % 100 == 0]:
        away = np.sqrt(((data - data[ids == q][0]) ** 2).sum(axis=1))
        away[ids == q] = np.inf
        want = ids[np.lexsort((ids, away))[:10]]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert np.allclose([s for _, _, s in mine], [away[ids == v][0] for _, v, _ in mine], rtol=1e-12, atol=0)
        hits, total = hits + len({v for _, v, _ in mine} & set(want)), total + 10
    assert hits / total >= 0.9 and not {2000, 2001, 2100} & {r.query_id for r in got}
    few = _vectors(spark, [(0, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)])
    assert [(r.rank, r.vec_id) for r in neighbours.nearest(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert neighbours.nearest(few.limit(0), few).collect() == []


def test_chi_square():
    assert abs(neighbours.chi_square(neighbours.chi_square_point(0.95)) - 0.95) < 1e-9
    assert abs(neighbours.chi_square_point(0.95) - 15.507) < 1e-3
