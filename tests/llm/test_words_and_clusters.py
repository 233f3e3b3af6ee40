"""Spelling variants, encoding by distinct words and centroids against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tunewright.llm import centroids, spelling, word_table
from tunewright.session import setting

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(rows, ratio=10):
    counts = _words(rows)
    near = {w: [x for x in counts if x != w and _one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def _spelled(documents, **options):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(documents, **options).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_variants_are_those_of_brute_force(docs, seed):
    rnd = random.Random(seed)
    base = ["aaaaaaa", "banannas", "straßenbahn", "Éclairàge", "mississippi", "aaaaaaab", "zzzzzzzz"]
    rows = []
    for i in range(150):
        text = []
        for _ in range(40):
            word = rnd.choices(base, weights=[1, 30, 300, 3, 900, 10, 2])[0]
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
                at = rnd.randrange(len(word))
                word = rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice("absz") + word[at + 1 :], word[:at] + rnd.choice("aabz") + word[at:]])
            text.append(rnd.choice([word, word.title()]))
        rows.append((i if i % 40 else None, rnd.choice([" ", ", ", "1"]).join(text)))
    rows += [(7, rows[7][1]), (900, None), (901, ""), (902, "short words only")]
    want = _variants(rows)
    assert _spelled(docs(rows)) == want and sum(f is not None for f, *_ in want.values()) > 10
    assert any(r not in (w, f) for w, (f, r, *_) in want.items()) or seed


def test_long_words_and_no_words(docs):
    rnd = random.Random(1)
    long = "".join(rnd.choices("abcdef", k=20_000))
    edge = "".join(rnd.choices("abc", k=64))
    family = [long, long[:9000] + "z" + long[9001:], long[:500] + long[501:], edge, edge + "q", edge[:-1], edge[:30] + "x" + edge[31:]]
    rows = [(i, " ".join([w] * (30 if w == long else 2))) for i, w in enumerate(family)]
    assert _spelled(docs(rows)) == _variants(rows)
    assert _spelled(docs([])) == {} and _spelled(docs([(1, None)])) == {}
    assert _spelled(docs([(1, "lonesome lonesome")])) == _variants([(1, "lonesome lonesome")])
    with pytest.raises(ValueError):
        spelling.variants(docs([]), ratio=1)


def test_both_ways_to_rotate_agree(spark):
    some = ["aabbccd", "abcabca", "x" * 9, "abcdefgh"]
    numbered = spark.createDataFrame([(i, w, 5) for i, w in enumerate(some)], "id LONG, word STRING, n LONG")
    native = sorted((r.id, r.key, r.part) for r in spelling._spelled(numbered).collect())
    assert native == sorted((i, key, part) for i, w in enumerate(some) for key, part in spelling.rotations(w))


def test_no_pairs_are_joined(docs, plan):
    numbered = docs([(1, "a")]).selectExpr("doc_id AS id", "text AS word", "n_chars AS n")
    assert "Join" not in plan(spelling.near_words(numbered))


ODD = [*"ab \n\t's!?0é漢\x1c\x85　 '", "<|endoftext|>", " the", "'re", "ing", "🙂", "\r\n", "<|endof", "�", "\x00"]


def test_ids_and_texts_are_the_library_s(docs, monkeypatch):
    monkeypatch.setattr(word_table, "CHUNK_CHARS", 3000)  # the driver's part only
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(0, 40))) for _ in range(800)] + ["a" * 20_000, " " * 5000, "the " * 30_000, "", "the the"]
    rows = list(enumerate(texts)) + [(None, "x y"), (3, texts[3]), (3, texts[3])]
    known = Tokenizer.from_file(BYTE_BPE)
    got = word_table.round_trip(docs(rows + [(5000, None)]), BYTE_BPE).collect()
    want = [(k, known.encode(t, add_special_tokens=False).ids) for k, t in rows] + [(5000, [])]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded) for r in got) == sorted(
        (str(k), len(ids), ids, known.decode(ids, skip_special_tokens=False)) for k, ids in want
    )
    assert word_table.round_trip(docs([]), BYTE_BPE).collect() == []
    assert [tuple(r) for r in word_table.round_trip(docs([(1, None)]), BYTE_BPE).collect()] == [(1, 0, [], "")]


def test_digests(docs):
    known = Tokenizer.from_file(BYTE_BPE)
    text = "Über the <|endoftext|> hill"
    (row,) = word_table.digests(word_table.round_trip(docs([(1, text)]), BYTE_BPE)).collect()
    ids = known.encode(text, add_special_tokens=False).ids
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.n_tokens == len(ids)


def test_decode_of_any_ids(spark):
    known = Tokenizer.from_file(BYTE_BPE)
    rnd = random.Random(4)
    rows = [(i % 90, [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))], "x", None) for i in range(200)] + [(None, None, "x", 1), (1, [5, None, 10**6, 6], "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id LONG, ids ARRAY<INT>, decoded STRING, at LONG")
    got = word_table.decode(frame, BYTE_BPE).collect()
    want = [(str(k), known.decode([i for i in ids or [] if i is not None and i < 50257], skip_special_tokens=False)) for k, ids, _, _ in rows]
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted(want)


def test_documents_are_not_shuffled(docs, plan):
    text = plan(word_table.round_trip(docs([(i, f"text {i}") for i in range(20)]), BYTE_BPE))
    for_documents = [line for line in text.splitlines() if "codes#" in line and "Exchange" in line]
    assert not for_documents and "Bucketed: true" in text


def test_a_chunk_sorts_its_distinct_ids_and_not_all_tokens(docs, monkeypatch):
    def counted(key):
        def run(documents, other):
            n = documents.num_rows
            return pa.table({key: documents.column("key"), "n_tokens": [other.num_rows] * n, "ids": pa.nulls(n, pa.list_(pa.int32())), "decoded": pa.nulls(n, pa.string())})

        return run

    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" * 2 for c in ("lst", "rnd", "nkt", "xqz")]
    texts = [" ".join(f"{w}{v}" for v in words) for w in words[:20]]
    known = Tokenizer.from_file(BYTE_BPE)
    distinct = {i for t in texts for i in known.encode(t, add_special_tokens=False).ids}
    tokens = sum(len(known.encode(w, add_special_tokens=False).ids) for w in {w for t in texts for w in word_table.Vocabulary(BYTE_BPE).words(t)})
    monkeypatch.setattr(word_table, "_joined", counted)
    most = max(r.n_tokens for r in word_table.round_trip(docs(list(enumerate(texts))).coalesce(1), BYTE_BPE).collect())
    assert 0 < most <= len(distinct) < tokens / 10


def test_words_go_to_a_bounded_number_of_slots(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(word_table, "bucketed", lambda df, *rest: seen.append(df) or df)
    with setting(spark, "spark.sql.shuffle.partitions", "5000"):
        word_table.round_trip(docs([(1, " ".join(f"w{i}" for i in range(6000)))]).coalesce(1), BYTE_BPE)
    (coded,) = seen
    assert 100 < coded.where("slot IS NOT NULL").count() <= 512


def test_more_slots_than_words_and_fewer_partitions(spark, docs, monkeypatch):
    monkeypatch.setattr(word_table, "SLOTS", 3)
    texts = ["one two three", "", "four one", None, "ÿ þ\x00\x7f <|endoftext|>"]
    got = {r.doc_id: (r.ids, r.decoded) for r in word_table.round_trip(docs(list(enumerate(texts))), BYTE_BPE).collect()}
    known = Tokenizer.from_file(BYTE_BPE)
    assert got == {k: (known.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in enumerate(texts)}


def test_packed_words_and_sizes_come_back():
    words = ["a", "ÿ", " þ", "\x00", "\u07ff\uffff", "🙂" * 70_000, "\n\n"]
    assert word_table._unpacked(word_table._packed(words)) == words
    sizes = [0, 1, 255, 256, 65_536, 70_000]
    assert word_table._unsized(word_table._sizes([range(n) for n in sizes])).tolist() == sizes
    assert word_table._unsized(word_table._sizes([])).tolist() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        word_table.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def _lloyd(rows, k, rounds, dim=64):
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == dim and None not in v and np.isfinite(v).all()]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].tolist()))[:k]
    now = np.array([v for _, v in first])
    data = np.array([v for _, v in kept])
    for turn in range(rounds + 1):
        away = ((data[:, None] - now[None]) ** 2).sum(axis=2)
        mine = away.argmin(axis=1)
        if turn < rounds:
            now = np.array([data[mine == j].sum(axis=0) // (mine == j).sum() if (mine == j).any() else now[j] for j in range(len(now))])
    return [(i, int(j), int(a)) for (i, _), j, a in zip(kept, mine, away.min(axis=1))], now


VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, cluster INT, ids LONG, inertia STRING"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VECTORS)


def _gaussians(n=700, seed=3):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(size=(12, 64)) * 0.3
    return [(i, [float(x) for x in np.float32(middles[i % 12] + rnd.normal(size=64) * 0.2)]) for i in range(n)]


def test_clusters_are_exact(spark):
    rows = _gaussians()
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (8000, [0.0] * 64), (8001, [0.0] * 64)]
    odd = [(9000, None), (9001, []), (9002, [1.0] * 63), (9003, [None] + [1.0] * 63), (9004, [float("nan")] * 64), (9005, [float("-inf")] + [1.0] * 63)]
    want, now = _lloyd(rows, 40, 5)
    got = centroids.cluster(_frame(spark, rows + odd)).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == sorted((str(i), j, a) for i, j, a in want)
    sums = Counter()
    for _, j, a in want:
        sums[j] += a
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    assert all((r.cluster_inertia, r.inertia, r.centroid_sha256) == (sums[r.cluster], sum(sums.values()), told[r.cluster]) for r in got)


def test_few_vectors_and_none(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(5)]
    got = centroids.cluster(_frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(_lloyd(rows, 40, 5)[0])
    assert centroids.cluster(_frame(spark, [])).collect() == []
    assert centroids.cluster(_frame(spark, [(1, None)])).collect() == []


def test_bounds_spare_distances_and_never_err():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(-300, 300, (4000, 8)) + rnd.integers(-3, 4, (4000, 1)) * 900
    history = np.array([rows[:20]])
    bounds, evaluated = centroids.Bounds(rows, None, 20), []
    for _ in range(8):
        evaluated.append(bounds.assign(history))
        away = ((rows[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert (bounds.assigned == away.argmin(axis=1)).all()
        bounds = centroids.Bounds(rows, tuple(bounds.state()), 20)
        moved = [rows[bounds.assigned == j].sum(axis=0) // max(1, (bounds.assigned == j).sum()) for j in range(20)]
        history = np.concatenate([history, np.array([moved])])
    assert evaluated[0] >= 19 * 4000 and evaluated[-1] < 0.35 * evaluated[0]


def test_displacement_in_all_is_less_than_its_steps():
    history = np.array([[[0, 0]], [[10, 0]], [[10, 10]], [[0, 1]]])
    assert centroids._norms(history)[:, 0].tolist() == [1.0, np.sqrt(101), np.sqrt(181), 0.0]
