"""Mixing and packing against brute force, and the library's ids."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunewright.llm import common, mixing, packing, quality

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, full, rest = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s], rest = 3.0 * sizes[s], rest - 3 * sizes[s]
            full.add(s)


def _taken(rows):
    """Words taken per (key, source, size): every copy at its virtual finish time, in order, until the sum of all sizes."""
    sized = [(k, s, _size(t)) for k, t, _, s in rows]
    totals = defaultdict(int)
    for _, s, n in sized:
        totals[s] += n
    target = _targets(totals)
    draw = lambda k: int(hashlib.md5(f"42:{'' if k is None else k}".encode()).hexdigest()[:15], 16)
    turns = []
    for source, total in totals.items():
        queue = sorted(((draw(k), -1 if k is None else k, n) for k, s, n in sized if s == source and n))
        end = 0
        for copy in range(3):
            for d, k, n in queue:
                end += n
                if end - n < target[source]:
                    turns.append((end / target[source], d, k, source or "", copy, n, source))
    turns.sort(key=lambda t: t[:5])
    sofar, taken = 0, Counter()
    for _, _, k, _, _, n, source in turns:
        sofar += n
        if sofar > sum(totals.values()):
            break
        taken[k, source, n] += n
    return taken, target, totals


def _mixture(seed, shapes):
    rnd, rows = random.Random(seed), []
    for source, count, longest in shapes:
        for _ in range(count):
            rows.append((len(rows), " ".join(["w"] * rnd.randint(0, longest)), "en", source))
    return rows


@pytest.mark.parametrize(
    "shapes", [[("a", 60, 9), ("b", 5, 9), (None, 40, 30), ("d", 200, 3)], [("a", 3, 500), ("b", 300, 2)], [("z", 20, 5)], [("a", 4, 0), ("b", 3, 8)]]
)
def test_mix_is_the_queue_of_brute_force(docs, shapes):
    rows = _mixture(len(shapes), shapes)
    rows += [(None, "n n n", "en", shapes[0][0]), (10_000, None, "en", shapes[0][0]), (10_001, " \t", None, shapes[-1][0])]
    taken, target, totals = _taken(rows)
    got = mixing.mixed_sizes(docs(rows)).collect()
    assert len(got) == len(rows)
    source = {k: s for k, _, _, s in rows}
    for r in got:
        of = source[r.doc_id]
        assert r.taken == taken[-1 if r.doc_id is None else r.doc_id, of, r["size"]] <= 3 * r["size"]
        assert r.source_size == totals[of] and abs(r.target - target[of]) < 1e-6 * max(1, r.target)
    longest = max(_size(t) for _, t, _, _ in rows)
    words = Counter()
    for (_, of, _), n in taken.items():
        words[of] += n
    # a source comes within its own longest document and the one at which the budget ends
    assert all(abs(words[s] - target[s]) <= 2 * longest * max(1, target[s] / max(1, min(t for t in target.values() if t))) for s in totals)


def test_taken_rows_are_those_of_the_sizes(docs):
    rows = _mixture(5, [("a", 80, 9), ("b", 6, 9), (None, 30, 30)])
    rows += [rows[3], rows[3], rows[82], rows[83], (None, "x y", "en", "b"), (900, None, "en", "a")]
    rows += [(777, " ".join(["q"] * (1 + i % 3)), "en", "b") for i in range(40)]  # one key at the cut of its source
    documents = docs(rows)
    sizes = Counter()
    for r in mixing.mixed_sizes(documents).collect():
        sizes[r.doc_id] += r.taken
    mix = mixing.take_mix(documents)
    assert mix.columns == documents.columns
    words, times = Counter(), Counter()
    for r in mix.collect():
        words[r.doc_id] += _size(r.text)
        times[r.doc_id, r.text] += 1
    assert words == Counter({k: n for k, n in sizes.items() if n})
    copies = Counter((k, t) for k, t, _, _ in rows)
    assert all(n <= 3 * copies[k] for k, n in times.items())
    again = Counter((r.doc_id, r.text) for r in mixing.take_mix(documents).collect())
    assert again == times


def test_mix_does_not_shuffle_texts(docs, plan):
    text = plan(mixing.take_mix(docs(_mixture(1, [("a", 30, 9), ("b", 6, 9)]))))
    assert not [line for line in text.splitlines() if "Exchange hashpartitioning" in line and ("doc_id" in line or "said" in line)]


def test_mix_of_nothing(docs):
    assert mixing.take_mix(docs([])).collect() == [] == mixing.mixed_sizes(docs([])).collect()
    assert mixing.take_mix(docs([(1, None), (2, "")])).collect() == []
    assert [(r.doc_id, r.taken) for r in mixing.mixed_sizes(docs([(1, None, "en", None)])).collect()] == [(1, 0)]


ODD = [*"abcXYZé漢 \t\n.,!'’½\x1c\x85　", " the", "İ", "ﬁ", "<|endoftext|>", "é", "http://x.y/z", "12", "don't", "🙂"]


def _odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ODD, k=rnd.randint(0, 60))) for _ in range(n)]


def test_ids_are_the_library_s():
    known, encode = Tokenizer.from_file(WORD_BPE), packing.Encoder(WORD_BPE)
    rnd = random.Random(9)
    ascii_ = "".join(map(chr, range(32, 127))) + "''sstreveld  "
    letters = ascii_ + "".join(map(chr, [*range(0xA0, 0x180), *range(0x370, 0x3FF), *range(0x400, 0x460)])) + "éäÖßœĲŁĳſΣσςИйЁ" * 9 + "\u0301\u0308"
    texts = _odd_texts(3000, 1) + ["x" * 5000, None, ""] + ["".join(rnd.choices(ascii_, k=rnd.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(6000)] + [c + "a" for c in letters] + list(letters)
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], encode(texts[at : at + 500])):
            assert np.frombuffer(ids, "<u4").tolist() == known.encode(text or "", add_special_tokens=False).ids, repr(text)[:90]
    assert max(map(len, encode.runs)) <= packing.LONG_RUN
    with pytest.raises(ValueError):
        packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_new_runs_are_taken_apart_where_they_are_met(monkeypatch):
    """No pass over the runs of all texts comes first; odd, long and repeated runs, and turned-over caches, change no id."""
    monkeypatch.setattr(packing, "CACHED_RUNS", 20)
    library, encode = Tokenizer.from_file(WORD_BPE), packing.Encoder(WORD_BPE)
    draw = random.Random(5)
    words = ["Éclair,", "don't", "it's!!", "x" * 70, "ñ" * 70 + "1", "数据", "数" * 80, "a<|endoftext|>b", "É", "12ab", "İstanbul", "×2", "naïve's", "ΑΣ"]
    texts = ["", None, *(" ".join(draw.choices(words + [f"w{i}" for i in range(60)], k=draw.randrange(1, 40))) for _ in range(120))]
    for at in range(0, len(texts), 8):
        some = texts[at : at + 8]
        want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in some]
        assert encode(some) == want
    assert not any(len(run) > packing.LONG_RUN for run in [*encode.runs, *encode.older])
    assert encode.runs["Unmet,"] == np.array(library.encode("Unmet,", add_special_tokens=False).ids, "<u4").tobytes()


def test_a_worker_forgets_caches_of_other_operators():
    packing.encoder(WORD_BPE)(["some words"])
    quality.features("some words")
    common.serve("packing")
    common.serve("jaccard")
    assert not packing._ENCODERS and not quality.WORDS
    quality.features("some words")
    common.serve("jaccard")
    assert len(quality.WORDS) == 2  # only a turn empties them


@pytest.mark.parametrize("count", [0, 1, 300])
def test_every_id_is_in_one_piece_of_a_gapless_window(docs, count):
    known = Tokenizer.from_file(WORD_BPE)
    texts = _odd_texts(count, 2) + (["word " * 9000, "", None, "word " * 2047] if count > 1 else [])
    rows = [(i, t) for i, t in enumerate(texts)] + ([(None, "a b")] if count else [])
    pieces = packing.pack_documents(docs(rows), WORD_BPE).collect()
    ids = {k: known.encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for key, mine in by_doc.items():
        at = 0
        for p in sorted(mine, key=lambda p: p.start):
            part = np.array(ids[key][p.start : p.start + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[key]), zlib.crc32(part))
            at += p.length
        assert at == len(ids[key])
    for mine in by_window.values():
        at = 0
        for p in sorted(mine, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == mine[0].window and at in {2**k for k in range(12)}


def test_repeated_rows_and_small_buffers(docs):
    rows = [(1, "a b c"), (1, "a b c"), (2, "d " * 5000)] + [(i, "x " * (i % 700)) for i in range(3, 200)]
    got = packing.pack_documents(docs(rows), WORD_BPE, buffer_tokens=5000).collect()
    assert sum(p.length for p in got if p.doc_id == 1) == 8
    assert sum(p.length for p in got) == sum(p.doc_tokens for p in got if p.start == 0)
    steps = defaultdict(set)
    for p in got:
        steps[p.step_group].add(p.window)
    assert all(len(windows) == 1 or max(windows) < packing.TIERS[0] for windows in steps.values())
