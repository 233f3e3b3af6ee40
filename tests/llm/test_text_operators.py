"""HTML, quality, language and token counts."""

import json
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunewright.llm import bpe_count, html_text, language, quality

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
CLEAN = "The river runs past the old mill and the people of the town walk there in the evening"


def test_main_text_of_a_whole_page():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav>
        <div class="ad">Buy now, it is cheap and good and here today only</div>
        <article><h1>A title</h1><p>One &amp; two
        <b>three</b>.<p>Four &lt;five&gt;.<script>var x = "</p>";</script></article>
        <div id="comments"><p>Nice text, thank you for writing it all down</p></div>
        <footer>&copy; us</footer></body></html>"""
    tree = html_text.grow(html_text.LABELLED)
    assert html_text.main_text(page, tree) == "A title\n\nOne & two three.\n\nFour <five>."


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<div><!-- x", "<script>a", "&#", "</p></p>", "<nav>a b c</nav>"])
def test_broken_pages_have_no_text_and_do_not_fail(page):
    tree = html_text.grow(html_text.LABELLED)
    assert html_text.main_text(page, tree) in ("", "&#", "<")


LONG = "The river runs past the old mill and the people of the town walk there in the evening, while children play near the bridge. " * 2


@pytest.mark.parametrize(
    "before, after",
    [
        ('<div class="overflow-hidden">', "</div>"), ('<div class="content with-sidebar">', "</div>"), ('<div id="main-content" data-hidden-on="x">', "</div>"),
        ('<div class="has-ads no-comments">', "</div>"),
    ],
)
def test_names_of_the_surroundings_do_not_hide_an_article(before, after):
    tree = html_text.grow(html_text.LABELLED)
    page = f"<body><nav><a href=/>Home</a></nav>{before}<article><p>{LONG}</p></article>{after}</body>"
    assert html_text.main_text(page, tree) == LONG.strip()


def test_names_of_places_in_a_text_and_parts_of_a_page():
    tree = html_text.grow(html_text.LABELLED)
    page = f"""<article><header class="entry-header"><h1>Of rivers</h1></header><p>{LONG}</p>
        <section id="related-work"><h2 id="search-methods">Search</h2><p>{LONG}</p></section>
        <section id="related-posts"><p>{LONG} x</p></section><div id="comments-list"><p>{LONG} y</p></div>
        <p hidden>{LONG} z</p><p style="display: none">{LONG} w</p><p aria-hidden=true>{LONG} v</p></article>"""
    got = html_text.main_text(page, tree)
    assert got == "\n\n".join(["Of rivers", LONG.strip(), "Search", LONG.strip()])
    assert html_text.main_text(f"<article><p title='a>{LONG}</p></article>", tree) in ("", LONG.strip())  # an odd quote


def test_end_tags_of_nothing_cost_nothing():
    started = time.time()
    assert len(html_text.blocks("<b>" * 20_000 + "</i>" * 20_000 + "x")) == 1
    assert time.time() - started < 2


@pytest.mark.parametrize("text, want", [("½ ² ① Ⅷ 12", ""), ("x² Ⅷa", "xa"), ("ÉTÉ", "été")])
def test_numerals_are_no_letters(text, want):
    assert "".join(language.bare(w) for w in text.split()) == want


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, 5), (None, None, "<article><p>x" + " y" * 100_000 + "</article>", 5), (1, "u", "", 5)],
        "page_id LONG, url STRING, html STRING, text LONG",
    )
    rows = html_text.extract(pages).collect()
    assert sorted(r.n_chars for r in rows) == [0, 0, 200_001] and all(r.text is not None for r in rows)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_tree_separates_its_table():
    tree = html_text.grow(html_text.LABELLED)
    assert all((html_text.decide(tree, row) >= 0.5) == bool(row[-1]) for row in html_text.LABELLED)


def _labelled(n=120):
    rnd, words, rows = random.Random(3), CLEAN.split(), []
    for i in range(n):
        text = " ".join(rnd.choices(words, k=40))
        rows.append((i, text.upper().replace(" ", "!! ") if i % 4 == 0 else text))
    return rows


def test_quality_learns_without_the_held_out(docs, spark):
    rows = _labelled()
    documents = docs(rows + [(1000, None), (1001, ""), (None, CLEAN), (5, rows[5][1])])
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows] + [(None, 1, 0), (3, None, 0)], "doc_id LONG, quality INT, toxic INT")
    model = quality.train(documents, labels)
    got = quality.classify(documents, model).collect()
    assert len(got) == 124 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    right = [r.predicted == int(r.doc_id % 4 > 0) for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert np.mean(right) > 0.97 and any(r.held_out for r in got)
    assert quality.keep_good(documents, model).columns == documents.columns


def test_quality_of_nothing(docs, spark):
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    model = quality.train(docs([]), labels)
    assert quality.classify(docs([]), model).collect() == []
    assert quality.classify(docs([(1, "a b")]), model).first().predicted == 1


def test_dual_descent_lowers_the_hinge_loss():
    rnd = np.random.default_rng(1)
    rows = [np.unique(rnd.integers(0, 40, 6)) + (0 if i % 2 else 20) for i in range(60)]
    labels = np.array([i % 2 for i in range(60)])
    weights = quality.dual_coordinate_descent(rows, np.ones(quality.SIZE) * np.sqrt(6), labels, cost=1.0, rounds=30)
    margins = [(1 if y else -1) * weights[r].sum() for r, y in zip(rows, labels)]
    assert np.mean(np.array(margins) > 0) > 0.85


def _best(given, switch):
    """The value of the best path by trying every one before."""
    value = given[0].astype(float)
    for row in given[1:]:
        value = np.maximum(value, value.max() - switch) + row
    return value.max()


def _value(given, path, switch):
    return sum(float(given[i, p]) for i, p in enumerate(path)) - switch * int(np.sum(np.diff(path) != 0))


@pytest.mark.parametrize("seed", range(60))
def test_viterbi_finds_the_best_path(seed):
    rnd = np.random.default_rng(seed)
    given = rnd.normal(0, 5, (rnd.integers(1, 40), 4)).astype(np.float32)
    one = language._steady(given, 12.0)
    path = np.full(len(given), one) if one >= 0 else next(language._viterbi([(0, given)], 12.0))[1]
    assert abs(_value(given, path, 12.0) - _best(given, 12.0)) < 1e-3


LANGS = {"en": "the house and the garden with that this thing", "de": "der hund und die katze nicht auf schön straße", "ru": "это дом и сад что не было"}


def _spoken(n=60):
    rnd = random.Random(5)
    return [(i, " ".join(rnd.choices(LANGS[k].split(), k=20)), k, "s") for i in range(n) for k in [sorted(LANGS)[i % 3]]]


def test_languages_spans_and_rejects(docs):
    documents = docs(_spoken() + [(100, None), (101, "12 ... !"), (102, ""), (103, "漢字"), (None, LANGS["en"])])
    model = language.train(documents)
    assert model.langs == ["de", "en", "ru"]
    got = {r.doc_id: r for r in language.identify(documents, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k, _ in _spoken())
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[103].lang_pred in model.langs
    mixed = docs([(1, f"{LANGS['en']} {LANGS['en']} {LANGS['ru']} {LANGS['de']} {LANGS['de']}")])
    spans = language.label_spans(mixed, model).first().spans
    assert [s.lang for s in spans] == ["en", "ru", "de"] and sum(s.n_words for s in spans) == 9 * 4 + 7
    kept = language.keep_identified(documents, model)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} >= set(range(60))
    assert language.identify(docs([]), language.train(docs([]))).collect() == []
    assert language.identify(docs([(1, "abc")]), language.train(docs([]))).first().lang_pred == "und"


def test_token_counts_are_the_library_s(docs):
    rnd = random.Random(2)
    parts = [*"ab \n\t's!?0é漢\x1c\x85　 '", "<|endoftext|>", " the", "'re", "ing", "🙂", "\r\n"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(3000)] + ["a" * 50_000, " " * 5000]
    known = Tokenizer.from_file(BYTE_BPE)
    counter = bpe_count.Counter(BYTE_BPE)
    for text in texts:
        assert counter.count(text) == len(known.encode(text, add_special_tokens=False).ids), repr(text)[:80]
    got = bpe_count.count_tokens(docs([(1, None), (2, ""), (None, "é"), (2, "x " * 2000)]), BYTE_BPE).collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [(0, 0, False), (0, 0, False), (2, 1, False), (4000, 2001, True)]


def test_merges_file_of_either_form(tmp_path):
    for merges in (["a b", "ab c"], [["a", "b"], ["ab", "c"]]):
        path = tmp_path / "t.json"
        path.write_text(json.dumps({"model": {"merges": merges}}))
        counter = bpe_count.Counter(str(path))
        assert [counter.count(t) for t in ("abc", "abab", "cab", "")] == [1, 2, 2, 0]
