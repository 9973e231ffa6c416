"""Operators whose work is plain Python per text, against brute force."""

import hashlib
import itertools
import math
import re
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import byte_bpe, chat_format, html_text, language_id, quality_classifier
from starloom.llm import quality_rules, sharding, stage, text
from starloom.llm.queries import ranks

WORDS = st.text(alphabet="ab é\n\t#.\x0b\x85\xa0", max_size=60)


def brute_measures(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] >= 2:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)),
            len(covered), len(lines))


@settings(deadline=None, max_examples=300)
@given(WORDS)
def test_measures_are_those_of_the_words(t):
    assert text.measures(t) == brute_measures(t)


@settings(deadline=None)
@given(WORDS, st.integers(1, 5))
def test_shingles_count_distinct_windows(t, size):
    words = t.encode().lower().split()
    span = min(size, len(words))
    want = {tuple(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()
    assert len(text.shingles(t, size)) == len(want)


def test_measures_of_nothing_and_of_much():
    assert text.measures(None) == text.measures("") == (0,) * 6
    long = "word " * 200_000
    assert text.measures(long)[0] == text.measures(long)[4] == 200_000


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(ranks(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


@settings(deadline=None, max_examples=200)
@given(st.text(max_size=80))
def test_bpe_is_that_of_the_library(codec, known, t):
    ids = codec.encode(t)
    assert ids == known.encode_ordinary(t)
    assert codec.decode(ids) == t.encode()


@pytest.mark.parametrize("t", ["", "a" * 30_000, "ab" * 9_000, "aAbB" * 3000, " " * 5000, "é" * 4000])
def test_bpe_of_long_pre_tokens(codec, known, t):
    assert codec.encode(t) == known.encode_ordinary(t)
    assert codec.encode(None) == []


def test_a_worker_keeps_both_generations_of_pretokens_between_tasks(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_REMEMBER", 3)
    monkeypatch.setattr(byte_bpe, "_KEPT", 4)
    small = byte_bpe.Codec(codec.ranks, codec.pattern)
    before = small.encode_all(["qzx wvk jjh", "uuy ppo"])  # known together
    small.encode_all(["zzk"])
    small.forget()
    assert len(small._recent) == 4 and not small._before and "zzk" in small._recent
    assert small.encode_all(["qzx wvk jjh", "uuy ppo"]) == before


def test_a_worker_drops_its_codec_when_another_operator_runs_there(codec):
    own = byte_bpe._codec(codec.ranks, codec.pattern)
    stage.release("byte_bpe")
    assert byte_bpe._codec(dict(codec.ranks), codec.pattern) is own  # the next task goes on with it
    assert byte_bpe._codec(codec.ranks, codec.pattern + "|x") is not own
    stage.release()  # as tasks of the operators of whole texts do
    assert not stage._left


def test_bpe_of_many_texts_and_a_small_memory(codec, known, monkeypatch):
    """Pre-tokens side by side in one buffer, forgotten again and again."""
    monkeypatch.setattr(byte_bpe, "_REMEMBER", 50)
    monkeypatch.setattr(byte_bpe, "_BUFFER", 64)
    rng = np.random.default_rng(1)
    small = byte_bpe.Codec(codec.ranks, codec.pattern)
    for _ in range(5):
        texts = ["".join(rng.choice(list("aábc dE1\n\t"), rng.integers(0, 200))) for _ in range(40)]
        assert small.encode_all([*texts, None]) == [*map(known.encode_ordinary, texts), []]


def test_a_merge_to_a_lower_rank_goes_first():
    """After x+y the pair with a has a lower rank than x+y itself, which waits."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"axy": 300, b"xy": 400, b"ab": 350, b"xyx": 299}
    own = byte_bpe.Codec(ranks, r".+")
    plain = tiktoken.Encoding("p", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    for t in ("axyxy", "xyxyxyxy", "axyabxyx", "xyaxyxyab" * 20):
        assert own.encode(t) == plain.encode_ordinary(t)


def test_runs_of_texts_by_size(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_TEXT", 10)
    texts = pa.array(["aaaa", None, "b" * 30, "c", "d", ""])
    runs = list(byte_bpe._slices(texts))
    assert [i for start, size in runs for i in range(start, start + size)] == list(range(6))
    assert len(runs) > 1 and list(byte_bpe._slices(pa.array([], pa.string()))) == []


def test_rank_queue_pops_in_order():
    rng = np.random.default_rng(0)
    queue, pushed = byte_bpe.RankQueue(70_000), []
    for rank, at in zip(rng.integers(0, 70_000, 500), rng.integers(0, 99, 500), strict=True):
        queue.push(int(rank), int(at))
        pushed.append((int(rank), int(at)))
    popped = []
    while (found := queue.pop()) is not None:
        popped.append(found)
    assert popped == sorted(pushed)


def test_binomial_cdf_is_exact():
    for n, p in product((1, 7, 40), (0.01, 0.3, 0.9)):
        for k in range(-1, n + 1):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality_rules.binomial_cdf(k, n, p) == pytest.approx(want, abs=1e-12)
    assert quality_rules.binomial_cdf(19_000, 10**6, 0.02) < 1e-12


def test_cutoffs_stop_at_the_first_failed_test():
    # 0 of 1000: certainly below 1 %; 9 of 1000 is not; a later 0 does not count
    assert quality_rules.choose_cutoff((3, 2, 1), (0, 9, 0), 1000, 0.01, 0.05) == 3
    assert quality_rules.choose_cutoff((3, 2), (0, 0), 10, 0.01, 0.05) is None


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad <p>x</p> --><div class="ad">Buy</div>
<article><h1>A &amp; B</h1><p>One\n two<br>three <b>four<p>Five &eacute;&#33;</p>
<div class="sidebar">side</div><form>f<input></form><script>var t="</p><p>no";</script><p>Six</p>
<section class="comments"><article><p>Reader says</p></article></section></article>
<footer>&copy; foot</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "A & B\nOne two three four\nFive é!\nSix"


@pytest.mark.parametrize("page", [None, "", "<p></p>", "<nav>only", "<!-- never closed", "<script>x"])
def test_pages_without_text(page):
    assert html_text.main_text(page) == ""


def test_pages_without_article_keep_the_high_stretch():
    body = "".join(f"<p>{'long text ' * 20}{i}</p>" for i in range(4))
    page = f"<div><a href=x>Home</a></div><div class='sidebar'>no</div><div>{body}</div><div>tiny</div>"
    out = html_text.main_text(page).split("\n")
    assert len([x for x in out if x.startswith("long")]) == 4 and "no" not in out
    assert html_text.main_text("plain words") == "plain words"


def test_a_long_paragraph_does_not_hide_the_others():
    some = "".join(f"<p>{i} {'ordinary text ' * 21}</p>" for i in range(5))
    page = f"<div><p>{'x' * 6000}</p><div class=ad>buy</div>{some}<form>sign</form><p>{'a short one ' * 5}</p></div>"
    out = html_text.main_text(page).split("\n")
    assert [len(x) for x in out] == [6000, *[295] * 5, 59]


def brute_kept(rows, marked, spec):
    """Window sums taken one by one, and the runs of lines between empty windows."""
    def window(of, i):
        return sum(of[max(0, i - spec.window + 1) : i + 1])

    weights, surge = [w for _, w, _ in rows], spec.least
    if marked:
        inside = [len(t) if c else 0 for t, _, c in rows]
        surge = spec.lift * max([spec.crowd, *(window(inside, i) for i in range(len(rows)))])
        weights = [n + surge if n else w for n, w in zip(inside, weights, strict=True)]
    runs, open_ = [], False
    for i, (text, _, _) in enumerate(rows):
        if not window(weights, i) or not (open_ or weights[i]):
            open_ = False
            continue
        if not open_:
            runs.append([0, []])
            open_ = True
        runs[-1][0] = max(runs[-1][0], window(weights, i))
        runs[-1][1] += [text] if text else []
    return [t for top, texts in runs if top >= surge for t in texts]


PIECES = st.sampled_from(
    ["<p>short</p>", f"<p>{'long text ' * 30}</p>", "<p><a>link of words</a></p>", "<form>x</form>",
     "<article>", "</article>", "<main>", "</main>", "<h2><a>head</a></h2>", "<p>a <a>b</a></p>"]
)


@settings(deadline=None, max_examples=300)
@given(st.lists(PIECES, max_size=25), st.integers(1, 5))
def test_kept_lines_are_those_of_the_curve(pieces, width):
    rows, marked = html_text.lines("".join(pieces))
    spec = html_text.Spec(window=width)
    assert html_text.kept_lines(rows, marked, spec) == brute_kept(rows, marked, spec)


def test_the_window_decides_what_links_amid_text_are():
    page = "<p>one</p><p><a>two</a></p><p><a>three</a></p><p>four</p>"
    kept = {w: html_text.main_text(page, html_text.Spec(window=w)) for w in (1, 2, 3)}
    assert kept == {1: "one\nfour", 2: "one\ntwo\nfour", 3: "one\ntwo\nthree\nfour"}


def test_marked_teasers_do_not_hide_denser_text():
    card = "<article><h3><a>Teaser</a></h3></article>"
    text = "".join(f"<p>{i} {'ordinary text ' * 30}</p>" for i in range(4))
    out = html_text.main_text(f"{card * 2}<div>{text}</div><form>f</form><div>stray words</div>")
    assert out.count("ordinary") == 120 and "stray" not in out


@pytest.mark.parametrize("name", ["side-effects", "section-header", "commentary", "cookie-recipe", "related-work"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_names_of_text_are_not_chrome(name, element):
    page = f"<{element}><p>one</p><h2 class={name}>two</h2><div id={name}>three</div></{element}>"
    assert html_text.main_text(page) == "one\ntwo\nthree"


@pytest.mark.parametrize(
    "name", ["site-header", "page_footer", "ad-slot", "sidebar-left", "cookie-notice", "commentList",
             "comments-area", "sideBar", "tags", "x promo", "related-posts", "share-buttons"]
)
def test_names_of_chrome(name):
    assert html_text.main_text(f"<article><p>one</p><div class='{name}'>no</div></article>") == "one"


def test_unmarked_pages_lose_no_short_blocks():
    page = f"<p>{'long text ' * 30}</p><form>f</form><p>Hi there.</p><form>f</form><p>a</p><p>b</p><p>c</p>"
    assert html_text.main_text(page).split("\n")[1:] == ["Hi there.", "a", "b", "c"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p class=notice>no<p>one</p><p>two</p></article>out", "one\ntwo"),
        ("<article><p class=ad>no <b>no</b><div>one</div>two</article>", "one\ntwo"),
        ("<article><p class=ad>no</p>one</article>", "one"),
        ("<article><ul><li class=ad>no<ul><li>no</ul>no<li>one</ul>two</article>", "one\ntwo"),
        ("<article><div><p class=ad>no</div>one</article>", "one"),
        ("<article><table><tr><td class=ad>no<table><tr><td>no</table>no<td>one<tr><td>two</table>", "one\ntwo"),
        ("<article><table><tr class=ad><td>no<td>no<tr><td>one</table>two</article>", "one\ntwo"),
        ("<article><dl><dt class=ad>no<dd>one</dl>two</article>", "one\ntwo"),
        ("<article>one<p class=ad>no</article><p>out", "one"),
        ("<head><title>no</title><meta name=x><p>one", "one"),
        ("<article><div class=ad><p>no<p>no</div>one</article>", "one"),
    ],
)
def test_skipped_elements_without_end_tags(page, want):
    assert html_text.main_text(page) == want


def test_skipped_element_of_open_tags_is_quick():
    page = "<article><li class=ad>" + "<b><div>" * 20_000 + "</i></div>" * 20_000 + "<li>a"
    assert html_text.main_text(page) == "a"


def test_page_of_open_tags_is_quick():
    page = "<article>" + "<div class=x>" * 20_000 + "a" + "<p>b" * 20_000
    assert html_text.main_text(page).startswith("a\nb")


def test_language_sums_do_not_depend_on_slices(monkeypatch):
    model = language_id.Model(
        ("de", "en"), np.random.default_rng(1).normal(size=(64, 2)).astype(np.float32), np.zeros(2), (1, 2, 3)
    )
    texts = ["abc def " * 50, "x", "", "été " * 31]
    whole = language_id._log_sums(texts, model)
    counts = language_id._counts(iter(texts), (1, 2, 3), 64)
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert np.allclose(whole, language_id._log_sums(texts, model), rtol=1e-4)
    assert (counts == language_id._counts(iter(texts), (1, 2, 3), 64)).all()


def test_texts_without_letters_are_undetermined():
    import pandas as pd

    model = language_id.Model(("en",), np.zeros((8, 1), np.float32), np.zeros(1), (1,))
    found = language_id.score(pd.Series([None, "", "12 _ 3", "a"]), model)
    assert found["lang_pred"].tolist() == ["und", "und", "und", "en"]
    assert found["score"].tolist() == [0, 0, 0, 1]


def test_pairs_order_good_above_bad():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 2] > -0.5).astype(int)
    ranker = quality_classifier.fit_pairs(x, y)
    assert ((ranker.score(x) >= 0.7) == (y == 1)).mean() > 0.97
    alone = quality_classifier.fit_pairs(x, np.ones(400))
    assert (alone.score(x) == 0.5).all()


@pytest.mark.parametrize(("shards", "size"), [(1, 2), (3, 7), (5, 101), (64, 6421)])
def test_lookup_table_is_fair_and_steady(shards, size):
    names = sharding.shard_names(shards)
    if not sharding.is_prime(size):
        size = sharding.table_size(shards)
    table = sharding.fill(names, size)
    held = Counter(table)
    assert max(held.values()) - min(held.values()) <= 1 and set(held) == set(range(shards))
    if shards == 64:
        fewer = sharding.fill(names[:-1], size)
        moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != shards - 1)
        assert moved < 0.1 * size


def test_lookup_table_refuses_bad_sizes():
    for names, size in ((["a"], 4), ([], 5), (["a", "a"], 5), (["a"], 2_000_003)):
        with pytest.raises(ValueError):
            sharding.fill(names, size)


def test_markers():
    assert chat_format.split_marker("User: hi") == ("asks", "hi")
    assert chat_format.split_marker("### Response: x") == ("answers", "x")
    assert chat_format.split_marker("<|im_start|>system x")[0] == "sets"
    assert chat_format.split_marker("Note: x") == ("other", "Note: x")
    assert chat_format.split_marker("no marker") == ("none", "no marker")
    assert hashlib.sha256(b"").hexdigest()[:4] == "e3b0"


def test_viterbi_equals_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    sizes = chat_format._SIZES
    hmm = chat_format.Hmm(("a", "b"), rng.normal(size=4), rng.normal(size=(4, 4)),
                          tuple(rng.normal(size=(4, k)) for k in sizes))
    scores = hmm.emissions(chat_format.shown(["User: hi?", None, "x" * 200, "Bot: no", "yes"]))

    def value(path, before):
        steps = [(before, path[0]), *itertools.pairwise(path)]
        moves = (hmm.start[b] if a is None else hmm.move[a, b] for a, b in steps)
        return sum(moves) + sum(scores[i, state] for i, state in enumerate(path))

    paths = list(itertools.product(range(4), repeat=len(scores)))
    for before, at_end in itertools.product((None, 0, 3), (None, 0, 3)):
        allowed = (p for p in paths if at_end is None or p[-1] == at_end)
        best = max(allowed, key=lambda p: value(p, before))
        assert hmm.decode(scores, before, at_end) == list(best)
    whole, head = hmm.span(scores)
    for end in range(4):
        ending = [p for p in paths if p[-1] == end]
        assert np.isclose(head[end], max(value(p, None) for p in ending))
        assert np.allclose(whole[:, end], [max(value(p, b) for p in ending) for b in range(4)])
