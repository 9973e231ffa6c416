"""Operators as Spark jobs: small tables with every awkward row, against brute force."""

import io
import random
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, chat_format, decontaminate, html_text, language_id, near_dedup
from starloom.llm import components as component_rounds
from starloom.llm import quality_classifier, quality_rules, sharding, warc
from starloom.llm.stage import below_hash
from starloom.llm.components import components
from starloom.llm.text import shingles

DOCS = "doc_id long, text string, lang string, kept string, score string, key string, a string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, None, "x", None, "y") for r in rows], DOCS)


AWKWARD = [(None, "some words here", "en"), (1, None, "en"), (2, "", None), (3, " \n", "en"),
           (4, "x" * 100_000, "en"), (5, "same same", "de"), (5, "same same", "de"),
           (5, "other text of five", "de")]


def brute_groups(rows, words, percent=80):
    sets = [set(shingles(t, words).tolist()) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return {row[0]: least[find(i)] for i, row in enumerate(rows)}


def family(rng, base, n, start, rate=0.1):
    rows = []
    for i in range(n):
        words = list(base)
        for at in range(len(words)):
            if rng.random() < rate * rng.random():
                words[at] = f"w{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(words), "en"))
    return rows


@pytest.mark.parametrize(("words", "crowd", "block"), [(2, 64, 512), (5, 4, 16)])
def test_near_duplicates_equal_brute_force(spark, words, crowd, block):
    rng = random.Random(words)
    rows = []
    for f in range(4):
        base = [f"b{f}_{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150]))]
        rows += family(rng, base, 30, 100 * f)
    rows += family(rng, [f"c{i}" for i in range(120)], 90, 1000, rate=0.25)
    rows += [(2000 + i, f"lone {i} " * 3, "en") for i in range(20)]
    spec = near_dedup.Spec(words=words, crowd=crowd, block=block)
    got = near_dedup.near_duplicates(docs_of(spark, rows), spec=spec).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_groups(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_awkward_rows(spark):
    got = near_dedup.near_duplicates(docs_of(spark, AWKWARD), spec=near_dedup.Spec(words=2))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=str)
    assert got == sorted(
        [(None, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True),
         (5, 1, 5, True), (5, 1, 5, True), (5, 3, 5, True)], key=str)
    kept = near_dedup.keep_one_of_each(docs_of(spark, [(7, "a b c", "en"), (9, "a b c", "en")]))
    assert [r.doc_id for r in kept.collect()] == [7] and kept.columns[0] == "doc_id"
    assert near_dedup.near_duplicates(docs_of(spark, AWKWARD).limit(0)).count() == 0


def test_lists_that_hang_together_are_not_compared_as_one(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(600):  # texts that share words with the next ones only
        words = rng.sample([f"w{2 * i + j}" for j in range(40)], 25)
        rows.append((i, " ".join(words), "en"))
        if i % 20 == 0:
            rows.append((1000 + i, " ".join(words[1:]), "en"))
    work = []
    dealt = near_dedup._dealt

    def counted(members, block):
        of = members.groupBy("crowd").agg((F.count(F.lit(1)) * F.count_if("open")).alias("n"))
        work.append(of.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return dealt(members, block)

    monkeypatch.setattr(near_dedup, "_dealt", counted)
    spec = near_dedup.Spec(words=1, crowd=2)
    got = near_dedup.near_duplicates(docs_of(spark, rows), spec=spec).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_groups(rows, 1)
    assert 0 < sum(work) < len(rows) ** 2 / 5


def test_crowds_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(9)
    common = [f"c{i}" for i in range(16)]
    rows = []
    for f in range(12):  # families that share half of their words, and texts of a few of these
        base = common + [f"b{f}_{i}" for i in range(14)]
        for i in range(9):
            words = [w if rng.random() > 0.06 else f"n{f}_{i}_{rng.randrange(99)}" for w in base]
            rows.append((100 * f + i, " ".join(words), "en"))
        rows += [(100 * f + 50 + i, " ".join(rng.sample(common, rng.choice([5, 6]))), "en") for i in range(5)]
    depths = []
    share = near_dedup._alike

    def seen(members, spec):
        depths.extend(r.depth for r in members.select("depth").distinct().collect())
        return share(members, spec)

    monkeypatch.setattr(near_dedup, "_alike", seen)
    spec = near_dedup.Spec(words=1, crowd=2, block=2)
    got = near_dedup.near_duplicates(docs_of(spark, rows), spec=spec).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_groups(rows, 1)
    assert max(depths) > 1


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 103)}
    }


def test_components_of_few_links_and_of_many_are_the_same(spark, monkeypatch):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges = spark.createDataFrame([*links, (1, 2), (1, 2)], "a long, b long")
    seen = []
    large_star = component_rounds._large_star
    monkeypatch.setattr(component_rounds, "_large_star", lambda e, few: seen.append(few) or large_star(e, few))
    few = {r.node: r.component for r in components(edges).collect()}
    monkeypatch.setattr(component_rounds, "_FEW", 10)
    many = {r.node: r.component for r in components(edges).collect()}
    assert few == many
    assert True in seen and False in seen


def test_marks_at_the_end_of_tokens(spark):
    text = "a... ... (x) \U0001f600! .a ?! b.c. 5 km. 'd' \u00e9,\n!"
    got = spark.range(1).select(decontaminate.canonical_tokens(F.lit(text)).alias("t")).first().t
    assert got == ["a", ".", "(x", "\U0001f600", ".a", "?", "b.c", "<num>", "<unit>", "'d", "\u00e9", "!"]


ITEM = "A train with Anna covers 120 km in 3 hours before it stops near the old bridge by the river"


def test_leaks_verbatim_and_with_other_values(spark):
    other = ITEM.replace("120", "75").replace("3 hours", "2 hours").replace("Anna", "Boris")
    broken = "when Anna goes to the old market with 3 bags then Anna buys at the same market 3 pears"
    rows = [(1, f"before\n{ITEM} after", "en"), (2, f"so {other}, and more", "en"),
            (3, "nothing of the kind at all in this one " * 5, "en"), (4, ITEM[:40], "en"), (5, None, "en"),
            (None, ITEM, "en"), (6, broken.replace("Anna", "Eva", 1).replace("3", "4", 1), "en")]
    benchmark = spark.createDataFrame(
        [(7, ITEM), (7, ITEM), (8, "too short"), (9, None), (None, ITEM), (10, broken)], "item_id long, text string"
    )
    got = decontaminate.find_leaks(docs_of(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.exact for r in got} == {(1, 7): True, (2, 7): False, (None, 7): True}
    left = decontaminate.drop_leaked(docs_of(spark, rows), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6] and len(left.columns) == 7
    assert decontaminate.find_leaks(docs_of(spark, []), benchmark).count() == 0
    assert decontaminate.find_leaks(docs_of(spark, rows), benchmark.limit(0)).count() == 0


def test_leaks_in_other_case(spark):
    item = "Der Zug mit Anna fährt 120 km auf großer Straße bis er vor der alten Brücke am Fluss hält"
    rows = [(1, f"X {item.upper()} Y", "de"), (2, item.lower(), "de"), (3, item, "de"),
            (4, item.upper().replace("120", "75"), "de"), (5, item.replace("Anna", "Eva"), "de"),
            (6, " ".join(reversed(item.upper().split())), "de")]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.find_leaks(docs_of(spark, rows), benchmark).collect()
    assert {r.doc_id: r.exact for r in got} == {1: True, 2: True, 3: True, 4: False, 5: False}
    assert all(r.n_matched == r.n_item_tokens == 19 for r in got if r.exact)
    left = decontaminate.drop_leaked(docs_of(spark, rows), benchmark)
    assert [r.doc_id for r in left.collect()] == [6]


def test_items_without_templates_are_found_whole(spark):
    items = ["Wer schrieb Faust?", "On 3 5 1998 Otto sold 12 of 40 to 7 at 2 9",
             "水の沸点は何度ですか。", "Yes", "3 + 4 = 7", "!?", " "]
    rows = [(i, f"Before, {t.rstrip('?。')}; after", "de") for i, t in enumerate(items[:5])]
    rows += [(5, "前文" + items[2] + "後文", "ja"), (6, items[1].upper(), "en"), (7, items[1].replace("Otto", "Ada"), "en"),
             (8, "wer schrieb den Faust, yesterday? 3 + 4 = 8", "de"), (None, items[0], "de"), (9, None, "de")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.find_leaks(docs_of(spark, rows), benchmark).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(
        [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 2), (6, 1), (None, 0)], key=str)
    assert all(r.exact and r.n_matched == r.n_item_tokens for r in got)
    left = decontaminate.drop_leaked(docs_of(spark, rows), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [7, 8, 9]


def test_sequences_hash_equal_words_equally(spark):
    words = [f"w{i % 4}" for i in range(21)]
    df = spark.createDataFrame([(words,)], "w array<string>")
    lengths = [1, 2, 3, 5, 8, 13, 21, 30]
    own = decontaminate._sequences(F.col("w"), F.array(*map(F.lit, lengths)), 30)
    want = {tuple(words[i : i + n]) for n in lengths for i in range(len(words) - n + 1)}
    assert len(df.select(own).first()[0]) == len(want)


def test_windows_hash_equal_tokens_equally(spark):
    for width in (1, 3, 8, 10, 13):
        spec = decontaminate.Spec(window=width)
        tokens = [f"t{i % 5}" for i in range(31)]
        df = spark.createDataFrame([(tokens,)], "t array<string>")
        hashes = df.select(decontaminate._windows(F.col("t"), spec)).first()[0]
        want = [tuple(tokens[i : i + width]) for i in range(31 - width + 1)]
        assert len(hashes) == len(want) and len(set(hashes)) == len(set(want))
        assert len({*zip(hashes, want, strict=True)}) == len(set(want))


def plain_canonical(text):
    """Token by token, as the module's docstring says."""
    out = []
    for token in text.split():
        bare = token[0] + token[1:].rstrip(".,;:!?)\"'")
        first = next((c for c in token if c == "<" or unicodedata.category(c)[0] == "L"), "")
        if any("0" <= c <= "9" for c in token):
            out.append("<num>")
        elif out and out[-1] == "<num>" and token.rstrip(".,;:!?)").lower() in decontaminate.UNITS:
            out.append("<unit>")
        elif first and unicodedata.category(first) == "Lu":
            out.append("<name>")
        else:
            out.append(bare.lower())
    return out


def test_canonical_tokens_of_any_text(spark):
    rng = random.Random(7)
    tokens = ["a", "Ab", "x9Y,", "3", "4.5", "km", "KM,", "Min.", "s)", "m'", "<b>Foo", "a<B", "'Anna", '"Eva,"', "--A",
              "...", "!?", ".", "<name>", "\u00c9", "\u00e9.", "\u00df", "\u6c34", "\u0663", "$1", "\\", "\U0001f600"]
    texts = [rng.choice(["", " ", "\n"]) + " ".join(rng.choices(tokens, k=k % 25)) + rng.choice(["", "\t "]) for k in range(500)]
    texts += ["word " * 200_000, "9" * 300_000, "A" * 300_000, " " * 300_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decontaminate.canonical_tokens(F.col("t")))
    assert all(got == plain_canonical(t) for t, got in rows.collect())


def test_windows_of_texts_are_compiled(spark, monkeypatch):
    plans, write = {}, decontaminate.Tables.write

    def seen(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(decontaminate.Tables, "write", seen)
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    got = decontaminate.find_leaks(docs_of(spark, [(1, f"so {ITEM}", "en"), (2, "x", "en")]), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.exact) for r in got] == [(1, 7, True)]
    assert "Generate" in plans["hits"] and "lambda" not in plans["hits"]


def test_bpe_and_digests_of_awkward_rows(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"sa": 256, b"sam": 257}
    got = byte_bpe.encode(docs_of(spark, AWKWARD), ranks, r"\S+|\s+").collect()
    assert len(got) == len(AWKWARD)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in got)
    digests = byte_bpe.digests(docs_of(spark, AWKWARD), ranks, r"\S+|\s+").collect()
    assert [r.n_tokens for r in digests] == [len(r.ids) for r in got]


def test_pages_keep_other_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>", "old"), (2, None, "old")], "page_id long, html string, text string")
    got = html_text.extract(pages).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "a", 1), (2, "", 0)]


def test_languages_are_learned(spark):
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate(
        [("the house and the tree ", "en"), ("der baum und das haus ", "de")] * 20)]
    docs = docs_of(spark, [*rows, (None, "the tree", None), (99, "123", "en"), (98, None, "de")])
    model = language_id.train(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[99].lang_pred == got[98].lang_pred == "und" and got[None].lang_pred == "en"
    assert language_id.keep_identified(docs, model).count() == 41
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_quality_rules_follow_the_labels(spark):
    rng = random.Random(3)
    good = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(60)), "en") for i in range(1500)]
    bad = [(5000 + i, t.replace(" ", "$$ "), "en") for i, t, _ in good[:50]]
    rest = [(6000, "short", "en"), (6001, None, None), (6002, good[0][1], "xx"), (6003, bad[0][1], "xx")]
    docs = docs_of(spark, [*good, *bad, *rest, *[(r[0], r[1], None) for r in AWKWARD if r[0] is None]])
    labels = spark.createDataFrame(
        [(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad] + [(0, 0), (None, 1)], "doc_id long, quality int"
    )
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    assert all(got[i].kept for i, *_ in good) and not any(got[i].kept for i, *_ in bad)
    assert got[6000].base_failed and got[6001].base_failed and not got[6001].kept
    assert got[6002].kept and got[6003].kept  # no labels in that stratum, no cutoff
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 1502
    assert quality_rules.keep_good(docs, labels.limit(0)).count() == 1552


def test_strata_of_some_hundred_labels_get_cutoffs(spark):
    rng = random.Random(5)
    good, bad = [], []
    for at, lang in enumerate(("en", "de", "fr", "es")):
        own = [(1000 * at + i, " ".join(f"w{rng.randrange(900)}" for _ in range(60)), lang) for i in range(320)]
        good += own
        bad += [(1000 * at + 500 + i, t.replace(" ", "$$ "), lang) for i, (_, t, _) in enumerate(own[:5])]
    few = [(9000 + i, t, None) for i, t, _ in good[:200]]  # too few for a test
    docs = docs_of(spark, [*good, *bad, *few])
    labels = spark.createDataFrame([(i, 1) for i, *_ in [*good, *few]], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, labels).collect()}
    assert all(got[i] for i, *_ in [*good, *few]) and not any(got[i] for i, *_ in bad)


def test_rules_together_keep_the_risk():
    # rule 0 rejects nobody, each cutoff of rule 1 one per cent more
    firsts = np.array([[2, 4], *[[2, i] for i in range(4)]])
    firsts, counts = np.vstack([firsts, firsts]), np.array([192, 2, 2, 2, 2] + [9600, 100, 100, 100, 100])
    orders = np.arange(10) < 5
    assert quality_rules.choose_together([2, 4], firsts, counts, orders, 0.03, 0.05) == [2, 2]
    assert quality_rules.choose_together([2, 4], firsts, counts // 50, orders, 0.03, 0.001) == [0, 0]


def test_classifier_orders_documents(spark):
    rows = [(i, f"good words number {i} " * 20 if i % 2 else "junk$$$ " * 60, "en") for i in range(80)]
    docs = docs_of(spark, [*rows, *AWKWARD])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20, 80)] + [(20, 1), (None, 1)], "doc_id long, quality int")
    ranker = quality_classifier.train(docs, labels)
    got = quality_classifier.classify(docs, ranker).collect()
    assert len(got) == 88 and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id and 10 < r.doc_id)
    flat = quality_classifier.train(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.classify(docs, flat).collect()} == {0.5}


def test_shards_of_documents(spark, tmp_path):
    docs = docs_of(spark, AWKWARD).withColumn("slot", F.lit("old"))
    got = sharding.assign(docs, sharding.shard_names(3)).collect()
    table = sharding.fill(sharding.shard_names(3), sharding.table_size(3))
    assert len(got) == len(AWKWARD) and all(table[r.slot] == r.shard for r in got)
    sharding.write_shards(docs.select("doc_id"), sharding.shard_names(3), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(AWKWARD)


BIG = "<p>" + "é" * 700 + "</p>"
PAGES = [(1, "u1", BIG), (2, "u\n2", BIG), (3, None, BIG), (3, None, BIG), (4, "u", "small"), (5, "u", "small"),
         (6, "u", None), (None, "n", BIG), (2**60 + 1, "far", "x" * 100_000)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert kinds == {(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "response", None),
                     (5, "response", None), (6, "response", None), (None, "revisit", 3),
                     (2**60 + 1, "response", None)}
    assert len(got) == 9 and {r.url for r in got if r.page_id == 2} == {"u\n2"}
    html = {p: h for p, _, h in PAGES}
    assert all(bytes(r.payload).decode() == (html[r.page_id] or "") for r in got if r.record_type == "response")
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_damaged_archives_are_refused():
    one = warc.record_bytes(1, "u", b"payload", None)
    assert [r.payload for r in warc.WarcReader(io.BytesIO(one + one))] == [b"payload"] * 2
    plain = zlib.decompress(one, 31)

    def packed(raw):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(raw) + z.flush()

    for broken in (one[:-9], one[:40], one + b"junk", packed(plain.replace(b"payload\r", b"paYload\r")),
                   packed(plain[:-6]), packed(plain + b"x"), packed(plain.replace(b"Content-Length", b"Nothing"))):
        with pytest.raises(warc.WarcError):
            list(warc.WarcReader(io.BytesIO(broken)))


def turns(n_conv=60):
    rng = random.Random(4)
    rows = []
    for c in range(n_conv):
        for t in range(2 * rng.randrange(1, 5)):
            role = "assistant" if t % 2 else "user"
            text = "\n".join("word " * (40 if t % 2 else 8) for _ in range(1 + t % 2)) + ("" if t % 2 else "?")
            rows.append((c, t, role, text))
    return rows


def test_roles_are_recovered(spark):
    rows = turns() + [(None, 0, "user", "hi"), (900, None, None, None)]
    lines = chat_format.transcripts(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    model = chat_format.train(lines)
    got = chat_format.render(lines.drop("role"), model, part=F.floor(F.col("turn") / 64)).collect()
    want = {}
    for c, _, role, _ in rows:
        want.setdefault(c, []).append(role)
    right = sum(r.roles == ",".join(want[r.conv_id]) for r in got if r.conv_id != 900)
    assert len(got) == 62 and right >= 55
    assert all(r.chat.endswith("<|end|>\n") for r in got)


@pytest.mark.parametrize("fan", [2, 256])
def test_parts_give_the_same_path_as_the_whole(spark, fan):
    rows = [(1, t, "assistant" if t % 2 else "user", "w " * (60 if t % 2 else 4)) for t in range(50)] + turns(20)
    lines = chat_format.transcripts(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    model = chat_format.train(lines)
    whole, parts = (
        chat_format.render(lines, model, part=F.floor(F.col("turn") / size), fan=fan).orderBy("part").collect()
        for size in (10_000, 3)
    )
    joined = {}
    for r in parts:
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.chat
    assert joined == {r.conv_id: r.chat for r in whole}
    assert np.isfinite([len(c) for c in joined.values()]).all()


def test_training_lines_are_drawn_below_a_hash(spark):
    rows = turns(3000)
    lines = chat_format.transcripts(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    drawn = below_hash(F.xxhash64("conv_id", F.lit(5)), 2000, lines.count())
    assert 2000 <= lines.where(drawn).count() <= 5000 < lines.count()
    in_order = lines.orderBy(F.xxhash64("conv_id", F.lit(5)), "conv_id", "line_no", "line").limit(2000)
    want = chat_format.train(in_order, max_lines=10**9)
    got = chat_format.train(lines, max_lines=2000)
    assert got.roles == want.roles and np.array_equal(got.move, want.move) and np.array_equal(got.start, want.start)


CLASH = "doc_id long, text string, lang string, _found string, _leak string, _gone string, _digest string"


@pytest.mark.parametrize("n", [0, 3])
def test_clashing_names_and_empty_tables(spark, n):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words), "en", "f", "l", "g", "d") for i in range(n)]
    docs = spark.createDataFrame(rows, CLASH)
    bench = spark.createDataFrame([(0, " ".join(words[5:30]))], "item_id long, text string")
    model = language_id.train(docs)
    pages = html_text.extract(docs.withColumnRenamed("text", "html"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = {
        "pages": pages, "languages": language_id.identify(docs, model),
        "kept": language_id.keep_identified(docs, model),
        "clean": decontaminate.drop_leaked(docs, bench),
        "unlike": decontaminate.drop_leaked(docs, bench.where("item_id > 0")),
        "one": near_dedup.keep_one_of_each(docs),
        "coded": byte_bpe.encode(docs, {bytes([i]): i for i in range(256)}, r"\S+|\s+"),
        "scored": quality_classifier.classify(docs, quality_classifier.train(docs, labels)),
    }
    counts = {name: df.count() for name, df in found.items()}
    assert counts == dict.fromkeys(found, n) | {"clean": 0, "one": min(n, 1)}
    for df in found.values():
        assert {"_found", "_leak", "_gone", "_digest"} <= set(df.columns)


def test_training_rows_are_the_lowest_hashes(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "few", "words"] if i % 3 else ["#", "*"], k=30)), i % 3 and 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality")
    lowest = labels.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(500)
    want = quality_classifier.train(docs, lowest, max_rows=10**6)
    got = quality_classifier.train(docs, labels, max_rows=500)
    assert np.allclose(got.weights, want.weights) and np.isclose(got.cutoff, want.cutoff)
