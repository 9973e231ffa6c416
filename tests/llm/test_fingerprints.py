"""Multiset fingerprints: their algebra, and edits against a plain version."""

import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import fingerprints
from starloom.llm.fingerprints import Print, fingerprint

texts = st.text(alphabet="ab \n", max_size=40)


@given(texts, texts)
def test_texts_add_up(a, b):
    both = fingerprint(a + "\n" + b)
    assert both == fingerprint(a) + fingerprint(b)
    assert both - fingerprint(b) == fingerprint(a)


@given(st.lists(st.text(alphabet="ab c", max_size=9), min_size=1, max_size=8), st.randoms())
def test_order_of_paragraphs_does_not_matter(paragraphs, random):
    mixed = list(paragraphs)
    random.shuffle(mixed)
    assert fingerprint("\n".join(mixed)) == fingerprint("\n".join(paragraphs))


@given(texts, texts)
def test_other_paragraphs_give_other_fingerprints(a, b):
    assert (fingerprint(a) == fingerprint(b)) == (sorted(a.split("\n")) == sorted(b.split("\n")))


def test_likeness_lanes_equal_plain_ones():
    """Windows counted one by one, with the signs of a paragraph's windows."""
    text = "a b c d\n\nx y\na b c d e\n  \nz"
    windows = ["a b c", "b c d", "x y", "a b c", "b c d", "c d e", "z"]
    total = sum(fingerprint(w).lanes.astype(int) for w in windows)
    assert (fingerprint(text).lanes == total).all()
    assert set(np.unique(fingerprint("x y").lanes)) == {-1, 1}
    assert not fingerprint(" \n").lanes.any()


def test_likeness():
    random = np.random.default_rng(0)
    words = [f"w{i}" for i in random.integers(0, 10**6, 4000)]
    own = fingerprint(" ".join(words[:2000]))
    half = fingerprint(" ".join(words[:1000] + words[2000:3000]))
    other = fingerprint(" ".join(words[2000:4000]))
    assert own.likeness(own) == 1
    assert abs(own.likeness(half) - 0.5) < 0.2
    assert own.likeness(other) < 0.25
    empty = fingerprint(None)
    assert empty == fingerprint("") and empty.likeness(empty) == 1
    assert empty.likeness(fingerprint("\n")) == 0 and empty.likeness(own) == 0


def test_bytes_round_trip():
    one = fingerprint("a b\nc")
    assert Print.from_bytes(one.to_bytes()) == one
    with pytest.raises(ValueError):
        fingerprints.Spec(lanes=100)


def test_long_texts_wrap_without_error():
    text = "a b c\n" * 200_000
    assert fingerprint(text) - fingerprint(text[:-6]) == fingerprint("a b c")


def plain(rows):
    """The documented order, one document after the other."""
    rows = [(k, t or "", h) for k, t, h in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), -r[2]))
    out = []
    for i, (key, text, _) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other = fingerprint(text), fingerprint(changed)
        out.append((
            key, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.to_bytes(),
            other.to_bytes(), own.likeness(other), own.likeness(fingerprint(after)),
        ))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(
        ((*r[:3], bytes(r[3]), bytes(r[4]), *r[5:]) for r in fingerprints.edits(df, **options).collect()),
        key=repr,
    )


def hashed(df):
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_edits_equal_plain_ones(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    random = np.random.default_rng(5)
    rows = [
        (int(i) * 7 - 50, "\n".join(" ".join(f"w{random.integers(50)}" for _ in range(random.integers(0, 12)))
                          for _ in range(random.integers(1, 7))))
        for i in random.permutation(60)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == plain(hashed(df))


def test_edits_of_odd_rows(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    rows = [
        (None, "no key\nat all"), (None, None), (3, "é€😀 x\ny"), (3, "another text of this key"),
        (3, "another text of this key"), (2, ""), (1, None), (0, "x"), (-4, "a\nb " * 5000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(hashed(df))
    assert found(df.where("doc_id = 0")) == plain(hashed(df.where("doc_id = 0")))
    assert found(df.where("false")) == []


def test_a_key_with_most_rows_is_cut_into_ranges(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    df = spark.range(400).select(
        F.when(F.col("id") % 4 > 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )
    keyed = df.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.xxhash64("text").alias("h"))
    places = fingerprints._placed(keyed, fingerprints._ranges(keyed, 8)).groupBy("place").count().collect()
    assert max(r["count"] for r in places) < 120
    assert found(df) == plain(hashed(df))


def test_edits_beside_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    wanted = found(df)
    for name in ("k", "t", "h", "place", "visits", "n_chars"):
        assert found(df.withColumn(name, F.lit(9))) == wanted


def test_column_of_fingerprints(spark):
    df = spark.createDataFrame([("a\nb",), (None,), ("",)], "text string")
    got = [bytes(r[0]) for r in df.select(fingerprints.fingerprints(df)).collect()]
    assert got == [fingerprint(t).to_bytes() for t in ("a\nb", None, "")]
