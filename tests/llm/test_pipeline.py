"""The whole pipeline against a plain version of it, on the smallest of the driver's data."""

from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from starloom.llm import language_id, quality_rules
from starloom.llm.queries import ranks
from starloom.llm.text import measures, shingles

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


def good(docs, labels):
    rules = quality_rules.RULES
    names = quality_rules.MEASURES
    passed = []
    for d in docs:
        m = dict(zip(names, measures(d.text), strict=True))
        if m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"]:
            passed.append((d, m))
    strata = {d.lang or "" for d, _ in passed if labels.get(d.doc_id) == 1}

    def rejects(rule, cutoff, m):
        part, bound = m[rule.part], m[rule.whole] * cutoff
        return part < bound if rule.below else part > bound

    cutoffs = {}
    for s in strata:
        own = [m for d, m in passed if (d.lang or "") == s and labels.get(d.doc_id) == 1]
        for rule in rules:
            hits = [sum(rejects(rule, c, m) for m in own) for c in rule.cutoffs]
            cutoffs[s, rule.name] = quality_rules.choose_cutoff(
                rule.cutoffs, hits, len(own), 0.02 / len(rules), 0.05 / len(rules) / len(strata)
            )
    return [
        d
        for d, m in passed
        if not any(
            (c := cutoffs.get((d.lang or "", r.name))) is not None and rejects(r, c, m) for r in rules
        )
    ]


def one_of_each(docs):
    sets = [set(shingles(d.text, 5).tolist()) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b) > 0:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d.doc_id), d.doc_id)
    return [d for i, d in enumerate(docs) if least[find(i)] == d.doc_id]


def test_run_equals_the_plain_version(spark):
    tables = {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    docs = tables["documents"].collect()
    left = good(docs, {r.doc_id: r.quality for r in tables["labels"].collect()})
    model = language_id.train(spark.createDataFrame(left, tables["documents"].schema))
    scores = language_id.score(__import__("pandas").Series([d.text for d in left]), model)
    left = [d for d, n, s in zip(left, scores["lang_pred"], scores["score"], strict=True) if n != "und" and s >= 0.5]
    left = one_of_each(left)
    items = [" ".join(r.text.split()) for r in tables["benchmark"].collect()]
    left = [d for d in left if not any(i in " ".join(d.text.split()) for i in items)]
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(d.doc_id for d in left)
    of = {d.doc_id: d.text for d in left}
    assert all(r.decodes and list(r.ids) == known.encode_ordinary(of[r.doc_id]) for r in got)
    assert 100 < len(got) < len(docs)


def test_stages_take_empty_tables_and_odd_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    odd = docs.selectExpr("*", "1 kept", "2 kept_text", "3 _m", "4 score")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, odd, SF_DIR).columns == odd.columns
    assert corpus_pipeline.STAGES[3][1](spark, odd, SF_DIR).count() == 0
