"""The corpus pipeline: each stage's decisions, awkward rows, and the whole run."""

import pytest

import corpus_pipeline
from jobtide.llm.common import stored, table
from llm import brute, data

STAGE = dict(corpus_pipeline.STAGES)


def test_stages_and_registration():
    import __spark_entry__

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "personal_data", "packing"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, odd, name):
    docs = table(spark, odd, "documents")
    assert STAGE[name](spark, docs, odd).columns == docs.columns


def test_language_drops_texts_without_letters_or_language(spark, odd):
    docs = table(spark, odd, "documents")
    kept = {r.text for r in STAGE["language"](spark, docs, odd).select("text").collect()}
    gone = set(data.texts()) - kept
    assert gone == {t for t in data.texts() if not any(c.isalpha() for c in t or "")} | {"zz " * 40}


def test_one_of_each_group_stays(spark, odd):
    docs = table(spark, odd, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    groups = brute.groups(rows, 5, 80)
    kept = [tuple(r) for r in STAGE["near_duplicates"](spark, docs, odd).select("doc_id", "text").collect()]
    assert sorted(kept, key=repr) == sorted({r for r, c in zip(rows, groups) if r[0] is None or r[0] == c}, key=repr)


def test_benchmark_passages_go(spark, odd):
    docs = table(spark, odd, "documents")
    kept = [r.text for r in STAGE["benchmark"](spark, docs, odd).select("text").collect()]
    holds = [t for t in kept if data.ITEM in (t or "").lower().replace("--", " ") or (t or "").startswith("unique words")]
    assert not holds and len(kept) == docs.count() - 3


def test_personal_data_is_replaced_and_counted(spark, odd):
    docs = table(spark, odd, "documents")
    clean = STAGE["personal_data"](spark, docs, odd).select("text", "n_chars").collect()
    assert len(clean) == docs.count()
    assert any((r.text or "").startswith("mail me at <email> or <phone> or <card> from <ip>") for r in clean)
    assert all(r.n_chars == len(r.text or "") and not brute.base_spans(r.text or "") for r in clean)


def test_whole_run_equals_its_stages(spark):
    docs = table(spark, data.SMALL, "documents")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, data.SMALL), name)
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, data.SMALL).collect()
    assert {r.doc_id for r in packed} == ids
    rows = [(i, t) for i, t in table(spark, data.SMALL, "documents").select("doc_id", "text").collect()]
    group_of = dict(zip((i for i, _ in rows), brute.groups(rows, 5, 80)))
    assert all(group_of[i] == i for i in ids)


@pytest.mark.parametrize("folder", ["odd", "empty"])
def test_run_on_awkward_and_empty_tables(spark, request, folder):
    got = corpus_pipeline.run(spark, request.getfixturevalue(folder)).collect()
    assert bool(got) == (folder == "odd")
