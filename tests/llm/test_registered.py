"""Registered queries on driver tables and on awkward ones, against SQL or brute force."""

import hashlib
import html as entities
import re

import pytest

from checks.compare import connect, difference
from jobtide.llm.queries import ORACLE, QUERIES
from llm import brute, data

FOLDERS = ["small", "odd"]


@pytest.fixture(params=FOLDERS)
def folder(request):
    return data.SMALL if request.param == "small" else request.getfixturevalue(request.param)


def docs_of(folder):
    frame = data.read(folder, "documents")
    return [(None if i != i else int(i), t) for i, t in zip(frame.doc_id, frame.text)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, data.SMALL), connect(data.SMALL), ORACLE[name]) is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_names_are_in_order(name):
    assert re.fullmatch(r"op\d+_\w+", name)


def test_op1_odd_rows(spark, odd):
    got = {(r.doc_id, r.n_words): r for r in QUERIES["op1_decontaminate"](spark, odd).collect()}
    item, words = data.ITEM.split(), lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))
    assert len(got) == len({(i, t) for i, t in docs_of(odd)})
    for doc_id, text in docs_of(odd):
        row = got[(doc_id, words(text))]
        has_item = data.ITEM in (text or "").lower().replace("--", " ")
        has_short = (text or "").startswith("unique words")
        assert row.n_hit == (len(item) if has_item else 2 if has_short else 0)
        ids = [str(i) for i, there in ((1, has_item), (2, has_short)) if there]
        assert row.n_items == len(ids) and row.contaminated == bool(ids)
        assert row.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_op1_same_rows_without_broadcast(spark, odd, rows):
    from jobtide.llm.common import table
    from jobtide.llm.decontaminate import decontaminate

    docs, items = table(spark, odd, "documents"), table(spark, odd, "benchmark")
    assert rows(decontaminate(docs, items, limit=-1)) == rows(decontaminate(docs, items))


def test_op2_held_out_accuracy(spark):
    got = QUERIES["op2_language"](spark, data.SMALL).toPandas().merge(data.read(data.SMALL, "documents"), on="doc_id")
    import zlib

    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_op2_odd_rows(spark, odd):
    got = QUERIES["op2_language"](spark, odd).collect()
    assert len(got) == len(docs_of(odd))
    by_id = {r.doc_id: r for r in got}
    for place in range(4):  # null, empty, blank, no letter
        assert (by_id[place * 3].lang_pred, by_id[place * 3].score) == ("und", 0.0)
    assert {r.lang_pred for r in got} <= {"und", "en", "de"}


def test_op3_odd_rows(spark, odd):
    got = QUERIES["op3_spotsigs"](spark, odd).collect()
    rows = sorted(docs_of(odd), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in rows)
    prints = {}
    texts = {(i, len(t or "")): t or "" for i, t in rows}
    for r in got:
        text = texts[(r.doc_id, r.n_chars)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
    assert len(set(prints.values())) >= len(prints) - 2  # the upper-case copy shares one


def test_op4_base_spans(spark, folder):
    got = {(r.doc_id, r.base_sha256) for r in QUERIES["op4_pii"](spark, folder).collect()}
    for doc_id, text in docs_of(folder):
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text or ""))
        assert (doc_id, hashlib.sha256(listed.encode()).hexdigest()) in got


def test_op5_packs_every_token_once(spark, folder):
    got = QUERIES["op5_packing"](spark, folder).toPandas()
    rows = docs_of(folder)
    ids = [[*i, 0] for i in brute.tokens([t or "" for _, t in rows])]
    total = sum(map(len, ids))
    assert got.length.sum() == total
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
    assert ordered.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= -(-total // 2048) + 1
    pieces = {(None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()}
    from jobtide.llm.packing import cut

    wanted = {(name, k, s, n, brute.crc(i[s:s + n])) for (name, _), i in zip(rows, ids) for k, (s, n) in enumerate(cut(len(i)))}
    assert pieces == wanted


def test_op6_shards_are_even_and_gapless(spark, folder):
    got = QUERIES["op6_sharding"](spark, folder).toPandas()
    rows = docs_of(folder)
    assert len(got) == len(rows)
    counts = got.groupby("shard").size().reindex(range(24), fill_value=0)
    assert counts.max() - counts.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 8 for _, t in rows)
    assert sorted(got.text_crc32) == sorted(__import__("zlib").crc32((t or "").encode()) for _, t in rows)


def test_op7_groups_equal_all_pairs(spark, folder):
    got = sorted((r.n_shingles, r.doc_id is None, r.doc_id, r.component_id) for r in QUERIES["op7_near_duplicates"](spark, folder).collect())
    rows = docs_of(folder)
    found = brute.groups(rows, 3, 90)
    assert got == sorted((len(brute.shingles(t, 3)), i is None, i, c) for (i, t), c in zip(rows, found))


def test_op8_reads_back_every_id(spark, folder):
    got = [tuple(r) for r in QUERIES["op8_token_files"](spark, folder).collect()]
    rows = docs_of(folder)
    ids = [[*i, 2] for i in brute.tokens([t or "" for _, t in rows])]
    assert sorted((n, c) for _, _, n, c in got) == sorted((len(i), brute.crc(i)) for i in ids)
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == [sum(r[2] for r in by_start[:k]) for k in range(len(by_start))]
    names = [r[0] for r in by_start]
    assert names == sorted(names, key=lambda n: (n is not None, n or 0))


def test_op9_odd_rows(spark, odd):
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in QUERIES["op9_urls"](spark, odd).collect()}
    assert got[(1, "a.example.org", "/es/1")] == ("example.org/es/", "block")
    assert got[(2, "sub.example.org", "/en/17")] == ("example.org/en/1", "block")
    assert got[(3, "", "")][0] is None and got[(4, "", "")][0] is None
    assert got[(5, "x.com", "")][0] is None
    assert got[(6, "x.com", "/de/5")] == ("com/de/", "block") and got[(7, "x.com", "/fr/5")] == ("com/fr/", "allow")
    assert len(QUERIES["op9_urls"](spark, odd).collect()) == 10


def test_op10_odd_pages(spark, odd):
    got = [(r.page_id, r.text, r.n_chars) for r in QUERIES["op10_main_text"](spark, odd).collect()]
    article = "Title One bold & plain line. Two two."
    wanted = [(1, article), (2, article), (3, ""), (4, ""), (5, "plain text only"), (6, "cut in the mid"), (7, "a b"),
              (1, article), (None, "in main"), (8, "yes")]
    assert sorted(got, key=repr) == sorted([(i, t, len(t)) for i, t in wanted], key=repr)


def test_op10_articles_of_the_driver_pages(spark):
    frame = data.read(data.SMALL, "pages")
    got = {r.page_id: r.text for r in QUERIES["op10_main_text"](spark, data.SMALL).collect()}
    for name, html in zip(frame.page_id, frame.html):
        inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
        assert got[name] == " ".join(b for b in blocks if b)
