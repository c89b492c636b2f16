"""Operators by themselves: hand-worked cases, properties, other parameters."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide.llm import common, dac, decontaminate, extract, language, near, packing, pii, sharding, shingles, spotsigs, tokens, urls
from jobtide.llm.common import running_sums, salted_offsets, salted_ranks, stored
from llm import brute, data


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


# --- shared expressions -----------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_running_sums(spark, n):
    values = [(i * 7) % 13 for i in range(n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(running_sums(F.col("v")).alias("s")).first()
    assert row["s"] == np.cumsum(values).tolist()


def test_salted_ranks_and_offsets_are_gapless(spark):
    df = stored(spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 5).alias("v")), "t")
    ranked = salted_ranks(df, ["k"], ["id"], 7).collect()
    by_key = {}
    for r in ranked:
        by_key.setdefault(r.k, []).append(r.rank)
    assert all(sorted(v) == list(range(len(v))) for v in by_key.values()) and len(by_key["hot"]) == 1000
    sums = sorted((r.before, r.v) for r in salted_offsets(df, [], "v", ["id"], 7, "before").collect())
    total = 0
    for before, v in sums:
        assert before == total
        total += v


# --- personal data ----------------------------------------------------------------------------


@pytest.mark.parametrize("digits,ok", [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("", False), ("18", True)])
def test_luhn(spark, digits, ok):
    assert one(spark, pii.luhn(F.col("d")), d=digits) is ok


@pytest.mark.parametrize("account,ok", [("DE89370400440532013000", True), ("GB82WEST12345698765432", True), ("DE89370400440532013001", False)])
def test_mod97(spark, account, ok):
    assert one(spark, pii.mod97(F.col("a")), a=account) is ok


def found(spark, text):
    row = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()
    return [(s.kind, text[s.start:s.end], s.base) for s in row.pii]


def test_added_spans(spark):
    assert found(spark, "+1 (724) 555-7058 4041894974608795") == [
        ("card", "4041894974608795", False), ("phone", "+1 (724) 555-7058", False)]
    assert ("iban", "DE89 3704 0044 0532 0130 00", False) in found(spark, "IBAN DE89 3704 0044 0532 0130 00.")
    assert found(spark, "ssn 123-45-6789")[-1] == ("ssn", "123-45-6789", False)
    assert found(spark, "part 123-45-6789") == []


@pytest.mark.parametrize("separator", [" ", "-"])
def test_cards_with_every_digit_apart(spark, separator):
    card = separator.join("4111111111111111")
    assert found(spark, f"card {card}.") == [("card", card, True)]
    row = pii.redact(pii.find_pii(spark.createDataFrame([(f"card {card}.",)], "text string"))).first()
    assert row["text"] == "card <card>."


def test_redaction_joins_overlaps_and_keeps_the_rest(spark):
    text = "a@b.cd, 10.0.0.1 \U0001F600 a.b@c.de4111111111111111 end"
    row = pii.redact(pii.find_pii(spark.createDataFrame([(text,), (None,), ("clean",)], "text string"))).collect()
    assert row[0]["text"].startswith("<email>, <ip> \U0001F600 <email>") and row[0]["text"].endswith(" end")
    assert row[1]["text"] is None and row[2]["text"] == "clean"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="a1.@ -+()_%é\U0001F600", max_size=30), min_size=20, max_size=20))
def test_base_spans_equal_the_plain_patterns(spark, texts):
    rows = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).collect()
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.pii if s.base] == brute.base_spans(r.text)


# --- tokens, files, packing -------------------------------------------------------------------

PARTS = ["a", "b'll", " ", "  ", "\n", "\t", " ", " é", "1", "!?", "\x1c", "　", "<|endoftext|>", "\x00", "'s", "\u0085", "中文", "\r\n", "word,", "\x01"]


def test_parts_give_the_ids_of_whole_texts():
    rng, encoder = random.Random(5), tokens.Encoder(tokens.default_tokenizer(), memo_parts=50)
    for _ in range(20):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(300)]
        assert all(np.array_equal(a, b) for a, b in zip(encoder.encode(texts), encoder.whole(texts)))


def test_added_tokens_have_the_ids_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_tokenizer())
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a b<|endoftext|><|endoftext|>c\nd", "one <|endoftext| > two", "one two"]
    got = [ids.tolist() for ids in tokens.Encoder(tokens.default_tokenizer()).encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got[0] == [505, 220, 50256, 734]


def test_long_texts_are_encoded_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "LONG_BYTES", 200)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 50)
    encoder, texts = tokens.Encoder(tokens.default_tokenizer()), [data.PROSE * 9, "x" * 900, "a\nb " + data.PROSE * 3 + "end"]
    assert all(np.array_equal(a, b) for a, b in zip(encoder.encode(texts), encoder.whole(texts)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_any_run_of_coded_ids(ids, draw):
    coded = dac.CodedIds(dac.encode_ids(np.array(ids, np.uint32)))
    assert len(coded) == len(ids)
    a = draw.draw(st.integers(0, len(ids)))
    b = draw.draw(st.integers(a, len(ids)))
    assert coded.run(a, b).tolist() == ids[a:b]
    if ids:
        i = draw.draw(st.integers(0, len(ids) - 1))
        assert coded[i] == ids[i]


def bins(items, capacity):
    """The fewest sequences, by trying all placements."""
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in sorted(set(rooms)):
            if k >= items[i]:
                at = rooms.index(k)
                go(i + 1, rooms[:at] + [k - items[i]] + rooms[at + 1:])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best


def planned(counts, capacity):
    fixed, left = packing.reduce_counts(counts, capacity)
    return fixed, left, fixed + packing.best_fit(left, capacity)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_fixed_sets_lose_no_sequence(items):
    counts = np.bincount(items, minlength=21)
    fixed, left, plan = planned(counts, 20)
    used = np.zeros(21, np.int64)
    for pattern, times in plan:
        assert sum(size * n for size, n in pattern) <= 20
        for size, n in pattern:
            used[size] += n * times
    assert used.tolist() == counts.tolist()
    rest = list(itertools.chain.from_iterable([s] * int(n) for s, n in enumerate(left)))
    whole = sorted(items, reverse=True)
    assert sum(t for _, t in fixed) + (bins(sorted(rest, reverse=True), 20) if rest else 0) == bins(whole, 20)


def test_best_fit_by_counts_equals_one_by_one():
    rng = random.Random(2)
    for _ in range(50):
        items = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        rooms = []
        for x in items:
            fitting = [r for r in rooms if r >= x]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - x)
            else:
                rooms.append(40 - x)
        plan = packing.best_fit(np.bincount(items, minlength=41), 40)
        assert sum(t for _, t in plan) == len(rooms)


@pytest.mark.parametrize("length,pieces", [(1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]), (4096, [(0, 2048), (2048, 2048)])])
def test_cut(length, pieces):
    assert packing.cut(length) == pieces


# --- shingles, near copies --------------------------------------------------------------------


def test_shingle_sets_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(shingles, "PIECE_BYTES", 120)
    texts = [*data.texts(), "\x1ca b", "a\tb\x0bc\x0cd e"]
    for size in (1, 3, 5):
        got = shingles.shingle_sets(texts, size)
        seen = {}
        for text, own in zip(texts, got):
            plain = brute.shingles(text, size)
            assert len(own) == len(plain) and seen.setdefault(plain, own.tolist()) == own.tolist()


def copies(spark):
    """A text and near copies of it with one to several words replaced, and other texts."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 500)}" for _ in range(60)]
    rows = []
    for i in range(90):
        words = list(base) if i % 3 else [f"v{rng.randint(0, 500)}" for _ in range(60)]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 30)}"
        rows.append((i, " ".join(words)))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string")


def test_shingles_are_handed_back_in_short_batches():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 64, 50_000, np.uint64)) for _ in range(12)]
    rows = near._send_batch(7, list(range(12)), [bytes([k]) * 16 for k in range(12)], sets, 54)
    batches = list(near._short(rows, near._SENT))
    assert len(batches) > 3
    assert max(b.nbytes for b in batches) < 2 * near.SENT_BYTES
    sent = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    found = np.concatenate([near._unpacked(r[2], r[3]) for r in sent if r[2] is not None])
    assert found.tolist() == np.sort(np.concatenate(sets)).tolist()
    assert [r[6] for r in sent if r[2] is None] == [list(range(12))]


def test_tasks_let_go_of_what_only_other_tasks_use():
    path = tokens.default_tokenizer()
    kept = tokens.encoder(path)
    assert list(common.tidy(iter, uses="encoder")([1])) == [1]
    assert tokens.encoder(path) is kept
    assert list(common.tidy(iter)([1])) == [1]
    assert tokens.encoder.cache_info().currsize == 0


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 60)])
@pytest.mark.parametrize("chunk", [8, 384])
def test_groups_of_many_near_copies(spark, monkeypatch, size, percent, chunk):
    monkeypatch.setattr(near, "CHUNK", chunk)
    rows, df = copies(spark)
    got = {r.doc_id: r.component_id for r in near.near_duplicates(df, size, percent).collect()}
    assert got == dict(zip((i for i, _ in rows), brute.groups(rows, size, percent)))


def test_buckets_frequent_in_a_batch_are_counted(spark, monkeypatch):
    rows = [(i, f"common start here {i} {i + 1000} {i + 2000}") for i in range(200)] + [(500, "common start here 7 1007 2007")]
    got = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[500] == got[7] == 7 and sum(a != b for a, b in got.items()) == 1


def test_components_of_a_long_shuffled_chain(spark):
    names = list(range(3000))
    random.Random(6).shuffle(names)
    chain = list(zip(names[:2500], names[1:2500])) + list(zip(names[2500:], names[2501:]))
    got = {r.node: r.label for r in near.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {n: min(part) for part in (names[:2500], names[2500:]) for n in part}


def test_labels_are_in_few_files_and_edges_made_once(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    try:
        edges = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(100)], "a bigint, b bigint")
        labels = near.components(edges.mapInArrow(count, edges.schema), 100)
        assert made.value == 100
        assert len(labels.inputFiles()) == 1
        assert {(r.node, r.label) for r in labels.collect()} == {(k, k - k % 2) for k in range(200)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def rare_first(sets, percent):
    """(prefixes, alone) of sets, from the counts over all of them."""
    counts = collections.Counter(t for one in sets for t in one.tolist())
    prefixes, alone = [], []
    for one in sets:
        order = sorted(one.tolist(), key=lambda t: (counts[t], t))
        single = sum(counts[t] == 1 for t in order)
        reach = max(0, near.prefix_length(len(order), percent) - single)
        prefixes.append(np.array(order[single:single + reach], np.uint64).view(np.int64))
        alone.append(single)
    return prefixes, np.array(alone)


@pytest.mark.parametrize("few", [0, 1 << 30])
@pytest.mark.parametrize("percent", [50, 80, 90])
def test_filters_lose_no_link(monkeypatch, few, percent):
    monkeypatch.setattr(near, "FEW", few)
    rng = np.random.default_rng(percent)
    for _ in range(20):
        base = [rng.integers(0, 1 << 63, rng.integers(3, 60)).astype(np.uint64) * np.uint64(2) for _ in range(4)]
        sets = []
        for _ in range(14):
            own = base[rng.integers(0, 4)]
            kept = own[rng.random(len(own)) > rng.choice([0, 0.05, 0.3])]
            sets.append(np.unique(np.concatenate([kept, own[:1], rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64)])))
        prefixes, alone = rare_first(sets, percent)
        first, second = np.arange(8), np.arange(8, 14)
        for left, right in ((first, first), (first, second)):
            wanted = set()
            for i in left.tolist():
                for j in right.tolist():
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if (left is not right or i < j) and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        wanted.add((i, j))
            assert set(near.links_of(sets, prefixes, alone, left, right, percent)) == wanted


@pytest.mark.parametrize("width", [1, 300, 1 << 20, (1 << 40) - 1, (1 << 64) - 1])
def test_planes_and_gaps_come_back(width):
    values = np.unique(np.random.default_rng(3).integers(0, width, 50, dtype=np.uint64, endpoint=True))
    assert near._from_planes(near._planes(values)).tolist() == values.tolist()
    assert near._unpacked(*near._packed(values)).tolist() == values.tolist()


def test_totals_by_slices(monkeypatch):
    rng = np.random.default_rng(2)
    places = [np.sort(rng.integers(0, 1 << 60, 400).astype(np.uint64) % np.uint64(500) << np.uint64(50)) for _ in range(5)]
    times = [rng.integers(1, 9, 400) for _ in range(5)]
    whole = near._totals(places, times)
    monkeypatch.setattr(near, "SLICE_SHINGLES", 70)
    assert all(np.array_equal(a, b) for a, b in zip(whole, near._totals(places, times)))
    sums = collections.Counter()
    for p, t in zip(places, times):
        for value, n in zip(p.tolist(), t.tolist()):
            sums[value] += n
    assert [sums[v] for v in places[0].tolist()] == whole[0].tolist()


def test_strangers_that_share_half_a_hash_meet_in_no_block(spark, monkeypatch, rows):
    """Shingles in only some 20 buckets of their upper 32 bits, a load of hundreds."""
    real = near.shingle_sets

    def crowded(texts, size):
        return [np.unique((s & np.uint64(0xFFFFFFFF)) | (s % np.uint64(20)) << np.uint64(60)) for s in real(texts, size)]

    monkeypatch.setattr(near, "shingle_sets", crowded)
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(120))
    docs = spark.createDataFrame([(i, text(i)) for i in range(60)] + [(99, text(7) + " more")], "doc_id bigint, text string").coalesce(1)
    prefixes = near.document_prefixes(docs, 3, 90)
    assert {r.doc_id for r in prefixes.where("size(prefix) > 0").collect()} <= {7, 99}
    classes = prefixes.where("n > 0").select("class", "doc_id", "n", "prefix")
    assert near.clusters(classes).count() <= 2
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    assert got == {**{i: i for i in range(60)}, 99: 7}


# --- language, fingerprints -------------------------------------------------------------------


def test_language_of_long_text_in_pieces(spark, monkeypatch):
    sample = [("aa", language.text_features("aba bab abba " * 4)), ("bb", language.text_features("xyz zyx yxz " * 4))]
    model = language.fit(sample)
    predict = language.predict(model).func
    import pandas as pd

    texts = pd.Series(["xyz " * 50, "aba " * 50, None, "12 34", "xyz zyx yxz aba"])
    whole = next(predict(iter([texts])))
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 16)
    assert next(predict(iter([texts]))).equals(whole)
    assert whole.lang_pred.tolist() == ["bb", "aa", "und", "und", "bb"]


@pytest.mark.parametrize("at_once", [16, 1 << 18])
def test_the_norm_counts_the_ngrams_of_no_landmark(spark, monkeypatch, at_once):
    import pandas as pd

    strange = " ".join(f"{a}{b}{a}{a}" for a in "жщюяэ" for b in "бгдйл")
    texts = ["xyz zyx yxz", f"xyz zyx yxz {strange}", None, strange, "aba"]
    model = language.fit([("aa", language.text_features("aba bab abba " * 4)), ("bb", language.text_features("xyz zyx yxz " * 4))])
    monkeypatch.setattr(language, "CHARS_AT_ONCE", at_once)
    scores = next(language.predict(model).func(iter([pd.Series(texts)]))).score
    assert scores[0] > 0.9 and scores[1] < scores[0] / 2
    _, sizes, _ = language._presence(texts, model.landmarks.column_of, model.landmarks.width)
    assert sizes.tolist() == [len(language.text_features(t)) for t in texts]


def _made_up(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_blocks_of_features_give_the_same_model_and_scores(monkeypatch):
    import pickle

    import pandas as pd

    rng = random.Random(1)
    sample = [(lang, language.text_features(_made_up(rng, letters, 40))) for lang, letters in
              (("aa", "abcde"), ("bb", "defgh"), ("cc", "hijkl")) for _ in range(8)]
    texts = pd.Series([_made_up(rng, letters, 20) for letters in ("abcde", "defgh", "hijkl", "xyz")] + [None])
    model = language.fit(sample, 5)
    whole = next(language.predict(model).func(iter([texts])))
    assert "_whole" in model.landmarks.__dict__ and "_whole" not in pickle.loads(pickle.dumps(model)).landmarks.__dict__
    monkeypatch.setattr(language, "CELLS_AT_ONCE", 300)
    parts = language.fit(sample, 5)
    assert np.allclose(parts.weights, model.weights, atol=1e-3)
    got = next(language.predict(parts).func(iter([texts])))
    assert got.lang_pred.tolist() == whole.lang_pred.tolist() == ["aa", "bb", "cc", whole.lang_pred[3], "und"]
    assert np.allclose(got.score, whole.score, atol=1e-3)


def test_600_languages(spark):
    rng = random.Random(2)
    alphabets = {f"l{k:03d}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyzäöüéèñçøåß", 6)) for k in range(600)}
    rows = [(n, _made_up(rng, letters, 25), lang) for n, (lang, letters) in enumerate(list(alphabets.items()) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert language.shares(600) == (6, 41) and len(model.languages) > 500
    tested = [(n, _made_up(rng, alphabets[lang], 40), lang) for n, lang in enumerate(rng.sample(model.languages, 100))]
    test = spark.createDataFrame(tested, "doc_id long, text string, lang string").coalesce(2)
    got = test.select("lang", language.predict(model)("text").alias("p")).select("lang", "p.lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 90


def test_no_labelled_text_means_unknown(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    scored = docs.select(language.predict(language.learn(docs))("text").alias("p")).first()["p"]
    assert (scored["lang_pred"], scored["score"]) == ("und", 0.0)


def test_case_and_punctuation_leave_a_fingerprint_alone(spark):
    texts = ["The house of stone, and the river.", "the HOUSE of stone and the river", "The house of clay and the river", "", "!!", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.f for r in df.select("i", spotsigs.fingerprint(spotsigs.signatures(F.col("t"))).alias("f")).orderBy("i").collect()]
    assert got[0] == got[1] != got[2] and got[3] == got[5] != got[4]


def test_next_document_goes_round_the_end(spark):
    docs = spark.range(0, 500, 1, 4).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = {r.doc_id: r.next_text for r in spotsigs.with_next(docs).collect()}
    assert got == {i * 3: f"t{(i - 1) % 500}" for i in range(500)}


# --- shards, urls, pages ----------------------------------------------------------------------


def test_groups_stay_together_and_the_largest_is_split_evenly(spark):
    rows = [(i, "hot") for i in range(400)] + [(i, f"pair {i // 2}") for i in range(400, 800)] + [(i, f"single {i}") for i in range(800, 1200)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    assert got.groupby("shard").size().tolist() == [50] * 24
    assert all(sorted(g.slot) == list(range(50)) for _, g in got.groupby("shard"))
    pairs = got[(got.doc_id >= 400) & (got.doc_id < 800)].assign(pair=lambda f: f.doc_id // 2).groupby("pair").shard.nunique()
    assert (pairs == 1).mean() > 0.9
    assert got[got.doc_id < 400].shard.nunique() <= 14


def test_only_linked_documents_leave_no_room(spark):
    rows = [(i, f"group {i % 10}") for i in range(480)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    assert got.groupby("shard").size().tolist() == [20] * 24
    together = got.merge(got[["doc_id"]].assign(group=lambda f: f.doc_id % 10)[["doc_id", "group"]], on="doc_id", suffixes=("_x", ""))
    assert together.groupby("group").shard.nunique().mean() < 12


def test_longest_rule_wins_and_hosts_match_whole_labels(spark):
    rows = [("https://shop.example.org/es/1",), ("https://example.orgx/es/1",), ("https://norg/a",), ("https://a.b.org/x",), ("ftp://EXAMPLE.org/en/12",)]
    got = urls.apply_rules(urls.split_url(spark.createDataFrame(rows, "url string"))).select("rule", "rule_verdict").collect()
    assert [tuple(r) for r in got] == [
        ("example.org/es/", "block"), (None, None), (None, None), ("org/", "allow"), ("example.org/en/1", "block")]


def test_variable_segments_become_wildcards(spark):
    rows = [(i, f"https://x.net/blog/word-{'abcdefghijklmnopqrstuvwxyz'[i]}") for i in range(26)] + [(30 + i, "https://x.net/about") for i in range(5)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert {r.template for r in got if r.page_id < 26} == {"/blog/*"} and {r.template for r in got if r.page_id >= 30} == {"/about"}
    assert {r.verdict for r in got} == {"allow"}


def _plain_templates(shapes, most):
    """Templates by walking each host's tree from the top, over (host, shape, n) rows."""
    done = {}
    state = []
    for host, shape, n in shapes:
        parts = shape.split("/")
        state.append([host, shape, n, parts if len(parts) <= most else [*parts[:most - 1], "/".join(parts[most - 1:])], []])
    for d in range(most):
        nodes = collections.defaultdict(lambda: collections.defaultdict(int))
        for host, _, n, parts, made in state:
            if len(parts) > d:
                nodes[host, tuple(made)][parts[d]] += n
        for row in state:
            host, _, _, parts, made = row
            if len(parts) > d:
                children = nodes[host, tuple(made)]
                varies = len(children) >= urls.MIN_CHILDREN and sum(children.values()) < urls.ROWS_PER_CHILD * len(children)
                row[4] = [*made, "*" if varies else parts[d]]
    for host, shape, _, _, made in state:
        done[host, shape] = "/".join(made)
    return done


@pytest.mark.parametrize("most", [3, 12])
def test_templates_equal_a_walk_from_the_top(spark, most):
    rng = random.Random(12)
    names = [f"n{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    shapes = {}
    for _ in range(400):
        host = rng.choice(["a", "b"])
        # Variable names, titles that differ below each of them, and a few parts.
        parts = ["", rng.choice(names), f"t{rng.choice(names)}{rng.choice(names)}", rng.choice(["view", "edit"]), *rng.choices(names, k=rng.randint(0, 3))]
        shapes[host, "/".join(parts[:rng.randint(1, len(parts))])] = rng.randint(1, 2)
    rows = [(h, s, n) for (h, s), n in shapes.items()] + [("c", "", 4)]
    got = urls.generalise(spark.createDataFrame(rows, "host string, shape string, n bigint"), most_depth=most).collect()
    assert {(r.host, r["shape"]): r.template for r in got} == _plain_templates(rows, most)


def test_two_variable_levels(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"https://x.net/{a}user/{b}title{a}/view",) for a in letters for b in letters[:2]] * 1
    got = urls.judge_urls(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id bigint, url string")).collect()
    assert {r.template for r in got} == {"/*/*/view"}


def test_repeated_unnamed_blocks_go_and_repeated_articles_stay(spark):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))

    slogan, rows = prose(40), []
    for i in range(60):
        body = prose(60) if i % 10 else data.PROSE * 2
        rows.append((i, f"http://h.example/{i}", data.page(f"<div class='x1'>{slogan}</div><div class='x2'><p>{body}</p></div>"), body))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract.extract_text(pages).collect()}
    assert got == {r[0]: " ".join(r[3].split()) for r in rows}


def main_texts(spark, rows):
    pages = spark.createDataFrame([(i, url, data.page(body)) for i, (url, body) in enumerate(rows)], "page_id bigint, url string, html string")
    return [r.text for r in extract.extract_text(pages).orderBy("page_id").collect()]


def some_prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def test_many_copies_of_an_article_cut_no_page(spark):
    rng = random.Random(8)
    copy, bodies = some_prose(rng, 400), [some_prose(rng, 60) for _ in range(60)]
    texts = [(f"copy {i}", copy) for i in range(30)] + [(f"title {i}", body) for i, body in enumerate(bodies)]
    marked = [("http://m.example/", f"<article><h1>{t}</h1><p>{b}</p></article>") for t, b in texts]
    plain = [("http://p.example/", f"<div class='t'>{t}</div><div class='x2'><p>{b}</p></div>") for t, b in texts]
    assert main_texts(spark, marked + plain) == [f"{t} {b}" for t, b in texts] * 2


def test_unique_blocks_of_a_mostly_repeated_zone_stay(spark):
    rng = random.Random(9)
    notes, rows, wanted = [some_prose(rng, 30) for _ in range(4)], [], []
    for _ in range(40):
        own = some_prose(rng, 12)
        rows.append(("http://z.example/", "".join(f"<div>{t}</div>" for t in [*notes[:2], own, *notes[2:]])))
        wanted.append(own)
    assert main_texts(spark, rows) == wanted


def test_small_hosts_are_judged_by_themselves(spark):
    rng = random.Random(10)
    other = [("http://other.example/", f"<div>{some_prose(rng, 90)}</div>") for _ in range(60)]
    repeats = [("http://repeats.example/", f"<section>{data.PROSE * 3}</section><p>{some_prose(rng, 20)}</p>") for _ in range(60)]
    for n in (5, 40):
        own = [some_prose(rng, 30) for _ in range(n)]
        slogan = [("http://small.example/", f"<div>now in every shop</div><div>{t}</div>") for t in own]
        section = [("http://section.example/", f"<section>{t}</section>") for t in own]
        got = main_texts(spark, slogan + section + other + repeats)
        assert got[:2 * n] == own * 2


@pytest.mark.parametrize("html,text", [
    ("<header>Top</header><main><h1>A</h1>b</main><aside>side</aside>", "A b"),
    ("<div class='cookie-notice'>We use</div><p>x &lt;b&gt; &eacute;&nbsp;y", "x <b> é y"),
    ("<form><p>Name</p></form><ul class='menu'><li>m</ul><p>wo<b>rd</b> one</p><p>two", "word one two"),
    ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article><article class='comment'>c</article>", "T b"),
    ("<article><p class='share-bar'>s</p><p>b</p></article><section id='comments'><p>c</p></section>", "b"),
    ("<p>1 < 2 and <a href='x>y'>link</a> <!-- no <p>no</p> --> end", "1 < 2 and link end"),
    ("<td>a<td>b<tr><td>c", "a b c"), ("<p>t<script>no", "t"), ("<p>cut <div class=\"a", "cut"),
])
def test_blocks(html, text):
    assert " ".join(b.text for b in extract.main_blocks(extract.read_blocks(html))) == re.sub(r"\s+", " ", text)


# --- fingerprints in general --------------------------------------------------------------------


@pytest.mark.parametrize("least", [0.5, 0.8, 0.9])
def test_near_sets_equal_all_pairs(spark, least):
    rng = random.Random(int(least * 10))
    base = [[f"{rng.getrandbits(40):010x}" for _ in range(rng.randint(1, 40))] for _ in range(6)]
    rows = [(1000, []), (1001, [])]
    for i in range(70):
        own = rng.choice(base)
        kept = [s for s in own if rng.random() > rng.choice([0, 0.05, 0.2])]
        rows.append((i, sorted(set(kept + [f"{rng.getrandbits(40):010x}" for _ in range(rng.choice([0, 0, 1, 3]))]))))
    rows.append((70, rows[5][1]))
    classes = stored(spotsigs.set_classes(spark.createDataFrame(rows, "id bigint, sigs array<string>")), "classes")
    by_class = {r["class"]: frozenset(r.sigs) for r in classes.collect()}
    got = [(r.a, r.b, r.likeness) for r in spotsigs.near_sets(classes, least).collect()]
    found = {frozenset((a, b)): like for a, b, like in got}
    assert len(found) == len(got)
    wanted = {}
    for a, b in itertools.combinations(by_class, 2):
        x, y = by_class[a], by_class[b]
        if x and y and len(x & y) >= least * len(x | y):
            wanted[frozenset((a, b))] = len(x & y) / len(x | y)
    assert found == pytest.approx(wanted) and len(wanted) > 5


def test_lengths_beyond_a_class_never_meet(spark):
    sets = [(k, [f"{i:04d}" for i in range(n)]) for k, n in enumerate((1, 5, 10, 20, 40, 80))]
    classes = stored(spotsigs.set_classes(spark.createDataFrame(sets, "id bigint, sigs array<string>")), "classes")
    assert spotsigs.near_sets(classes, 0.8).collect() == []


def test_many_rows_without_an_id_are_ordered_in_parts(spark):
    docs = spark.createDataFrame([(None, f"text {i % 90}") for i in range(200)] + [(5, "five"), (9, None)], "doc_id bigint, text string")
    got = spotsigs.with_next(docs).collect()
    assert len(got) == 202
    after = collections.Counter((r.doc_id, r.text, r.next_text) for r in got)
    assert after[(9, "", "five")] == 1 and sum(n for (i, t, x), n in after.items() if i is None and x == "") == 1
    # Every text is followed by itself as often as it repeats but once, and then by the one of the next hash.
    assert sorted(collections.Counter(r.next_text for r in got).items()) == sorted(collections.Counter(r.text for r in got).items())
    parts = {r.part for r in spotsigs.in_ranges(docs).where("doc_id IS NULL").collect()}
    assert len(parts) > 1


# --- shards ---------------------------------------------------------------------------------------


def _cells(spark, rows):
    return spark.createDataFrame(rows, "group binary, shard int, n bigint")


def test_propagation_ends_where_nothing_moves(spark):
    rng = random.Random(4)
    rows = [(bytes([g]), s, rng.randint(1, 30)) for g in range(12) for s in rng.sample(range(8), rng.randint(2, 8))]
    totals = [sum(n for _, s, n in rows if s == k) for k in range(8)]
    quotas = [-(-sum(totals) // 8)] * 8
    squares = []
    for rounds in range(1, 40):
        cells = sharding.propagate(_cells(spark, rows), quotas, rounds).collect()
        assert sum(r.n for r in cells) == sum(n for *_, n in rows)
        squares.append(sum(r.n ** 2 for r in cells))
        if len(squares) > 1 and squares[-1] == squares[-2]:
            break
    assert all(a < b for a, b in zip(squares, squares[1:-1]))
    whole = sharding.propagate(_cells(spark, rows), quotas).collect()
    assert sum(r.n ** 2 for r in whole) == squares[-1]


def test_shard_tables_are_in_few_files(spark):
    """Few rows in a file for each shuffle partition cost more forks, tasks and seconds than the rows do."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, f"text {i % 40}") for i in range(200)]
        cells = sharding.propagate(_cells(spark, [(bytes([g]), s, 3) for g in range(60) for s in range(4)]), [180] * 4)
        assert len(cells.inputFiles()) == 1
        got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert len(set(got.inputFiles())) == 1
        assert sorted(r.doc_id for r in got.collect()) == list(range(200))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert common.files_for(0) == 1
    assert common.files_for(10**9) > 10_000


def test_shards_of_many_partitions_are_written_in_few_files(spark, tmp_path):
    """Neither the partitions of the input nor those of a shuffle are files of the rows or of the result."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, f"text {i % 40 if i < 100 else i}") for i in range(200)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(20)
        got = sharding.shard_documents(docs)
        assert len(set(got.inputFiles())) <= 2  # the rows and their places
        got.write.parquet(f"{tmp_path}/out")
        assert len(spark.read.parquet(f"{tmp_path}/out").inputFiles()) == 1
        assert sorted(r.doc_id for r in got.collect()) == list(range(200))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _cut(shards_of_groups):
    """Pairs of equal documents in different shards."""
    out = 0
    for shards in shards_of_groups:
        n = len(shards)
        out += (n * n - sum(k * k for k in collections.Counter(shards).values())) // 2
    return out


def test_cut_against_the_best_and_the_random_one(spark):
    """Groups that fit: the best assignment of all cuts nothing, one by hash cuts most pairs."""
    rng = random.Random(6)
    sizes = [3, 3, 2, 2, 2, 4, 4, 4]
    rows, i = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            rows.append((i, f"text {g}"))
            i += 1
    shards = 3
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), shards).collect()
    by_group = collections.defaultdict(list)
    for r in got:
        by_group[r.text_crc32].append(r.shard)
    best = min(_cut([[s] * n for s, n in zip(placed, sizes)]) + 10**6 * any(
        abs(sum(n for s, n in zip(placed, sizes) if s == k) - 8) > 0 for k in range(shards))
        for placed in itertools.product(range(shards), repeat=len(sizes)))
    assert best == 0
    by_hash = _cut([[rng.randrange(shards) for _ in range(n)] for n in sizes])
    assert _cut(by_group.values()) <= by_hash / 2
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1


# --- benchmark windows of any number --------------------------------------------------------------


def _plain_hits(docs, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    out = []
    for name, text in docs:
        words, hit, found = cut(text), set(), set()
        for item, wanted in items:
            w = cut(wanted)
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if w else 0):
                for at in range(len(words) - size + 1):
                    if words[at:at + size] == w[k:k + size]:
                        hit.update(range(at, at + size))
                        found.add(str(item))
        out.append((name, len(words), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("limit", [-1, 64 << 20])
def test_windows_of_all_lengths_by_both_ways(spark, monkeypatch, limit):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 9, 10, 11, 14]))) for i in range(25)]
    docs = [(i, text(rng.choice([0, 1, 5, 40])) + " " + rng.choice(items)[1] + " " + text(6)) for i in range(40)] + [(3, "again"), (3, "again")]
    for filter_bytes in (256 << 20, 0):
        monkeypatch.setattr(decontaminate, "FILTER_BYTES", filter_bytes)
        got = decontaminate.decontaminate(
            spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), limit=limit)
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()) == _plain_hits(docs, items)


def test_the_shuffled_rows_are_narrow(spark):
    """No words, no row for each document under one key, no item ids, however many items share a window."""
    passage = "one two three four five six seven eight nine ten"
    docs = spark.range(10000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 50, passage).otherwise(
        F.concat(F.lit("some other text with number "), F.col("id"))).alias("text"))
    items = spark.range(1000).select(F.col("id").alias("item_id"), F.lit(passage).alias("text"))
    windows = stored(decontaminate.item_windows(items), "windows")
    assert windows.count() == 1
    found = stored(decontaminate.prefixed_windows(docs, windows.select("window", F.lit(0).cast("bigint").alias("owners")), -1), "found")
    hits = decontaminate._by_shuffle(docs, found)
    assert dict(hits.dtypes) == {"doc_id": "bigint", "key": "bigint", "start": "int", "end": "int", "owners": "bigint", "is_end": "boolean"}
    plan = hits._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "tag" in line
    assert hits.where("NOT is_end").count() == 50 and hits.where("is_end").count() == 10000
    got = decontaminate.decontaminate(docs, items, limit=-1)
    assert got.where("contaminated").select("n_items").distinct().collect() == [(1000,)]
    assert got.count() == 10000 and got.where("contaminated").count() == 50
