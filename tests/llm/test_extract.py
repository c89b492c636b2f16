"""Main text: what the markup names, and runs that repeat on a host."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest

from jobtide.llm import extract
from llm import data


def marked_text(body):
    return " ".join(b.text for b in extract.main_blocks(extract.read_blocks(data.page(body))))


LONG = "<p>" + "plain words of the page " * 20 + "</p>"
SHORT = " ".join(("plain words of the page " * 20).split())


@pytest.mark.parametrize("body,text", [
    (f"<main><h1>Title</h1>{LONG}<article><p>a teaser</p></article></main>", f"Title {SHORT} a teaser"),
    (f"<main><div class='crumbs'>x</div><article><h1>T</h1>{LONG}</article></main>", f"T {SHORT}"),
    ("<article><div class='entry-header'><h1>Title</h1></div><p>b</p></article>", "Title b"),
    ("<article class='social-history'><h1>T</h1><p>b</p></article>", "T b"),
    ("<article><p class='share-price'>up</p><p class='share-bar'>s</p><p>b</p></article>", "up b"),
    ("<article><section id='discussion'><p>b</p></section><div class='comments'>c</div></article>", "b"),
    ("<form id='aspnet'><nav>m</nav><div><p>all of it</p></div><footer>f</footer></form>", "all of it"),
    ("<form><p>Name</p></form><p>text</p>", "text"),
    ("<p>a</p></div></p></section><p>b</p>", "a b"),
    ("<svg><text>no</svg><p title=\"a>b\">yes</p><p class='un closed>left</p>", "yes left"),
])
def test_what_the_markup_names(body, text):
    assert marked_text(body) == text


@pytest.mark.parametrize("html", [
    '<a b="x ' * 250_000, "<div>" * 200_000 + "</p>" * 200_000, "<a " * 500_000 + '">"', '<a "" ' * 300_000 + '">"',
    "<" * 1_000_000, "<!--" * 300_000, "</" * 500_000, "<p>" * 300_000, "&" * 1_000_000,
])
def test_broken_pages_take_linear_time(html):
    started = time.perf_counter()
    extract.read_blocks(html)
    assert time.perf_counter() - started < 6


def test_kept_suffixes_hit_every_long_run():
    rng = np.random.default_rng(5)
    run = rng.integers(0, 1 << 60, extract.SPREAD)
    for _ in range(200):
        before, after = rng.integers(0, 1 << 60, rng.integers(0, 90)), rng.integers(0, 1 << 60, rng.integers(0, 90))
        kept = extract.kept_suffixes(np.concatenate([before, run, after]), [])
        assert (len(before) + run.argmin()) in kept.tolist()
    assert extract.kept_suffixes(np.zeros(0, np.int64), [0]).tolist() == []


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]


def texts_of(spark, rows):
    pages = spark.createDataFrame([(i, f"http://{host}/{i}", data.page(body)) for i, (host, body) in enumerate(rows)], "page_id bigint, url string, html string")
    return [r.text for r in extract.extract_text(pages).orderBy("page_id").collect()]


@pytest.mark.parametrize("frame", ["<div><p>{}</p></div>", "<article><p>{}</p></article>"])
def test_a_sentence_that_all_pages_begin_with(spark, frame):
    rng = random.Random(3)
    sentence, own = " ".join(words(rng, 18)), [" ".join(words(rng, 60)) for _ in range(30)]
    rows = [("h.example", frame.format(f"{sentence} {t}")) for t in own] + [("two.example", frame.format(f"{sentence} {t}")) for t in own[:2]]
    assert texts_of(spark, rows) == own + [f"{sentence} {t}" for t in own[:2]]


def plainly(pages, covered):
    """Words of (host, words) pages left by an exact comparison of all suffixes."""
    bodies, seen = defaultdict(set), defaultdict(set)
    for host, text in pages:
        bodies[host].add(tuple(text))
        for k in range(len(text) - extract.DEPTH + 1):
            seen[host, tuple(text[k:k + extract.DEPTH])].add(tuple(text))
    out = []
    for host, text in pages:
        keep = [True] * len(text)
        for k in range(len(text) - extract.DEPTH + 1):
            n = len(seen[host, tuple(text[k:k + extract.DEPTH])])
            if n >= extract.MIN_PAGES and n >= covered * len(bodies[host]):
                keep[k:k + extract.DEPTH] = [False] * extract.DEPTH
        out.append(" ".join(w for w, k in zip(text, keep) if k) if 2 * sum(keep) >= len(text) else " ".join(text))
    return out


def test_runs_equal_a_comparison_of_all_suffixes(spark):
    """Long runs anywhere in the text, on all, most, half and few pages of hosts of several sizes; copied articles."""
    rng = random.Random(17)
    pages = []
    for host, size in (("a.example", 3), ("b.example", 8), ("c.example", 25), ("d.example", 1)):
        runs = [(words(rng, rng.randint(extract.SPREAD + extract.DEPTH - 1, 90)), share) for share in (1, 0.8, 0.5, 0.3)]
        copied = words(rng, 120)
        for k in range(size):
            text = words(rng, rng.randint(0, 60)) if k % 4 else copied + words(rng, 3)
            for run, share in rng.sample(runs, len(runs)) if k % 4 else ():
                text += (run if k < share * size else []) + words(rng, rng.randint(10, 90))
            pages.append((host, text))
        pages.append(pages[-1])
    got = texts_of(spark, [(host, f"<article><p>{' '.join(text)}</p></article>") for host, text in pages])
    wanted = plainly(pages, extract.COVERED)
    assert got == wanted and sum(len(a.split()) < len(t) for a, (_, t) in zip(wanted, pages)) > 10


def test_short_runs_inside_long_texts(spark):
    """Runs of a few words more than a suffix, far from block starts and from each other's places; copies of pages beside them."""
    rng = random.Random(23)
    pages = []
    for host, size in (("a.example", 3), ("b.example", 7), ("c.example", 40)):
        runs = [(words(rng, rng.randint(extract.DEPTH, 14)), share) for share in (1, 0.7, 0.5, 0.4)]
        for k in range(size):
            text = words(rng, rng.randint(20, 60))
            for run, share in rng.sample(runs, len(runs)):
                text += (run if k < share * size else []) + words(rng, rng.randint(60, 90))
            pages += [(host, text)] * (1 + 5 * (k == size - 1))
    rng.shuffle(pages)
    got = texts_of(spark, [(host, f"<article><p>{' '.join(text)}</p></article>") for host, text in pages])
    wanted = plainly(pages, extract.COVERED)
    assert got == wanted and sum(len(a.split()) < len(t) for a, (_, t) in zip(wanted, pages)) > 40


def test_a_block_has_a_key_for_each_of_its_runs():
    rng = random.Random(29)
    own = words(rng, 30)
    shared = extract.block_keys(" ".join(words(rng, 40) + own + words(rng, 40)))
    keys = extract.block_keys(" ".join(own))
    assert len(keys) == 1 + len(own) - extract.DEPTH + 1 and set(keys[1:]) <= set(shared)
    assert len(extract.block_keys("a short block")) == 1


def test_likely_suffixes_of_pages_whose_copies_were_cut(spark, monkeypatch):
    """Every run of half the bodies is named, however few pages a task holds at once; pages of a body may differ."""
    monkeypatch.setattr(extract, "HELD", 100)
    rng = random.Random(31)
    run, other = words(rng, 12), words(rng, 12)
    rows = [(k, 1, k, [" ".join(words(rng, 30) + (run if k % 2 else []) + words(rng, 30))]) for k in range(20)]
    rows += [(100 + k, 1, 0, [" ".join(words(rng, 20) + other)]) for k in range(9)]
    pages = spark.createDataFrame(rows, "id bigint, host bigint, body bigint, texts array<string>").repartition(4)
    named = {(r.host, r.key) for r in extract.likely_suffixes(pages).collect()}
    for part in (run, other):
        keys = extract.window_hashes(extract.word_hashes([" ".join(part)])[0], extract.DEPTH).view(np.int64)
        assert {(1, int(k)) for k in keys} <= named


def test_deep_pages_have_zones_of_one_size():
    blocks = extract.read_blocks("<div class='c'>" * 3000 + "deep")
    assert blocks[0].text == "deep" and -(1 << 63) <= blocks[0].zone < 1 << 63
