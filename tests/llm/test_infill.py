"""Fill-in-the-middle against plain slicing, and exact round trips."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobtide.llm import infill
from jobtide.llm.common import table
from jobtide.llm.queries import QUERIES
from llm import data

TEXTS = st.text(alphabet=st.sampled_from(list("abZ09 \n<>PSM/é中\U0001F600\x00")), max_size=60)


def plain(text, doc_id):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 10**6))
def test_transform_equals_slicing_and_is_undone(text, doc_id):
    got = infill.transform(text, doc_id)
    assert got == plain(text, doc_id)
    assert infill.restore_text(got[4], got[1]) == text


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_rotation_exchanges_blocks_in_place(raw, draw):
    cuts = sorted(draw.draw(st.integers(0, len(raw))) for _ in range(3))
    buffer = bytearray(raw)
    infill.rotate(buffer, *cuts)
    a, b, c = cuts
    assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


@pytest.mark.parametrize("text", ["<", "<S", "a<P", "P><S", "<<M", "M>", "x<S>y"])
def test_parts_of_marks_are_no_marks(text):
    for doc_id in range(60):
        n, form, *_, output = infill.transform(text, doc_id)
        assert infill.restore_text(output, form) == text
        assert form == "plain" if "<S>" in text else True


def test_every_form_occurs_as_often_as_asked():
    forms = [infill.transform("some text of words", i)[1] for i in range(2000)]
    assert 0.08 < forms.count("plain") / 2000 < 0.12
    assert 0.15 < forms.count("spm") / 1800 < 0.25
    assert {infill.transform("some text", i, transformed=100, suffix_first=100)[1] for i in range(50)} == {"spm"}
    assert {infill.transform("some text", i, transformed=0)[1] for i in range(50)} == {"plain"}


def test_columns_are_kept(spark, odd):
    docs = table(spark, odd, "documents")
    cut = infill.fill_in_middle(docs, into="made")
    assert cut.columns == [*docs.columns, "made"]


def test_long_text():
    text = "word, é " * 500_000
    got = infill.transform(text, 3)
    assert infill.restore_text(got[4], got[1]) == text and got[0] == len(re.findall("[A-Za-z]+|[^A-Za-z]", text))


@pytest.mark.parametrize("folder", ["small", "odd"])
def test_op13_equals_plain(spark, folder, request):
    folder = data.SMALL if folder == "small" else request.getfixturevalue("odd")
    docs = data.read(folder, "documents")
    wanted = []
    for i, t in zip(docs.doc_id, docs.text):
        i = None if i != i else int(i)
        *row, output = plain(t, i)
        wanted.append((i, *row, *(hashlib.sha256(x.encode()).hexdigest() for x in (output, t or ""))))
    got = [tuple(r) for r in QUERIES["op13_infill"](spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
