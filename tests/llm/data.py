"""Tables for the tests: driver tables as pandas, and small ones written as Parquet folders."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])

PROSE = (
    "the little house stood on a hill of green grass and the river was far from it so that the "
    "children went to the water with a cart by the old road in the morning and came home at night "
)
ITEM = "seven silver swans swam silently seaward seeking some shallow sandy shore"


def texts() -> list[str | None]:
    """Nulls, empty and blank texts, ties, copies, near copies, passages, data and a very long text."""
    words = PROSE.split()
    near = [*words[:20], "stone", *words[21:]]
    return [
        None, "", "   \n\t ", "12345 !!", PROSE, PROSE, " ".join(near * 1), PROSE.upper(), "der die das und ich gehe nach hause",
        f"{PROSE} {ITEM} {PROSE}", ITEM.upper().replace(" ", "--"), "a", "a  b   c  ", "tail blank ",
        "mail me at someone.7@mail.example.com or +1 (724) 555-7058 or 4111 1111 1111 1111 from 10.1.2.3",
        "\U0001F600 café x@y.zz éé 192.168.0.1 999.1.1.1", "x" * 300, "zz " * 40, "unique words only here",
        " ".join(f"{PROSE}{i}" for i in range(700)), "nul \x00 in text", "an added token <|endoftext|> in text",
    ]


def documents(extra_columns: bool = False) -> pa.Table:
    """Rows of :func:`texts`, a row repeated whole, one id on two texts, and a null id."""
    rows = [(i * 3, t) for i, t in enumerate(texts())]
    rows += [rows[4], (rows[8][0], "another text with an id that is taken already"), (None, "a text without an id of its own")]
    names = ["en", "de", None]
    table = pa.table(
        {"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": [names[i % 3] for i in range(len(rows))],
         "source": [f"s{i % 2}" for i in range(len(rows))], "n_chars": [len(r[1] or "") for r in rows]}, schema=DOCUMENTS)
    if extra_columns:
        for name in ("n", "key", "class", "score", "_id", "_key", "_pii", "_language", "pos", "token", "length", "prefix", "kind"):
            table = table.append_column(name, pa.array([f"{name}{i}" for i in range(len(rows))]))
    return table


def benchmark() -> pa.Table:
    return pa.table({"item_id": [1, 2, 3, 4, 2], "text": [ITEM, "unique words", None, "", "unique words"]}, schema=ITEMS)


def labels() -> pa.Table:
    """Labels with nulls, an id without a document, two labels of one id, and values that are no label."""
    rows = [(i * 3, i % 2, 1 if i in (6, 9) else 0) for i in range(18)]
    rows += [(None, 0, 1), (27, 1, 0), (999, 0, 1), (54, None, None), (57, 0, 7)]
    return pa.table({"doc_id": [r[0] for r in rows], "quality": [r[1] for r in rows], "toxic": [r[2] for r in rows]}, schema=LABELS)


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def pages(extra_columns: bool = False) -> pa.Table:
    article = "<article><h1>Title</h1><p>One <b>bold</b> &amp; plain<br>line.</p><p>Two\n two.</p></article>"
    rows = [
        (1, "https://a.example.org/es/1", page(f"<nav><a>Menu</a></nav>{article}<footer>Foot</footer>")),
        (2, "HTTP://Sub.Example.ORG/en/17?x=1#y", page(f"<div class='ad'>Buy</div>{article}<div id=comments><p>Nice</p></div>")),
        (3, None, None), (4, "no scheme", ""), (5, "https://x.com", "plain text only"),
        (6, "http://x.com/de/5", "<p>cut in the mid"), (7, "http://x.com/fr/5", "<p>a<p>b<div class='x"),
        (1, "https://a.example.org/es/1", page(f"<nav><a>Menu</a></nav>{article}<footer>Foot</footer>")),
        (None, "http://x.net/de/9#t", page("<main><p>in main</p></main><p>outside</p>")),
        (8, "http://y.net/en/8/", page("<script>if (a < b) { '<p>no</p>' }</script><!-- <p>no</p> --><p title='a>b'>yes</p>")),
    ]
    table = pa.table({"page_id": [r[0] for r in rows], "url": [r[1] for r in rows], "html": [r[2] for r in rows]}, schema=PAGES)
    if extra_columns:
        for name in ("host", "path", "zones", "_host", "shape", "template", "rule"):
            table = table.append_column(name, pa.array([f"{name}{i}" for i in range(len(rows))]))
    return table


def write(folder: str, **tables: pa.Table) -> str:
    for name, table in tables.items():
        pq.write_table(table, os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def read(folder: str, name: str):
    return pq.read_table(os.path.join(folder, f"{name}.parquet")).to_pandas()
