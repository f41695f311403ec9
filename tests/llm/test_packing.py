"""Packing: exact partition of all ids, little padding, no window above its size."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinderlake.llm.packing import TIERS, WordTokenizer, pack, plan_windows, word_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = WordTokenizer(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbS's <|>endoftx\n\té1Σİ. 　́＇!²½"), max_size=6))
def test_ids_are_the_librarys(texts):
    ids, counts = OWN([t.encode() for t in texts])
    want = [library_ids(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_every_character():
    texts = [f"a{chr(c)}B {chr(c)}1 {chr(c)}'s '{chr(c)}" for c in range(0x3000)]
    ids, counts = OWN([t.encode() for t in texts])
    want = [library_ids(t) for t in texts]
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [t for t, g, w in zip(texts, parts, want, strict=True) if g.tolist() != w] == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40), st.booleans())
def test_windows_hold_every_token_once(lengths, last):
    windows, left = plan_windows(lengths, (4, 8, 16), last)
    assert not (last and left)
    covered = defaultdict(list)
    for size, window in windows:
        assert sum(n for _, _, n in window) == size and size & (size - 1) == 0 and size <= 16
        for doc, start, n in window:
            covered[doc].append((start, n))
    for doc, start, n in left:
        covered[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(covered[doc]):
            assert start == at and size > 0
            at += size
        assert at == n


def test_documents(spark):
    texts = ["", None, "one", "Hello there, you. " * 3000, "x " * 4096, "<|endoftext|> A", "a b c"]
    rows = [(i % 5, t, "clash") for i, t in enumerate(texts * 3)] + [(None, "no id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tier string").repartition(3)
    got = pack(docs, word_tokenizer(PATH)).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= TIERS[-1] and at & (at - 1) == 0
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(np.array([*library_ids(t or ""), 2], "<u4"))
    pieces = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got]
    for doc_id, docs_ids in want.items():
        assert sum(p[2] for p in pieces if p[0] == doc_id) == sum(map(len, docs_ids))
    for doc_id, start, n, crc, total in pieces:
        assert any(
            len(d) == total and zlib.crc32(d[start : start + n].tobytes()) == crc
            for d in want[doc_id]
        )
    assert pack(docs.limit(0), word_tokenizer(PATH)).count() == 0


def test_small_partitions_leave_few_fragments_and_even_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pack(docs.repartition(400), word_tokenizer(PATH)).toPandas()
    windows = got.groupby("sequence_id").agg(
        tokens=("length", "sum"), tier=("tier", "first"), group=("step_group", "first"),
        groups=("step_group", "nunique"),
    )
    assert (windows.tokens == windows.tier).all() and (windows.groups == 1).all()
    total = windows.tokens.sum()
    assert windows.tokens[windows.tokens < 512].sum() < 0.01 * total
    sizes = windows.groupby("group").tokens.sum().sort_index()
    assert sizes.index.tolist() == list(range(len(sizes)))
    assert (abs(sizes[:-1] / 65536 - 1) < 0.1).all()
    whole = pack(docs.coalesce(1), word_tokenizer(PATH)).toPandas()
    assert whole.length.sum() == total
    pieces = got.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert all((g.start.to_numpy()[1:] == (g.start + g.length).to_numpy()[:-1]).all() for _, g in pieces)
