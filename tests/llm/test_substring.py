"""Removal of repeated passages against brute force; the FM-index against plain search."""

import numpy as np
import pytest

from cinderlake.llm import substring
from cinderlake.llm.fmindex import FMIndex, WaveletTree, nearest_smaller, suffix_order
from cinderlake.llm.substring import Words, merged, names, remove_repeats, search_shard

SCHEMA = "spans int, text string, row string, doc_id long"


def brute(rows, window=50):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1) if i is not None else ():
            at = tuple(w[k : k + window])
            first[at] = min(first.get(at, i), i)
    out = []
    for i, w in words:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), int(gone.sum()), kept.decode()))
    return sorted(out, key=str)


def run(spark, rows, parts=3, window=50):
    given = spark.createDataFrame([(1, t, "theirs", i) for i, t in rows], SCHEMA)
    found = remove_repeats(given.repartition(parts), window).collect()
    return sorted(
        ((r.doc_id, r.n_words, sum(s.last - s.first for s in r.spans), r.text) for r in found),
        key=str,
    )


def prose(rng, n, letters=400):
    return " ".join(f"w{k}" for k in rng.integers(0, letters, n))


def planted(rng, window=50, docs=60, letters=400):
    """Texts with passages of about the window's length, some in very many texts."""
    passages = [prose(rng, int(k), letters)
                for k in rng.integers(max(1, window - 2), 3 * window, 6)]
    rows = []
    for i in range(docs):
        parts = [prose(rng, int(rng.integers(0, 40)), letters)]
        for p in rng.choice(6, rng.integers(0, 4)):
            parts += [passages[p if rng.random() < 0.5 else 0], prose(rng, int(rng.integers(0, 9)), letters)]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("window", [50, 7, 1])
def test_against_brute_force(spark, window):
    rng = np.random.default_rng(window)
    rows = planted(rng, window, 40)
    rows += [(100, rows[3][1]), (2000, rows[3][1]), (-5, rows[7][1])]
    want = brute(rows, window)
    assert sum(r[2] for r in want) > 100 and run(spark, rows, window=window) == want


def test_few_different_words_and_long_runs(spark):
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, 120, 2)) for i in range(12)]
    rows += [(20 + i, "a " * int(k)) for i, k in enumerate((49, 50, 51, 3000, 700))]
    rows += [(40, "a b " * 900), (41, "b a " * 80)]
    assert run(spark, rows, window=10) == brute(rows, 10)
    assert run(spark, rows) == brute(rows)


def test_names_with_too_many_stretches(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = planted(rng, 50, 80)
    want = brute(rows)
    for size in (60, 600):  # words a name may have: all rounds are taken
        monkeypatch.setattr(substring, "NAME_WORDS", size)
        monkeypatch.setattr(substring, "SHARD_WORDS", 400)
        assert run(spark, rows, 9) == want
    monkeypatch.setattr(substring, "BROADCAST_ROWS", 0)
    assert run(spark, rows, 2) == want


def test_a_passage_that_most_documents_hold(spark, monkeypatch):
    monkeypatch.setattr(substring, "NAME_WORDS", 4_000)
    rng = np.random.default_rng(6)
    passage = prose(rng, 60)
    rows = [(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for i in range(400)]
    assert run(spark, rows, 8) == brute(rows)


def test_a_text_that_repeats_itself(spark, monkeypatch):
    rng = np.random.default_rng(11)
    passage = prose(rng, 70)
    rows = [(1, " ".join([passage] * 40)), (2, " ".join([passage] * 3)), (3, passage), (4, prose(rng, 90))]
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(substring, "NAME_WORDS", 60)
    assert run(spark, rows) == want


def test_nulls_repeats_spaces_and_empty_tables(spark):
    rng = np.random.default_rng(7)
    text = prose(rng, 80)
    odd = text.replace(" ", " \t\n\x0b\x0c\r ", 30)
    rows = [(3, text), (3, text), (3, text + " more"), (None, text), (1, None), (2, ""), (4, odd),
            (5, "  " + text.replace(" ", " ")), (6, "one"), (7, text.upper())]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, None)]) == [(1, 0, 0, "")] and run(spark, []) == []
    spans = remove_repeats(spark.createDataFrame([(1, text, "", 9), (1, text, "", 2)], SCHEMA))
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in spans.collect()} == {2: [], 9: [(0, 80)]}


def test_a_very_long_text(spark):
    rng = np.random.default_rng(8)
    long = prose(rng, 150_000, 5000)
    words = long.split()
    rows = [(1, long), (2, " ".join(words[70_000:70_090])), (3, " ".join(words[65_500:65_600])),
            (4, long[:-40])]
    assert run(spark, rows) == brute(rows)


def test_windows_with_the_same_words_have_the_same_name():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    for run_ in (1, 8, 24, 50):
        a = names(np.concatenate([rng.integers(0, 1 << 63, 20).astype(np.uint64), passage]), run_, 50)
        b = names(np.concatenate([passage, passage[:9]]), run_, 50)
        assert (a[20:] == b[:11]).all() and (run_ < 50 or len(set(a.tolist())) == len(a))
    assert len(names(passage[:49], 8, 50)) == 0


def test_hashes_do_not_depend_on_where_a_word_stands():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 100, int(k)).astype(np.uint8)) for k in rng.integers(1, 6, 50_000)]
    words[7] = b"x" * 200_000  # longer than what is looked at together
    found = Words(b" ".join(words)).hashes()
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(words, found.tolist(), strict=True))
    assert len(set(known.values())) == len(known)
    assert Words(words[7]).hashes()[0] == known[words[7]]


def test_words_of_a_text():
    text = b"\x0b a\tbc  d\x85e\r\nf"
    words = Words(text)
    assert words.joined(0, len(words)) == b"a bc d\x85e f" and len(Words(b"")) == 0
    assert merged([(5, 9), (1, 3), (3, 4), (6, 7)]) == [(1, 4), (5, 9)]


def test_index_against_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(150):
        letters, most = int(rng.integers(1, 5)), int(rng.integers(1, 9))
        pieces = [rng.integers(1, letters + 1, rng.integers(0, 15)) for _ in range(rng.integers(0, 6))]
        asked = [rng.integers(0, letters + 3, rng.integers(0, 20)) for _ in range(4)]
        held = {tuple(p[i:j]) for p in pieces for i in range(len(p))
                for j in range(i + 1, min(len(p), i + most) + 1)}
        for q, found in zip(asked, FMIndex(pieces, most).matching_statistics(asked)[0], strict=True):
            for i, length in enumerate(found.tolist()):
                longer = length + 1
                assert not length or tuple(q[i : i + length]) in held
                assert longer > min(most, len(q) - i) or tuple(q[i : i + longer]) not in held


def test_shard_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(150):
        window, texts = int(rng.integers(1, 9)), {}
        for k in range(int(rng.integers(1, 12))):
            words = b" ".join(b"w%d" % x for x in rng.integers(0, 3, window + int(rng.integers(0, 25))))
            least = int(rng.integers(0, 10))
            texts[words] = (7, b"%d" % k, words, least, least + int(rng.integers(0, 3)))
        first, want = {}, {}
        for at_all in (False, True):
            for _, digest, words, least, most in texts.values():
                w = words.split()
                for i in range(len(w) - window + 1):
                    at = tuple(w[i : i + window])
                    if not at_all:
                        first[at] = min(first.get(at, least), least)
                    elif first[at] < most:
                        want[digest, i] = first[at]
        got = {}
        for _, digest, a, b, origin in search_shard(list(texts.values()), window):
            got.update({(digest, i): origin for i in range(a, b)})
        assert got == want


def test_parts_of_the_index():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 37, 500)
    tree = WaveletTree(values, 6)
    symbol, at = rng.integers(0, 37, 200), rng.integers(0, 501, 200)
    base, found = tree.ranks(symbol, np.zeros(200, np.int64), at)
    assert (found - base == [(values[:a] == s).sum() for s, a in zip(symbol, at, strict=True)]).all()
    want = [max((j for j in range(k) if values[j] < values[k]), default=-1) for k in range(500)]
    assert nearest_smaller(values).tolist() == want
    order, shared = suffix_order(rng.integers(0, 2, 300), 8)
    assert sorted(order.tolist()) == list(range(300)) and shared.max() <= 8
