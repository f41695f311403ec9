"""Exact deduplication against plain grouping."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cinderlake.llm.dedup import LONGEST, cuts, exact_groups


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[text or ""]
        known = [i for i in own if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(own), doc_id == keep, sha))
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(0, 80))
def test_chunks_cover_the_text_and_follow_its_content(piece, times):
    text = piece * times
    ends = cuts(text)
    starts = [0, *ends[:-1]]
    assert ends[-1] == len(text)
    assert all(0 < e - s <= LONGEST or not text for s, e in zip(starts, ends, strict=True))


def test_a_longer_text_is_cut_in_the_same_places():
    data = random.Random(0).randbytes(300_000)
    ends = set(cuts(data))
    moved = {e - 1000 for e in cuts(bytes(1000) + data)}
    assert len(ends) > 40 and len(ends & moved) > 0.9 * len(ends)


@pytest.mark.parametrize("key_bytes", [16, 1])
def test_groups(spark, key_bytes):
    rng = random.Random(4)
    texts = ["", None, "a", "A", "a ", "é"] + [
        "".join(rng.choices("abcdef gh", k=rng.choice([10, 3000, 9000]))) for _ in range(40)
    ]
    texts += [t[:-1] + "!" for t in texts[6:20]] + ["long " * 60_000]
    rows = [(i, rng.choice(texts)) for i in range(200)] + [(None, "a"), (None, "alone"), (5, "a")]
    rows.append(rows[0])
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, recipe int")
    got = exact_groups(docs.repartition(4), key_bytes).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_empty(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
