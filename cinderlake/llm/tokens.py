"""Token counts of a byte-level pair-merge vocabulary by rank-synchronous array merging.

Texts are split into pre-tokens by the vocabulary's pattern. Pre-tokens not met before are held as
one ragged numpy array of symbols; in each round every sequence merges its lowest-rank
pair, wherever it occurs, all sequences at once, until no pair has a rank. The symbols
that survive are the tokens. Counts of pre-tokens are remembered within a task.

Defined results: a NULL text counts as empty (0 bytes, 0 tokens); the vocabulary's special strings inside
a text count as one token each; a NULL doc_id stays NULL; repeated rows give repeated rows; an
empty table gives an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cinderlake.llm.common import blocks_of, byte_letters, text_bytes

#: Fixed value: the pattern that splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NO_RANK = np.iinfo(np.int32).max
_REMEMBERED = 500_000
_PIECES_AT_ONCE = 500_000


class ArrayMerger:
    """Counts the symbols that are left of byte sequences when all merges are done."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self._byte_ids = np.array([vocabulary[c] for c in byte_letters()], np.int64)
        made = {}
        for rank, (a, b) in enumerate(merges):
            # Merging all places of a rank at once is right if no merge makes a lower rank.
            if max(made.get(a, -1), made.get(b, -1)) >= rank or a + b in made:
                raise ValueError("a merge comes before one of its parts or makes a known token")
            made[a + b] = rank
        self._shift = max(vocabulary.values()).bit_length()
        keys = np.array([(vocabulary[a] << self._shift) | vocabulary[b] for a, b in merges])
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self._merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << self._shift) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NO_RANK)

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each sequence. Sequences may be empty."""
        lengths = np.array([len(s) for s in sequences], np.int64)
        result = lengths.copy()
        symbols = self._byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        if not len(symbols):
            return result
        ranks = np.full(len(symbols), _NO_RANK, np.int32)
        ranks[:-1] = np.where(
            owner[1:] == owner[:-1], self._rank(symbols[:-1], symbols[1:]), _NO_RANK
        )
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest != _NO_RANK
            result[owner[starts]] = sizes
            if not going.all():
                stay = np.repeat(going, sizes)
                symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
                lowest, sizes = lowest[going], sizes[going]
                if not len(symbols):
                    break
            chosen = ranks == np.repeat(lowest, sizes)
            # Of overlapping places (a, a, a) the first, third, ... merge.
            place = np.flatnonzero(chosen)
            opens = np.concatenate([[True], np.diff(place) > 1])
            run_start = place[opens][np.cumsum(opens) - 1]
            place = place[(place - run_start) % 2 == 0]
            symbols[place] = self._merged[ranks[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            now = (np.cumsum(keep) - 1)[place]
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            # Only the pairs beside a merged symbol have changed.
            stale = np.unique(np.concatenate([now, now[now > 0] - 1]))
            ranks[stale] = _NO_RANK
            inner = stale[stale < len(symbols) - 1]
            inner = inner[owner[inner] == owner[inner + 1]]
            ranks[inner] = self._rank(symbols[inner], symbols[inner + 1])
        return result


class TokenCounter:
    """Tokens per text for a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._merger = ArrayMerger(model["vocab"], merges)
        self._pattern = regex.compile(PATTERN)
        special = [t["content"] for t in described["added_tokens"]]
        special.sort(key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._known: dict[str, int] = {}

    def _learn(self, pieces: set[str]) -> None:
        new = sorted(pieces.difference(self._known))
        if len(self._known) + len(new) > _REMEMBERED:
            self._known.clear()
            new = sorted(pieces)
        if new:
            counts = self._merger.count([p.encode() for p in new])
            self._known.update(zip(new, counts.tolist(), strict=True))

    def _total(self, pieces: list[str]) -> int:
        return sum(map(self._known.__getitem__, pieces))

    def count(self, texts: list[str]) -> list[int]:
        parts = [self._special.split(t) if self._special else [t] for t in texts]
        totals = [len(p) - 1 for p in parts]
        held: list[tuple[int, list[str]]] = []

        def settle() -> None:
            self._learn(set().union(*(pieces for _, pieces in held)))
            for i, pieces in held:
                totals[i] += self._total(pieces)
            held.clear()

        waiting = 0
        for i, own in enumerate(parts):
            for part in own:
                if len(part) <= _PIECES_AT_ONCE:
                    held.append((i, self._pattern.findall(part)))
                    waiting += len(held[-1][1])
                else:
                    found = (m.group() for m in self._pattern.finditer(part))
                    while pieces := list(islice(found, _PIECES_AT_ONCE)):
                        held.append((i, pieces))
                        settle()
                if waiting > _PIECES_AT_ONCE:
                    settle()
                    waiting = 0
        settle()
        return totals


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every row; ``path`` is the vocabulary file."""

    def run(batches):
        counter = TokenCounter(path)
        for block in blocks_of(batches, lambda r: len(r[1]), "doc_id", "text"):
            counts = counter.count([t.decode() for _, t in block])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in block], pa.int64()),
                    pa.array([len(t) for _, t in block], pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                schema=_SCHEMA,
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
