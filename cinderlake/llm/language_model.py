"""Scoring texts with an n-gram model held in Elias-Fano tries.

Documents are encoded once, in batches of 16 MB: each batch has its own list of words (by 64-bit
hash) and its tokens as places in that list. The model is spread over shards by the hash of the
context; a context with very many successors is spread over all shards. Level by level,
every batch sends each shard the n-grams it has, once each, with their training counts in
the batch. The shard adds the counts up, smooths them, stores 16-bit codes of log10
probabilities in a memory-mapped trie, and answers every batch from the trie. Then the batch goes on
to the next level with what it has learned, or adds up its documents. So neither
the model nor the corpus is ever in one place, a word or pair that is a third of all tokens
is one row per batch and shard, and what is shuffled is packed arrays, not rows.

Smoothing: words get (c - 0.75) / N, and all unknown words are one class with what is taken off. An
n-gram gets (c(h w) + m p(w | shorter h)) / (c(h) + m), which adds up to one over all words,
known or not, for every context h. The first token's context is the start of the text.

Defined results: a NULL or empty text is its end token; a NULL doc_id counts as the empty text in
its crc32; repeated rows are counted and scored each; an empty table gives an empty table; only
doc_id and text are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.common import Interner, blocks_of, text_bytes, words
from cinderlake.llm.eliasfano import NgramTrie
from cinderlake.workspace import materialize

ORDER = 2
STRENGTH = 64.0
DISCOUNT = 0.75
SHARD_TOKENS = 2_000_000
_BATCH_BYTES = 16 << 20
_LOWEST = -24.0
_STEP = -_LOWEST / 65535
_START, _END = 0, 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _word_key(word: bytes) -> int:
    return max(2, xxhash.xxh3_64_intdigest(word))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed piece, first bytes before second bytes and so on."""
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    planes = [
        np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        for a in arrays
    ]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(data, "<i8", len(types))
    at, out = 8 * len(types), []
    for size, kind in zip(sizes.tolist(), types, strict=True):
        planes = np.frombuffer(data, np.uint8, size, at).reshape(np.dtype(kind).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


def to_codes(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10, _LOWEST, 0) / -_STEP).astype(np.uint16)


def from_codes(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * -_STEP


def _encode(docs: DataFrame, held_out: Column) -> DataFrame:
    """batch, doc_ids, held, keys, corpus, tokens: texts as places in the batch's own word list.

    The list, ``keys``, is sorted. In ``corpus`` words are numbered by frequency, which packs well, beside
    the list that leads from there to the sorted one.
    """
    schema = pa.schema(
        [("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("held", pa.list_(pa.bool_())), ("keys", pa.binary()), ("corpus", pa.binary()),
         ("tokens", pa.int64())]
    )

    def run(batches):
        known = Interner(_word_key)
        batch = TaskContext.get().partitionId() << 33
        blocks = blocks_of(
            batches, lambda r: len(r[1]), "doc_id", "text", "held", most=_BATCH_BYTES
        )
        for block in blocks:
            keys, sizes = [], []
            for _, text, _ in block:
                found = words(text)
                keys.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
                keys.append(np.array([_END], np.uint64))
                sizes.append(len(found) + 1)
            vocabulary, tokens, seen = np.unique(
                np.concatenate([np.array([_START], np.uint64), *keys]),
                return_inverse=True,
                return_counts=True,
            )
            often = np.argsort(-seen, kind="stable").astype(np.int32)
            number = np.empty(len(often), np.int32)
            number[often] = np.arange(len(often))
            corpus = _pack(often, number[tokens[1:]], np.array(sizes, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch], pa.int64()),
                    pa.array([[i for i, _, _ in block]], pa.list_(pa.int64())),
                    pa.array([[h for _, _, h in block]], pa.list_(pa.bool_())),
                    pa.array([_pack(vocabulary)], pa.binary()),
                    pa.array([corpus], pa.binary()),
                    pa.array([sum(sizes)], pa.int64()),
                ],
                schema=schema,
            )
            batch += 1

    given = docs.select("doc_id", text_bytes(), held_out.alias("held"))
    return given.mapInArrow(
        run,
        "batch long, doc_ids array<long>, held array<boolean>, keys binary, corpus binary, "
        "tokens long",
    )


class _Batch:
    """One batch with the distinct n-grams of each length up to ``order``.

    Tokens stand between starts of text. ``grams[k]`` gives, for each token, which distinct
    n-gram of k + 1 words ends there, -1 where the text has not so many words yet.
    """

    def __init__(self, corpus: bytes, held: list[bool], order: int):
        often, tokens, self.sizes = _unpack(corpus, "<i4", "<i4", "<i4")
        docs = len(self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        # The start has the smallest key, so place 0.
        stream = np.insert(often[tokens], first, 0)
        self.doc = np.repeat(np.arange(docs), self.sizes + 1)
        self.scored = np.ones(len(stream), bool)
        self.scored[first + np.arange(docs)] = False
        self.trained = ~np.array(held, bool)[self.doc]
        self.grams, self.words = [stream.astype(np.int64)], [np.arange(len(often))[:, None]]
        self.context, self.suffix = [None], [None]
        for k in range(1, order):
            own, before = self.grams[0], np.append(-1, self.grams[k - 1][:-1])
            whole = self.scored & (before >= 0)
            if k > 1:  # a longer n-gram needs a shorter one that ends at this token too
                whole &= self.grams[k - 1] >= 0
            pair = before[whole] * len(often) + own[whole]
            distinct, place, inverse = np.unique(pair, return_index=True, return_inverse=True)
            gram = np.full(len(stream), -1)
            gram[whole] = inverse
            at = np.flatnonzero(whole)[place]
            self.grams.append(gram)
            self.context.append(before[at])
            self.suffix.append(self.grams[k - 1][at])
            self.words.append(
                np.column_stack([self.words[k - 1][before[at]], own[at]])
            )

    def counts(self, k: int) -> np.ndarray:
        """How often each distinct n-gram ends at a token of a training text."""
        used = self.trained & (self.grams[k] >= 0)
        return np.bincount(self.grams[k][used], minlength=len(self.words[k]))

    def shards(
        self, k: int, shards: int, ids: np.ndarray, context_counts: np.ndarray, total: int
    ) -> np.ndarray:
        """The shard of each distinct n-gram of more than one word; ``ids`` are the words' numbers."""
        keys = ids.astype(np.uint64)[self.words[k]]
        mixed = np.zeros(len(keys), np.uint64)
        for column in range(k):
            mixed = (mixed ^ (keys[:, column] + np.uint64(1))) * _FACTOR
        spread = context_counts * shards > total // 4
        mixed = np.where(spread, (mixed ^ (keys[:, k] + np.uint64(1))) * _FACTOR, mixed)
        return ((mixed >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def _word_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of words are ranges of their keys, which are hashes, so of even size."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


_REQUEST = "shard long, batch long, payload binary"
_ANSWER = "batch long, shard long, payload binary, tokens long, words long"


def _rows(columns: dict, kinds: str) -> pa.Table:
    types = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in kinds.split(", ")]
    return pa.table({n: pa.array(columns[n], types[t]) for n, t in fields})


def _answer_words(request: pa.Table) -> pa.Table:
    """Training counts of single words, and their places among all words of the shard.

    A batch asks in the order of keys, so places are sent as steps. The start of text is no word
    of the total.
    """
    batches = request.column("batch").to_pylist()
    asked = [_unpack(p, "<u8", "<i8") for p in request.column("payload").to_pylist()]
    keys, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, inverse, np.concatenate([a[1] for a in asked]))
    bounds = np.cumsum([len(a[0]) for a in asked])[:-1]
    answers = [
        (counts[place], np.diff(place, prepend=0)) for place in np.split(inverse, bounds)
    ]
    word = keys != _START
    return _rows(
        {
            "batch": batches,
            "shard": request.column("shard").to_pylist(),
            "payload": [_pack(*a) for a in answers],
            "tokens": [int(counts[word].sum())] + [0] * (len(batches) - 1),
            "words": [int((counts[word] > 0).sum())] + [0] * (len(batches) - 1),
        },
        _ANSWER,
    )


def _answer_grams(order: int, strength: float, last: bool):
    """For n-grams of ``order`` words: codes of smoothed probabilities, and counts."""
    kinds = ("<i8", *["<i4"] * order, "<i8", "<i8", "<u2")

    def answer(request: pa.Table) -> pa.Table:
        batches = request.column("batch").to_pylist()
        asked = [_unpack(p, *kinds) for p in request.column("payload").to_pylist()]
        asked = [(np.cumsum(a[0]), *a[1:]) for a in asked]
        keys = np.unique(np.concatenate([a[0] for a in asked]))
        grams = np.concatenate(
            [np.column_stack([np.searchsorted(keys, a[0][w]) for w in a[1 : order + 1]])
             for a in asked]
        )
        counts, contexts, lower = (
            np.concatenate([a[i] for a in asked]) for i in (order + 1, order + 2, order + 3)
        )
        # Rank the n-grams word by word, so that the rank follows their lexicographic order.
        rank = np.zeros(len(grams), np.int64)
        for k in range(order):
            rank = np.unique(rank * len(keys) + grams[:, k], return_inverse=True)[1]
        distinct, first = np.unique(rank, return_index=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, rank, counts)
        grams, contexts, lower = grams[first], contexts[first], lower[first]
        smoothed = strength * 10.0 ** from_codes(lower)
        stored = total > 0
        seen = np.log10((total[stored] + smoothed[stored]) / (contexts[stored] + strength))
        trie = NgramTrie(grams[stored], to_codes(seen), len(keys))
        # All batches' n-grams are looked up once each, in order.
        place = trie.find(grams)
        there = place >= 0
        codes = to_codes(np.log10(smoothed / (contexts + strength)))
        codes[there] = trie.codes(place[there])
        payloads, start = [], 0
        for a in asked:
            stop = start + len(a[1])
            own = rank[start:stop]
            # The counts are contexts of the next level; the last one needs none.
            payloads.append(_pack(codes[own], total[own] if not last else total[:0]))
            start = stop
        return _rows(
            {
                "batch": batches,
                "shard": request.column("shard").to_pylist(),
                "payload": payloads,
                "tokens": [0] * len(batches),
                "words": [0] * len(batches),
            },
            _ANSWER,
        )

    return answer


def _word_requests(encoded: DataFrame, shards: int) -> DataFrame:
    def run(batches):
        for table in batches:
            for row in table.to_pylist():
                own = _Batch(row["corpus"], row["held"], 1)
                (keys,) = _unpack(row["keys"], "<u8")
                shard, counts = _word_shards(keys, shards), own.counts(0)
                used = np.unique(shard)
                payloads = []
                for s in used:
                    of = shard == s
                    payloads.append(_pack(keys[of], counts[of].astype(np.int64)))
                columns = {
                    "shard": used, "batch": [row["batch"]] * len(used), "payload": payloads
                }
                yield from _rows(columns, _REQUEST).to_batches()

    return encoded.mapInArrow(run, _REQUEST)


def _read_answers(answers: pa.Table, shard: np.ndarray, *kinds: str) -> list[np.ndarray]:
    """What all shards said, in the order of the batch's distinct n-grams."""
    out = [np.zeros(len(shard), k) for k in kinds]
    for s, payload in zip(
        answers.column("shard").to_pylist(), answers.column("payload").to_pylist(), strict=True
    ):
        of = shard == s
        for whole, part in zip(out, _unpack(payload, *kinds), strict=True):
            if len(part):
                whole[of] = part
    return out


def _word_log10(counts: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    """Of known words (c - D) / N; of an unknown word the whole class of unknown words."""
    rest = DISCOUNT * distinct / tokens if tokens else 1.0
    seen = np.maximum(counts - DISCOUNT, 1e-300) / max(1, tokens)
    return np.log10(np.where(counts > 0, seen, max(rest, 1e-24)))


class _Model:
    """What every task has to know: a few numbers."""

    def __init__(self, order: int, strength: float, shards: int, tokens: int, distinct: int):
        self.order, self.strength, self.shards = order, strength, shards
        self.tokens, self.distinct = tokens, distinct

    def after(self, own: _Batch, level: int, answers: pa.Table, before: dict) -> dict:
        """Codes and counts of the distinct n-grams of ``level`` + 1 words."""
        if level == 0:
            said = sorted(
                zip(answers.column("shard").to_pylist(), answers.column("payload").to_pylist(),
                    strict=True)
            )
            parts = [(s, *_unpack(p, "<i8", "<i8")) for s, p in said]
            counts = np.concatenate([c for _, c, _ in parts])
            return {
                "counts": counts,
                "codes": to_codes(_word_log10(counts, self.tokens, self.distinct)),
                "ids": np.concatenate([np.cumsum(p) * self.shards + s for s, _, p in parts]),
            }
        shard = self.shard(own, level, before)
        codes, counts = _read_answers(answers, shard, "<u2", "<i8")
        return {"counts": counts, "codes": codes, "ids": before["ids"]}

    def shard(self, own: _Batch, level: int, before: dict) -> np.ndarray:
        contexts = before["counts"][own.context[level]]
        return own.shards(level, self.shards, before["ids"], contexts, self.tokens)


def _levels(answers: pa.Table, level: int) -> pa.Table:
    return answers.filter(pa.array([v == level for v in answers.column("level").to_pylist()]))


def _learned(model: _Model, own: _Batch, answers: pa.Table, upto: int) -> list[dict]:
    out: list[dict] = []
    for level in range(upto):
        out.append(model.after(own, level, _levels(answers, level), out[-1] if out else {}))
    return out


def _gram_requests(encoded: DataFrame, answers: DataFrame, model: _Model, level: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: dict[str, list] = {"shard": [], "batch": [], "payload": []}
        for row in left.to_pylist():
            own = _Batch(row["corpus"], row["held"], level + 1)
            known = _learned(model, own, right, level)[-1]
            contexts = known["counts"][own.context[level]]
            lower, counts = known["codes"][own.suffix[level]], own.counts(level)
            shard = model.shard(own, level, known)
            order = np.argsort(shard, kind="stable")
            starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
            for of in np.split(order, starts[1:]):
                if not len(of):
                    continue
                grams = own.words[level][of]
                used, local = np.unique(known["ids"][grams], return_inverse=True)
                local = local.reshape(grams.shape).astype(np.int32)
                payload = _pack(
                    np.diff(used, prepend=0), *local.T, counts[of].astype(np.int64),
                    contexts[of].astype(np.int64), lower[of],
                )
                columns["shard"].append(int(shard[of[0]]))
                columns["batch"].append(row["batch"])
                columns["payload"].append(payload)
        return _rows(columns, _REQUEST)

    return (
        encoded.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, _REQUEST)
    )


_RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def _score(encoded: DataFrame, answers: DataFrame, model: _Model) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids: list = []
        held: list = []
        numbers: list[list[np.ndarray]] = [[], [], [], []]
        for row in left.to_pylist():
            own = _Batch(row["corpus"], row["held"], model.order)
            known = _learned(model, own, right, model.order)
            counts = known[0]["counts"][own.grams[0]]
            log10 = from_codes(known[0]["codes"])[own.grams[0]]
            for k in range(1, model.order):
                longer = own.grams[k] >= 0
                log10[longer] = from_codes(known[k]["codes"])[own.grams[k][longer]]
            docs = len(own.sizes)

            def total(values: np.ndarray) -> np.ndarray:
                return np.bincount(own.doc[own.scored], values[own.scored], minlength=docs)

            base = total(np.log10(counts + 0.1))
            base -= own.sizes * np.log10(model.tokens + 0.1 * (model.distinct + 1))
            ids += row["doc_ids"]
            held += row["held"]
            parts = (own.sizes.astype(np.int64), total(counts > 0).astype(np.int64), base,
                     total(log10))
            for column, part in zip(numbers, parts, strict=True):
                column.append(part)
        names = ("n_tokens", "n_known", "base_score", "score")
        return pa.table(
            {"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_())}
            | {n: np.concatenate(c) for n, c in zip(names, numbers, strict=True)}
        )

    return encoded.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, _RESULT)


def score(
    docs: DataFrame, held_out: Column, order: int = ORDER, strength: float = STRENGTH,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    The model is learned from the rows where ``held_out`` is false. ``base_score`` is that of
    single words with 0.1 added to every count, ``score`` the log10 probability of the text.
    """
    encoded = materialize(_encode(docs, held_out), "encoded")
    tokens = encoded.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shards = max(4, -(-tokens // shard_tokens))
    asked = _word_requests(encoded.select("batch", "held", "keys", "corpus"), shards)
    said = materialize(asked.groupBy("shard").applyInArrow(_answer_words, _ANSWER), "word-answers")
    trained, distinct = said.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))
    ).first()
    model = _Model(order, strength, shards, trained, distinct)
    answers = said.select("batch", "shard", "payload", F.lit(0).alias("level"))
    corpus = encoded.select("batch", "held", "corpus")
    for level in range(1, order):
        asked = _gram_requests(corpus, answers, model, level)
        said = asked.groupBy("shard").applyInArrow(_answer_grams(level + 1, strength, level + 1 == order), _ANSWER)
        said = materialize(said, "gram-answers")
        answers = answers.unionByName(
            said.select("batch", "shard", "payload", F.lit(level).alias("level"))
        )
    scored = _score(encoded.select("batch", "doc_ids", "held", "corpus"), answers, model)
    return scored.withColumn("train_tokens", F.lit(trained).cast("long"))
