"""A quality classifier: random-indexing word vectors, a two-layer network, calibrated scores.

Every term (a word in lower case, or its shape: all capitals, capitalised, plain, digits,
or the run of signs itself) has a sparse random index vector that follows from its hash bucket. A term's
word vector is the sum of the index vectors around its occurrences, gathered by Spark over
all documents, labelled or not, made unit length, plus its own index vector. A document is the mean over its
words and the mean over its shapes. A network of two layers, trained in numpy on the
pooled vectors of the sample, gives a logit, and a temperature makes it a probability. It is fitted by
cross-fitting: every row is scored by a network that has seen neither it nor any row like it.

The sample, for the network and the temperature only, is bounded: at most SAMPLE labelled rows, those
with the smallest hashes of their ids. All that reaches the driver is bounded by SAMPLE, BUCKETS
and DIM. Under one model, scores depend on the text alone.

Defined results: a NULL or empty text is a document without terms and gets the score of the zero
vector; labels that are NULL or belong to no document are not used; of several labels of one
document the largest counts; repeated documents are scored each; of an id with several texts one is
in the sample, the first by the bytes of its pooled vector; without labels of both kinds the score is the share of label 1 (0.5 without any label); an
empty table gives an empty table; only doc_id and text of the documents, and doc_id and the
label of the labels, are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.common import LOWER_ASCII, Interner, blocks_of, parts_of, released, text_bytes

BUCKETS = 1 << 15
DIM = 64
NONZERO = 6
REACH = 2
HIDDEN = 24
SAMPLE = 10_000
FOLDS = 3
# Sampled rows of this cosine are taken for copies of one text.
ALIKE = 0.99
# Buckets whose sums are added up together: 8 kB from each task.
_RANGE = 1 << 5
_TERMS_AT_ONCE = 20_000
# Texts whose terms are told apart together, in bytes.
_BLOCK_BYTES = 1 << 20
# Occurrences whose contexts are added up together.
_OCCURRENCES = 1 << 16
# Numbers of an index vector, three to a column, each in so many bits.
_BITS = 21
_COLUMNS = -(-DIM // 3)
# A sum of at most 2 * 2 * REACH for each occurrence of a bucket stays within its bits.
_MOST_HELD = (1 << _BITS - 1) // (4 * REACH) - 1
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")


def index_vectors() -> np.ndarray:
    """The sparse ternary vector of each bucket; the same in every task."""
    random = np.random.default_rng(20_11)
    order = random.random((BUCKETS, DIM)).argsort(axis=1)[:, :NONZERO]
    signs = random.choice(np.array([-1, 1], np.float32), (BUCKETS, NONZERO))
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    np.put_along_axis(vectors, order, signs, axis=1)
    return vectors


def _bucket(kind: bytes, term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(kind + term) % BUCKETS


def _shape(term: bytes) -> bytes:
    head = term[0]
    if 48 <= head <= 57:
        return b"9"
    if not (65 <= head <= 90 or 97 <= head <= 122 or head >= 128):
        return term
    text = term.decode("utf-8", "replace")
    if text.islower():
        return b"x"
    if text.isupper():
        return b"X" if len(text) == 1 else b"XX"
    return b"Xx" if text[1:].islower() else b"xX"


def _word_and_shape(term: bytes) -> int:
    return _bucket(b"w", term.lower()) * BUCKETS + _bucket(b"s", _shape(term))


# What a byte belongs to, as in _TERM: white space, letters, digits, other signs.
_KIND = np.full(256, 3, np.uint8)
_KIND[list(b" \t\n\r\f\v")] = 0
_KIND[[b for b in range(256) if chr(b).isalpha() and b < 128 or b >= 128]] = 1
_KIND[list(b"0123456789")] = 2
_LOWER = np.frombuffer(LOWER_ASCII, np.uint8)


def _found(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
    """The terms of ``texts`` by number, where those of each text begin and the last ends, and the distinct
    terms: their bytes in a row, and where each begins and the last ends."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = _KIND[data]
    edges = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(data)]])
    seen = kind[edges[:-1]] != 0
    starts, lengths = edges[:-1][seen], np.diff(edges)[seen]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    letters = pa.py_buffer(data[kind != 0])
    terms = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters]
    ).dictionary_encode()
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    _, at, own = terms.dictionary.buffers()
    at = np.frombuffer(at, np.int64, len(terms.dictionary) + 1) if at else np.zeros(1, np.int64)
    ids = terms.indices.to_numpy(zero_copy_only=False)
    return ids, np.searchsorted(starts, ends), own.to_pybytes() if own else b"", at


def _codes(own: bytes, at: np.ndarray, known: Interner) -> np.ndarray:
    """``_word_and_shape`` of the distinct terms. Those in ASCII are told by their bytes, all at once."""
    if len(at) == 1:
        return np.zeros(0, np.int64)
    data, starts = np.frombuffer(own, np.uint8)[: at[-1]], at[:-1]
    lower = data >= 97
    upper = (data >= 65) & (data <= 90)
    count = np.diff(at)
    uppers = np.add.reduceat(upper, starts, dtype=np.int64)
    capital, letters = upper[starts], _KIND[data[starts]]
    shape = np.select(
        [letters == 2, uppers == 0, (uppers == count) & (count == 1), uppers == count,
         capital & (uppers == 1)],
        [0, 1, 2, 3, 4], 5,
    )
    shapes = np.array([_bucket(b"s", x) for x in (b"9", b"x", b"X", b"XX", b"Xx", b"xX")])[shape]
    # A byte for the kind before each term, so that a slice is what is hashed.
    marked = np.insert(_LOWER[data], starts, ord("w")).tobytes()
    cuts = (at + np.arange(len(at))).tolist()
    digest = xxhash.xxh3_64_intdigest
    words = np.fromiter(
        (digest(marked[a:b]) for a, b in pairwise(cuts)), np.uint64, len(starts)
    )
    codes = (words % BUCKETS).astype(np.int64) * BUCKETS + shapes
    wide = (letters == 1) & (np.maximum.reduceat(data, starts) >= 128)
    for i in np.flatnonzero(wide | (letters == 3)).tolist():
        codes[i] = known[own[at[i] : at[i + 1]]]
    return codes


def _packed_index(index: np.ndarray) -> np.ndarray:
    """Index vectors by bucket, with three of their numbers in each whole number: [columns, BUCKETS]."""
    wide = np.zeros((3 * _COLUMNS, len(index)), np.int64)
    wide[:DIM] = index.T
    return wide[::3] + (wide[1::3] << _BITS) + (wide[2::3] << 2 * _BITS)


def _unpacked(packed: np.ndarray) -> np.ndarray:
    """The numbers in sums of packed ones, a row for each column of ``packed``."""
    out = np.empty((packed.shape[1], 3 * _COLUMNS), np.int64)
    rest = packed
    for k in range(3):
        low = (rest << 64 - _BITS) >> 64 - _BITS
        out[:, k::3] = low.T
        rest = (rest - low) >> _BITS
    return out[:, :DIM]


class _ContextSums:
    """Sums of the index vectors around each bucket's occurrences.

    Numbers are whole, so three of them are added up at once, packed in 64 bits, and are taken apart before a
    bucket has so many occurrences that they could run over.
    """

    def __init__(self, index: np.ndarray):
        self._index = _packed_index(index)
        self.sums = np.zeros((BUCKETS, DIM))
        self._packed = np.zeros((_COLUMNS, BUCKETS), np.int64)
        self._held = np.zeros(BUCKETS, np.int64)

    def add(self, ids: np.ndarray, firsts: np.ndarray, codes: np.ndarray) -> None:
        """Texts by the numbers of their terms, where each begins and the last ends, and the terms' codes."""
        # A stretch of terms sees nothing beyond its ends.
        cuts = [np.arange(a, b, _TERMS_AT_ONCE) for a, b in pairwise(firsts.tolist())]
        cuts = np.concatenate([*cuts, firsts[-1:]])
        at = 0
        while at < len(cuts) - 1:
            end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + _OCCURRENCES, "right")) - 1)
            self._add_piece(ids[cuts[at] : cuts[end]], np.diff(cuts[at : end + 1]), codes)
            at = end

    def _add_piece(self, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> None:
        times = np.bincount(ids, minlength=len(codes))
        used = np.flatnonzero(times)
        place = np.zeros(len(codes) + 1, np.int64)
        place[used] = np.arange(len(used))
        w, s = codes[used] // BUCKETS, codes[used] % BUCKETS
        # Before, between and after the stretches come places without a term.
        spread = np.full(len(ids) + REACH * (len(lengths) + 1), len(used))
        spread[np.arange(len(ids)) + REACH * (1 + np.repeat(np.arange(len(lengths)), lengths))] = place[ids]
        inner = spread[REACH:-REACH]
        shapes, shape_of = np.unique(s, return_inverse=True)
        of_shapes = np.zeros((_COLUMNS, len(shapes)), np.int64)
        if self._held.max() + len(ids) > _MOST_HELD:
            self.flush()
        self._held += np.bincount(w, times[used], BUCKETS).astype(np.int64)
        for k in range(_COLUMNS):
            own = np.append(self._index[k][w] + self._index[k][s], 0)[spread]
            around = own[: len(inner)].copy()
            for d in range(1, 2 * REACH + 1):
                if d != REACH:
                    around += own[d : len(inner) + d]
            of_terms = np.zeros(len(used) + 1, np.int64)
            np.add.at(of_terms, inner, around)
            np.add.at(self._packed[k], w, of_terms[:-1])
            np.add.at(of_shapes[k], shape_of, of_terms[:-1])
        self.sums[shapes] += _unpacked(of_shapes)

    def flush(self) -> None:
        for at in range(0, BUCKETS, 1 << 12):
            self.sums[at : at + (1 << 12)] += _unpacked(self._packed[:, at : at + (1 << 12)])
        self._packed[:], self._held[:] = 0, 0


def _context_sums(docs: DataFrame) -> np.ndarray:
    """Sums of index vectors around each bucket's occurrences, over all of ``docs``."""

    shared = docs.sparkSession.sparkContext.broadcast(index_vectors().astype(np.int8))

    def run(batches):
        found, known = _ContextSums(shared.value), Interner(_word_and_shape)
        for block in blocks_of(batches, lambda r: len(r[0]), "text", most=_BLOCK_BYTES):
            ids, firsts, own, at = _found([t for (t,) in block])
            found.add(ids, firsts, _codes(own, at, known))
        found.flush()
        sums = found.sums
        parts = [i for i in range(0, BUCKETS, _RANGE) if sums[i : i + _RANGE].any()]
        blobs = [sums[i : i + _RANGE].astype(np.float32).tobytes() for i in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "sums"]
        )

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(_RANGE * DIM, np.float64)
        for blob in rows.column("sums"):
            total += np.frombuffer(blob.as_py(), np.float32)
        return pa.table(
            {"part": rows.column("part")[:1], "sums": [total.astype(np.float32).tobytes()]}
        )

    partial = docs.select(text_bytes()).mapInArrow(released(run), "part long, sums binary")
    sums = np.zeros((BUCKETS, DIM), np.float32)
    for part, blob in partial.groupBy("part").applyInArrow(add, "part long, sums binary").collect():
        sums[part : part + _RANGE] = np.frombuffer(blob, np.float32).reshape(_RANGE, DIM)
    return sums


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def pooled(texts: list[bytes], vectors: np.ndarray, known: Interner) -> np.ndarray:
    """A row per text: the mean over its words' vectors and the mean over its shapes'."""
    out = np.zeros((len(texts), 2 * DIM), np.float32)
    ids, firsts, own, at = _found(texts)
    codes = _codes(own, at, known)
    words = codes // BUCKETS
    shapes, shape_of = np.unique(codes % BUCKETS, return_inverse=True)
    for i, (first, end) in enumerate(pairwise(firsts.tolist())):
        for start in range(first, end, _TERMS_AT_ONCE):
            part = ids[start : min(start + _TERMS_AT_ONCE, end)]
            out[i, :DIM] += vectors[words[part]].sum(axis=0)
            counts = np.bincount(shape_of[part], minlength=len(shapes))
            used = np.flatnonzero(counts)
            out[i, DIM:] += counts[used].astype(np.float32) @ vectors[shapes[used]]
        out[i] /= max(1, end - first)
    return out


@dataclass(frozen=True)
class Network:
    """Two layers and a temperature. ``score`` gives probabilities of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train_network(
    rows: np.ndarray, labels: np.ndarray, epochs: int = 60, seed: int = 7
) -> Network:
    """Fit on all ``rows``, at temperature 1."""
    rows = rows.astype(np.float64)
    y = labels.astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = float(labels.mean()) if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        zero = np.zeros(rows.shape[1])
        return Network(
            zero, zero + 1, np.zeros((rows.shape[1], 1)), np.zeros(1), np.zeros(1),
            float(np.log(share / (1 - share))), 1.0,
        )
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    random = np.random.default_rng(seed)
    x = (rows - mean) / scale
    p = [
        random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    moment, square, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for chosen in np.array_split(random.permutation(len(x)), max(1, len(x) // 64)):
            xb, yb = x[chosen], y[chosen]
            hidden = np.tanh(xb @ p[0] + p[1])
            error = (_sigmoid(hidden @ p[2] + p[3]) - yb) / len(yb)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            grads = [
                xb.T @ back + 1e-3 * p[0], back.sum(axis=0),
                hidden.T @ error + 1e-3 * p[2], error.sum(keepdims=True),
            ]
            step += 1
            for i, g in enumerate(grads):
                moment[i] = 0.9 * moment[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                m, s = moment[i] / (1 - 0.9**step), square[i] / (1 - 0.999**step)
                p[i] = p[i] - 3e-3 * m / (np.sqrt(s) + 1e-8)
    return Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)


def families(rows: np.ndarray, alike: float = ALIKE) -> np.ndarray:
    """A number for each row, the same for rows that are linked by cosines of ``alike`` or more.

    Cosines are those of the rows' differences from the mean row, each number over its deviation.
    """
    if not len(rows):
        return np.zeros(0, int)
    unit = _unit((rows - rows.mean(axis=0)) / (rows.std(axis=0) + 1e-3)).astype(np.float32)
    family = np.arange(len(rows))
    changed = True
    while changed:
        before = family.copy()
        for at in range(0, len(rows), 512):
            near = unit[at : at + 512] @ unit.T >= alike
            lowest = np.where(near, family, len(rows)).min(axis=1)
            family[at : at + 512] = np.minimum(family[at : at + 512], lowest)
        changed = bool((family != before).any())
    return family


def log_losses(logits: np.ndarray, labels: np.ndarray, temperature: float) -> np.ndarray:
    q = np.clip(_sigmoid(logits / temperature), 1e-9, 1 - 1e-9)
    return -(labels * np.log(q) + (1 - labels) * np.log(1 - q))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss.

    One below 1, which makes scores bolder, is taken only if its loss is lower than that of 1 by twice the
    standard error of the difference.
    """
    grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    best = float(min(grid, key=lambda t: log_losses(logits, labels, t).mean()))
    if best >= 1:
        return best
    gain = log_losses(logits, labels, 1.0) - log_losses(logits, labels, best)
    sure = len(gain) > 1 and gain.mean() > 2 * gain.std() / np.sqrt(len(gain))
    return best if sure else 1.0


def train_calibrated(rows: np.ndarray, labels: np.ndarray) -> Network:
    """A network fitted on all rows, with a temperature from scores of rows that had no part in them.

    Rows are cut into FOLDS, a family of near-equal rows into one of them, and each fold is scored by a network
    fitted on the others.
    """
    network = train_network(rows, labels)
    if not len(labels) or labels.min() == labels.max():
        return network
    family = families(rows)
    fold = np.array([xxhash.xxh3_64_intdigest(rows[f].tobytes()) % FOLDS for f in family])
    logits, scored = np.zeros(len(rows)), np.zeros(len(rows), bool)
    for k in range(FOLDS):
        held = fold == k
        if held.any() and len(set(labels[~held].tolist())) == 2:
            other = train_network(rows[~held], labels[~held])
            logits[held], scored[held] = other.logits(rows[held].astype(np.float64)), True
    if not scored.any():
        return network
    return replace(network, temperature=fit_temperature(logits[scored], labels[scored]))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE
) -> tuple[np.ndarray, Network]:
    """Word vectors of all ``docs``; a network from at most ``sample`` rows of ``labels`` (doc_id, ``label``)."""
    chosen = (
        labels.select("doc_id", F.col(label).alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # No more than ``sample`` rows of two numbers are broadcast.
    texts = docs.select("doc_id", text_bytes()).join(F.broadcast(chosen), "doc_id")
    texts = texts.select("doc_id", "text", F.col("label").cast("double"))
    sums = _context_sums(docs)
    vectors = (_unit(sums) + _unit(index_vectors())).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        known = Interner(_word_and_shape)
        for block in blocks_of(
            batches, lambda r: len(r[1]), "doc_id", "text", "label", most=_BLOCK_BYTES
        ):
            rows = pooled([t for _, t, _ in block], shared.value, known)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in block], pa.int64()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array([y for _, _, y in block], pa.float64()),
                ],
                names=["doc_id", "row", "label"],
            )

    # At most ``sample`` documents; of an id with several texts the row that is first by its bytes.
    found = texts.mapInArrow(released(run), "doc_id long, row binary, label double")
    found = found.groupBy("doc_id").agg(F.min("row").alias("row"), F.max("label").alias("label"))
    got = sorted(found.collect())
    rows = np.array([np.frombuffer(r.row, np.float32) for r in got]).reshape(len(got), 2 * DIM)
    answers = np.array([1.0 if r.label > 0 else 0.0 for r in got])
    return vectors, train_calibrated(rows, answers)


def score(docs: DataFrame, model: tuple[np.ndarray, Network]) -> DataFrame:
    """doc_id, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        (vectors, network), known = shared.value, Interner(_word_and_shape)
        for block in blocks_of(
            batches, lambda r: len(r[1]), "doc_id", "text", most=_BLOCK_BYTES
        ):
            scores = network.score(pooled([t for _, t in block], vectors, known))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in block], pa.int64()), pa.array(scores, pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(released(run), "doc_id long, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], least: float) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        (vectors, network), known = shared.value, Interner(_word_and_shape)
        for part in parts_of(batches, "text", _BLOCK_BYTES):
            texts = part.column("text").cast(pa.binary())
            rows = pooled([t.as_py() or b"" for t in texts], vectors, known)
            yield part.filter(pa.array(network.score(rows) >= least))

    return docs.mapInArrow(released(run), docs.schema)
