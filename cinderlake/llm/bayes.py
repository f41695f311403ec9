"""Log-likelihood tables of text features per class, counted by Spark over a labelled sample."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.common import Interner, released, text_bytes, words
from cinderlake.workspace import materialize

SAMPLE = 20_000
MOST_CLASSES = 256
_PRIME = np.uint32(0x9E3779B1)


def word_features(buckets: int) -> Callable[[], Callable[[bytes], np.ndarray]]:
    """Words, by hash."""

    def make() -> Callable[[bytes], np.ndarray]:
        known = Interner(lambda w: xxhash.xxh3_64_intdigest(w) % buckets)
        return lambda text: np.fromiter(map(known.__getitem__, words(text)), np.int64)

    return make


def trigram_features(buckets: int) -> Callable[[], Callable[[bytes], np.ndarray]]:
    """Runs of three bytes of the lower-cased words with single spaces between, by hash."""

    def make() -> Callable[[bytes], np.ndarray]:
        def run(text: bytes) -> np.ndarray:
            spaced = b" ".join(words(text))
            data = np.frombuffer(b" " + spaced + b" " if spaced else b"", np.uint8)
            if len(data) < 3:
                return np.zeros(0, np.int64)
            data = data.astype(np.uint32)
            code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
            return ((code * _PRIME) >> np.uint32(8)).astype(np.int64) % buckets

        return run

    return make


def _per_class(counts: Sequence[int], most: int) -> int:
    """The largest bound on every class under which the classes together have at most ``most`` rows."""
    left, bound = most, 0
    for i, n in enumerate(sorted(counts)):
        bound = left // (len(counts) - i)
        if n > bound:
            return bound
        left -= n
    return max(bound, *counts) if counts else 0


def labelled_sample(
    labels: DataFrame, label: str, most: int = SAMPLE, classes: Sequence[str] | None = None
) -> DataFrame:
    """doc_id, class and the number of documents of the class, of at most ``most`` documents.

    Without ``classes`` they are all labels that occur; more than MOST_CLASSES of them are an error. A class
    with no more rows than its part of ``most`` is in with all of them, and what it leaves goes to
    the others, which have about equal parts, those with the smallest hashes of their ids.
    """
    known = labels.select("doc_id", F.col(label).cast("string").alias("class")).dropna()
    one = known.groupBy("doc_id").agg(F.max("class").alias("class"))
    if classes is not None:
        one = one.where(F.col("class").isin(list(classes)))
    one = materialize(one, "labelled")
    allowed = min(most, MOST_CLASSES if classes is None else len(classes))
    found = one.groupBy("class").count().limit(allowed + 1).collect()
    if len(found) > allowed:
        raise ValueError(f"more than {allowed} classes in {label}")
    bound = _per_class([r["count"] for r in found], most)
    sizes = F.broadcast(
        labels.sparkSession.createDataFrame(
            [(r["class"], r["count"]) for r in found], "class string, of_class long"
        )
    )
    # Hashes are even: in the order of hash times size, classes of any size have equal parts.
    order = F.xxhash64("doc_id")
    even = (order.cast("double") + 2.0**63) * F.col("of_class")
    turn = F.when(F.col("of_class") > bound, even).otherwise(F.lit(-1.0))
    first = one.join(sizes, "class").orderBy(turn, order, "doc_id").limit(most)
    return first.select("doc_id", "class", "of_class")


def fit(
    docs: DataFrame, sample: DataFrame, classes: Sequence[str] | None, features, buckets: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Classes, log shares of the classes, log-likelihoods [buckets, classes].

    ``sample`` is what ``labelled_sample`` gives, so it can be broadcast, and it has all classes.
    Without ``classes`` they are the labels that occur. What reaches the driver is a table of
    ``buckets`` by classes. The shares are those of all labels, not of the sample.
    """
    sizes = sample.groupBy("class").agg(F.count("*").alias("n"), F.max("of_class").alias("all"))
    times = {r["class"]: r["all"] / r["n"] for r in sizes.collect()}
    classes = sorted(times) if classes is None else list(classes)
    place = {c: i for i, c in enumerate(classes)}
    texts = docs.select("doc_id", text_bytes()).join(F.broadcast(sample), "doc_id")

    def run(batches):
        read = features()
        counts, docs_of = np.zeros((len(classes), buckets), np.int64), np.zeros(len(classes), int)
        for batch in batches:
            for text, name in zip(
                batch.column("text").to_pylist(), batch.column("class").to_pylist(), strict=True
            ):
                if name in place:
                    docs_of[place[name]] += 1
                    np.add.at(counts[place[name]], read(text), 1)
        used = np.flatnonzero(docs_of)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int64()),
                pa.array([counts[k].tobytes() for k in used], pa.binary()),
                pa.array(docs_of[used], pa.int64()),
            ],
            names=["class", "counts", "docs"],
        )

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(buckets, np.int64)
        for blob in rows.column("counts"):
            total += np.frombuffer(blob.as_py(), np.int64)
        return pa.table(
            {
                "class": rows.column("class")[:1],
                "counts": pa.array([total.tobytes()], pa.binary()),
                "docs": [sum(rows.column("docs").to_pylist())],
            }
        )

    schema = "class long, counts binary, docs long"
    partial = texts.select("text", "class").mapInArrow(released(run), schema)
    shares = np.ones(len(classes))
    counts = np.zeros((len(classes), buckets))
    for k, blob, n in partial.groupBy("class").applyInArrow(add, schema).collect():
        counts[k] = np.frombuffer(blob, np.int64)
        shares[k] += n * times[classes[k]]
    # Each class leans on the counts of all, so that a feature it lacks is not impossible.
    all_ = (counts.sum(axis=0) + 1) / (counts.sum() + buckets)
    likely = (counts + 50 * all_) / (counts.sum(axis=1, keepdims=True) + 50)
    return classes, np.log(shares / max(shares.sum(), 1)), np.log(likely).T.copy()


def evidence(found: np.ndarray, table: np.ndarray, most: float) -> np.ndarray:
    """Mean log-likelihood of the features times their number, which counts ``most`` at most.

    Features of one text are not independent; a long text is not endless evidence.
    """
    if not len(found):
        return np.zeros(table.shape[1])
    total = np.zeros(table.shape[1])
    for at in range(0, len(found), 1 << 20):
        total += table[found[at : at + (1 << 20)]].sum(axis=0)
    return total / len(found) * (len(found) / (1 + len(found) / most))


def softmax(logits: np.ndarray) -> np.ndarray:
    high = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return high / high.sum(axis=-1, keepdims=True)
