"""Mixing to target weights with soft membership.

A classifier fitted on a labelled table gives every document a posterior over the domains. The rates
r solve: least squares between the expected tokens of the domains, sum of r * n * posterior, and
the targets, relative to each target, with 0 <= r <= ``most_copies`` (1 unless said otherwise).
Projected gradient with momentum, preconditioned by 1/n so that documents alike in domain change
alike whatever their length. A document's rate follows from its posterior and the gradients so far,
a few numbers per step, so a step is one scan of a narrow table that adds up one number per domain.
Every REPLAY steps the rates so far are written beside the posteriors, so that no scan takes more
steps than that again.

A document with rate r is taken floor(r) times, and once more when a number drawn from its id is
below the rest, so the tokens taken of each domain have the fitted totals as their expectation.

Defined results: a NULL or empty text has no tokens and the domains' shares in the sample as posterior; labels
that are NULL or no target domain are not used; a NULL doc_id is drawn as one id; rows that repeat
an id share one draw. A wanted domain that no labelled row has, while others have some, cannot be
told from the rest: it is an error that names it, unless it is in ``ignored``; then it has no target, and
the others' weights are scaled to add up to 1. Without any labelled row all domains have equal
posteriors. Without ``total_tokens`` every wanted domain that is not in ``ignored`` limits the total,
however rare; with ``most_copies`` above 1 it limits it by so many times its tokens, and the total is
no more than the tokens of all documents. With ``total_tokens``, targets that the documents cannot
serve are met as nearly as least squares allow. An empty table gives an empty table; only doc_id
and text of the documents, and doc_id and the label of the labelled table, are looked at.
"""

from __future__ import annotations

import logging
from collections.abc import Collection
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm import bayes
from cinderlake.llm.common import blocks_of, parts_of, released, text_bytes, words
from cinderlake.workspace import materialize

BUCKETS = 1 << 14
EVIDENCE = 20.0
STEPS = 120
REPLAY = 10
CLOSE = 1e-4
# A larger relative miss of a target is a warning in the log.
_MISS = 0.01
_log = logging.getLogger(__name__)


def _members(docs: DataFrame, shares: np.ndarray, table: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, posterior (array by domain)."""
    shared = docs.sparkSession.sparkContext.broadcast((shares, table))

    def run(batches):
        (log_shares, likely), read = shared.value, bayes.word_features(BUCKETS)()
        for block in blocks_of(batches, lambda r: len(r[1]), "doc_id", "text"):
            found = [bayes.evidence(read(t), likely, EVIDENCE) for _, t in block]
            posterior = bayes.softmax(np.array(found) + log_shares)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in block], pa.int64()),
                    pa.array([len(words(t)) for _, t in block], pa.int64()),
                    pa.array(posterior.tolist(), pa.list_(pa.float64())),
                ],
                names=["doc_id", "n_tokens", "posterior"],
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(
        released(run), "doc_id long, n_tokens long, posterior array<double>"
    )


def rates(
    posterior: np.ndarray, gradients: list[np.ndarray], momenta: list[float], most: float = 1.0
) -> np.ndarray:
    """The rate of each row after the steps so far."""
    start = np.ones(len(posterior))
    return _advance(posterior, start, start, gradients, momenta, most)[0]


def _advance(posterior, now, before, gradients, momenta, most) -> tuple[np.ndarray, np.ndarray]:
    """Rates after some steps more, and those one step earlier."""
    for gradient, momentum in zip(gradients, momenta, strict=True):
        ahead = now + momentum * (now - before)
        before, now = now, np.clip(ahead - posterior @ gradient, 0, most)
    return now, before


def _posteriors(batch: pa.RecordBatch, domains: int) -> np.ndarray:
    return batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def _written(members: DataFrame, domains: int, gradients, momenta, most: float) -> DataFrame:
    """n_tokens, posterior and the rates after some steps more (now, before), as a table."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            start = [batch.column(n).to_numpy() for n in ("now", "before")]
            found = _advance(_posteriors(batch, domains), *start, gradients, momenta, most)
            yield pa.RecordBatch.from_arrays(
                [batch.column("n_tokens"), batch.column("posterior"), *map(pa.array, found)],
                names=["n_tokens", "posterior", "now", "before"],
            )

    schema = "n_tokens long, posterior array<double>, now double, before double"
    return materialize(members.mapInArrow(released(run), schema), "rates")


def _expected(members: DataFrame, domains: int, gradients, momenta, most: float) -> np.ndarray:
    """Expected tokens of each domain under the rates after some steps more."""

    def run(batches):
        total = np.zeros(domains)
        for batch in batches:
            if len(batch):
                posterior = _posteriors(batch, domains)
                start = [batch.column(n).to_numpy() for n in ("now", "before")]
                now, _ = _advance(posterior, *start, gradients, momenta, most)
                total += (now * batch.column("n_tokens").to_numpy()) @ posterior
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["total"])

    sums = members.mapInArrow(released(run), "total array<double>")
    sums = sums.agg(*[F.coalesce(F.sum(F.col("total")[k]), F.lit(0.0)) for k in range(domains)])
    return np.array(sums.first(), float)


def _curvature(members: DataFrame, domains: int) -> np.ndarray:
    """Sum of n * posterior * posterior', [domains, domains]."""
    cells = [
        F.coalesce(F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j]),
                   F.lit(0.0))
        for i in range(domains)
        for j in range(domains)
    ]
    return np.array(members.agg(*cells).first(), float).reshape(domains, domains)


@dataclass(frozen=True)
class Fitted:
    """The steps that lead to the rates, and what they reach: tokens of each domain."""

    gradients: list[np.ndarray]
    momenta: list[float]
    wanted: np.ndarray
    reached: np.ndarray
    converged: bool


def solve_rates(
    members: DataFrame, weights: np.ndarray, total_tokens: float | None = None,
    ignored: Collection[int] = (), most_copies: float = 1.0,
) -> Fitted:
    """The steps that bring the expected tokens to the targets.

    Without ``total_tokens`` it is the most that rates up to ``most_copies`` can serve of all domains with
    a weight but those whose places are ``ignored``.
    """
    domains = len(weights)
    one = F.lit(1.0)
    members = members.select("n_tokens", "posterior", one.alias("now"), one.alias("before"))
    have = _expected(members, domains, [], [], most_copies)
    if not have.sum():
        return Fitted([], [], np.zeros(domains), have, True)
    binding = (weights > 0) & ~np.isin(np.arange(domains), list(ignored))
    total = total_tokens
    if total is None:
        if not binding.any():
            raise ValueError("without total_tokens, a wanted domain that is not ignored is needed")
        if not have[binding].all():
            raise ValueError(
                f"no tokens of the wanted domains {np.flatnonzero(binding & (have == 0)).tolist()}: "
                "ignore them or give total_tokens"
            )
        total = float((most_copies * have[binding] / weights[binding]).min())
        if most_copies > 1:
            total = min(total, float(have.sum()))
    target = np.maximum(weights * total, 1e-3 * total)
    scaled = _curvature(members, domains) / np.outer(target, target)
    step = 1 / np.linalg.eigvalsh(scaled).max()
    gradients: list[np.ndarray] = []
    momenta: list[float] = []
    now = before = have
    inertia, loss, converged, done = 1.0, np.inf, False, 0
    for taken in range(STEPS + 1):
        last, loss = loss, float((((now - weights * total) / target) ** 2).sum())
        if loss > last:  # the momentum has gone past the minimum
            inertia = 1.0
        elif last - loss < 1e-7 * loss:
            converged = True
        if np.abs((now - weights * total) / target)[binding].max(initial=0.0) < CLOSE:
            converged = True
        if converged or taken == STEPS:
            break
        following = (1 + np.sqrt(1 + 4 * inertia**2)) / 2
        momentum = (inertia - 1) / following
        ahead = now + momentum * (now - before)
        gradients.append(step * (ahead - weights * total) / target**2)
        momenta.append(momentum)
        if len(gradients) - done > REPLAY:
            part = slice(done, len(gradients) - 1)
            members = _written(members, domains, gradients[part], momenta[part], most_copies)
            done = len(gradients) - 1
        following_now = _expected(members, domains, gradients[done:], momenta[done:], most_copies)
        before, now = now, following_now
        inertia = following
    return Fitted(gradients, momenta, weights * total, now, converged)


def fit_rates(
    members: DataFrame, weights: np.ndarray, total_tokens: float | None = None
) -> tuple[list[np.ndarray], list[float]]:
    """Gradients and momenta of ``solve_rates``."""
    fitted = solve_rates(members, weights, total_tokens)
    return fitted.gradients, fitted.momenta


@dataclass(frozen=True)
class Report:
    """Tokens by domain as wanted and as expected under the rates, the domains that did not limit
    the total, and whether the steps converged."""

    wanted: dict[str, float]
    reached: dict[str, float]
    ignored: list[str]
    converged: bool

    def missed(self) -> list[str]:
        """Domains whose tokens are more than 1% off what is wanted."""
        return [d for d, w in self.wanted.items() if abs(self.reached[d] - w) > _MISS * w]


@dataclass(frozen=True)
class Mixer:
    """The classifier and the steps that lead to the rates; the same for every document."""

    domains: list[str]
    log_shares: np.ndarray
    likely: np.ndarray
    gradients: list[np.ndarray]
    momenta: list[float]
    report: Report
    most_copies: float = 1.0

    def judge(self, ids: list[int | None], posterior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates of documents, and how often each is taken."""
        found = rates(posterior, self.gradients, self.momenta, self.most_copies)
        drawn = np.array([xxhash.xxh3_64_intdigest(f"mix {i}") / 2.0**64 for i in ids])
        whole = np.floor(found)
        return found, (whole + (drawn < found - whole)).astype(np.int64)


def fit(
    docs: DataFrame, labelled: DataFrame, label: str, targets: dict[str, float],
    total_tokens: float | None = None, ignored: Collection[str] = (), most_copies: float = 1.0,
) -> tuple[Mixer, DataFrame]:
    """The mixer for ``docs``, and their written posteriors.

    ``labelled`` has doc_id and ``label``; ``targets`` gives each domain's weight. Domains in
    ``ignored`` do not limit the total when ``total_tokens`` is not given, and may lack labelled rows.
    """
    if most_copies < 1:
        raise ValueError("most_copies is at least 1")
    classes = sorted(targets)
    weights = np.array([targets[c] for c in classes], float)
    sample = materialize(bayes.labelled_sample(labelled, label, classes=classes), "sample")
    known = {r["class"] for r in sample.select("class").distinct().collect()}
    absent = [c for c in classes if targets[c] > 0 and c not in known] if known else []
    unsaid = [c for c in absent if c not in ignored]
    if unsaid:
        raise ValueError(
            f"no labelled rows of the wanted domains {unsaid}: label some, or list them in ignored"
        )
    weights[[c in absent for c in classes]] = 0.0
    weights = weights / weights.sum()
    classes, shares, table = bayes.fit(
        docs, sample, classes, bayes.word_features(BUCKETS), BUCKETS
    )
    members = materialize(_members(docs, shares, table), "members")
    places = [k for k, c in enumerate(classes) if c in ignored]
    fitted = solve_rates(members, weights, total_tokens, places, most_copies)
    report = Report(
        dict(zip(classes, fitted.wanted.tolist(), strict=True)),
        dict(zip(classes, fitted.reached.tolist(), strict=True)),
        [classes[k] for k in places], fitted.converged,
    )
    good = report.converged and not report.missed()
    _log.log(logging.INFO if good else logging.WARNING, "mixing: %s", report)
    mixer = Mixer(classes, shares, table, fitted.gradients, fitted.momenta, report, most_copies)
    return mixer, members


def mix(
    docs: DataFrame, labelled: DataFrame, label: str, targets: dict[str, float],
    total_tokens: float | None = None, ignored: Collection[str] = (), most_copies: float = 1.0,
) -> DataFrame:
    """doc_id, n_tokens, posterior (by domain name, sorted), rate, kept, copies (how often the
    document is taken): a row per row of ``docs``."""
    mixer, members = fit(docs, labelled, label, targets, total_tokens, ignored, most_copies)

    def run(batches):
        for batch in batches:
            found, copies = mixer.judge(
                batch.column("doc_id").to_pylist(), _posteriors(batch, len(mixer.domains))
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array(copies > 0), pa.array(copies)],
                names=[*batch.schema.names, "rate", "kept", "copies"],
            )

    return members.mapInArrow(
        released(run), "doc_id long, n_tokens long, posterior array<double>, rate double, kept boolean, "
        "copies long"
    )


def keep_mixed(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """The rows of ``docs`` that the mixer takes, as often as it takes them, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(mixer)

    def run(batches):
        own, read = shared.value, bayes.word_features(BUCKETS)()
        for part in parts_of(batches, "text"):
            texts = part.column("text").cast(pa.binary())
            found = [bayes.evidence(read(t.as_py() or b""), own.likely, EVIDENCE) for t in texts]
            posterior = bayes.softmax(np.array(found) + own.log_shares)
            _, copies = own.judge(part.column("doc_id").to_pylist(), posterior)
            yield part.take(pa.array(np.repeat(np.arange(len(part)), copies)))

    return docs.mapInArrow(released(run), docs.schema)
