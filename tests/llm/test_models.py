"""Quality, mixing and language of pages: defined results and held-out accuracy."""

import random

import numpy as np
import pytest

from cinderlake.llm import bayes, language_id, mixing, quality
from cinderlake.llm.mixing import rates

GOOD = "the of and reading water under house morning light".split()
OTHER = "der die und wasser unter haus morgen licht nicht".split()


def text(rng, words, junk=False):
    found = rng.choices(words, k=rng.randrange(5, 60))
    return " ".join(w.upper() + "!!" if junk else w for w in found)


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(9)
    rows = [(i, text(rng, GOOD, i % 4 == 0)) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "the water"), (3, rows[3][1])]
    return spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")


def test_quality_on_held_out_documents(spark, documents):
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0)) for i in range(0, 300)] + [(None, 1), (5, None), (7777, 0)],
        "doc_id long, quality int",
    )
    model = quality.fit(documents, labels)
    got = quality.score(documents, model).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 400]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 4 != 0) for r in held]) > 0.97
    kept = quality.keep_good(documents, model, 0.7)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        r.doc_id or -1 for r in got if r.score >= 0.7
    )


def test_quality_without_labels_or_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(documents, none)
    assert {r.score for r in quality.score(documents, model).collect()} == {0.5}
    assert quality.score(documents.limit(0), model).collect() == []


def test_one_label_kind_gives_its_share(spark, documents):
    ones = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    scores = {r.score for r in quality.score(documents, quality.fit(documents, ones)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.99


def test_word_vectors_learn_from_documents_without_labels(spark, documents):
    far = spark.createDataFrame(
        [(5000 + i, "zorp quix blen", 0.5) for i in range(3)], documents.schema
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    vectors, _ = quality.fit(documents.union(far), labels)
    index = quality.index_vectors()
    zorp, quix, blen, plain = (
        quality._bucket(kind, t)
        for kind, t in [(b"w", b"zorp"), (b"w", b"quix"), (b"w", b"blen"), (b"s", b"x")]
    )
    around = index[quix] + index[blen] + 2 * index[plain]
    expected = quality._unit(around[None]) + quality._unit(index[zorp][None])
    assert vectors[zorp] == pytest.approx(expected[0], abs=1e-6)
    # However the documents are dealt to tasks, the sums are the same.
    again, _ = quality.fit(documents.union(far).repartition(5), labels)
    assert np.array_equal(vectors, again)


def test_repeated_ids_do_not_depend_on_tasks(spark, documents):
    rng = random.Random(2)
    more = [(i, text(rng, GOOD, k % 2 == 0), 0.1) for i in range(60) for k in range(3)]
    docs = documents.union(spark.createDataFrame(more, documents.schema))
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)], "doc_id long, quality int")
    found = []
    for parts in (3, 30):
        dealt = docs.repartition(parts)
        vectors, network = quality.fit(dealt, labels)
        found.append((vectors.tobytes(), network.w1.tobytes(), network.temperature))
    assert found[0] == found[1]


def test_pooling_and_scores_of_whole_texts(spark):
    """Every score of a given table from plain loops over terms, under the fitted vectors and network."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    vectors, network = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, (vectors, network)).collect()}
    for row in docs.collect():
        words, shapes, terms = np.zeros(quality.DIM), np.zeros(quality.DIM), 0
        for term in quality._TERM.findall((row.text or "").encode()):
            w, s = divmod(quality._word_and_shape(term), quality.BUCKETS)
            words, shapes, terms = words + vectors[w], shapes + vectors[s], terms + 1
        pooled = np.concatenate([words, shapes]) / max(1, terms)
        hidden = np.tanh((pooled - network.mean) / network.scale @ network.w1 + network.b1)
        logit = (hidden @ network.w2 + network.b2) / network.temperature
        assert got[row.doc_id] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_families_of_rows():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(700, 20)).astype(np.float32)
    rows[650] = rows[3]
    rows[651:655] = rows[10] + rng.normal(size=(4, 20)) * 0.001
    family = quality.families(rows)
    assert family[650] == 3 and set(family[651:655]) == {10} and len(set(family)) == 695
    assert len(quality.families(rows[:0])) == 0


def test_temperature_needs_evidence_to_be_bold():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000) * 2
    drawn = rng.random(4000)
    honest = (drawn < 1 / (1 + np.exp(-z))).astype(float)
    assert quality.fit_temperature(z * 3, honest) == pytest.approx(3, rel=0.15)
    assert quality.fit_temperature(z / 2, honest) < 0.7  # plain evidence
    assert quality.fit_temperature(z[:6] / 1.1, honest[:6]) >= 1 or len(set(honest[:6])) == 1
    near = quality.fit_temperature(z, honest)
    assert near == 1.0 or near == pytest.approx(1, abs=0.1)


def test_temperature_does_not_harm_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    from cinderlake.llm.common import id_crc

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    vectors, network = quality.fit(docs, labels.where(id_crc() % 4 != 2))
    held = docs.join(labels.where(id_crc() % 4 == 2), "doc_id").select("text", "quality").collect()
    rows = quality.pooled([(r.text or "").encode() for r in held], vectors, quality.Interner(quality._word_and_shape))
    z, y = network.logits(rows.astype(np.float64)), np.array([r.quality for r in held], float)
    with_it, without = (quality.log_losses(z, y, t).mean() for t in (network.temperature, 1.0))
    assert with_it <= without + 1e-6


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, OTHER if i % 3 == 0 else GOOD), "de" if i % 3 == 0 else "en")
            for i in range(600)]
    rows += [(1000, None, "en"), (1001, "", None), (None, "der die", "de"), (3, rows[3][1], "de")]
    return spark.createDataFrame([(*r, 1.0) for r in rows],
                                 "doc_id long, text string, lang string, rate double")


def test_mixing_meets_targets(mixed):
    targets = {"en": 0.4, "de": 0.6}
    got = mixing.mix(mixed, mixed.where("doc_id % 2 = 0"), "lang", targets).collect()
    assert len(got) == mixed.count()
    expected = sum(r.n_tokens * r.rate * np.array(r.posterior) for r in got)
    assert expected / expected.sum() == pytest.approx([0.6, 0.4], abs=0.01)
    assert all(0 <= r.rate <= 1 for r in got)
    assert max(r.rate for r in got) > 0.99  # no more is left out than the targets ask for
    kept = sum(r.n_tokens * np.array(r.posterior) for r in got if r.kept)
    assert kept / kept.sum() == pytest.approx([0.6, 0.4], abs=0.06)


def test_mixer_keeps_whole_rows(mixed):
    mixer, _ = mixing.fit(mixed, mixed, "lang", {"en": 0.4, "de": 0.6})
    rows = mixing.mix(mixed, mixed, "lang", {"en": 0.4, "de": 0.6})
    whole = mixing.keep_mixed(mixed, mixer)
    assert whole.columns == mixed.columns
    assert sorted(r.doc_id or -1 for r in whole.collect()) == sorted(
        r.doc_id or -1 for r in rows.where("kept").collect()
    )


def test_rates_against_plain_projected_gradient(spark):
    rng = np.random.default_rng(0)
    posterior = rng.dirichlet([0.3, 0.3, 0.3], 200)
    n = rng.integers(1, 200, 200)
    frame = spark.createDataFrame(
        [(i, int(n[i]), posterior[i].tolist()) for i in range(200)],
        "doc_id long, n_tokens long, posterior array<double>",
    ).repartition(3)
    weights = np.array([0.5, 0.3, 0.2])
    found = rates(posterior, *mixing.fit_rates(frame, weights))
    total = ((n @ posterior) / weights).min()
    # The same least squares, solved in one place by many plain steps.
    plain = np.ones(200)
    target = weights * total
    step = 1 / np.linalg.eigvalsh((posterior.T * n) @ posterior / np.outer(target, target)).max()
    for _ in range(5000):
        residual = ((plain * n) @ posterior - target) / target**2
        plain = np.clip(plain - step * posterior @ residual, 0, 1)
    loss = [np.sum((((r * n) @ posterior - target) / target) ** 2) for r in (found, plain)]
    assert loss[0] <= 1.05 * loss[1] + 1e-6


def test_a_rare_domain_limits_the_total(spark):
    posterior = np.array([[1.0, 0.0]] * 1000 + [[0.0, 1.0]] * 2)
    frame = spark.createDataFrame(
        [(i, 100, p.tolist()) for i, p in enumerate(posterior)],
        "doc_id long, n_tokens long, posterior array<double>",
    ).repartition(3)
    weights = np.array([0.5, 0.5])
    kept = 100 * rates(posterior, *mixing.fit_rates(frame, weights)) @ posterior
    assert kept == pytest.approx([200, 200], rel=0.01)
    without = mixing.solve_rates(frame, weights, ignored=[1])
    assert without.converged and without.wanted.tolist() == [100_000, 100_000]
    assert without.reached == pytest.approx([100_000, 200], rel=0.01)
    given = mixing.solve_rates(frame, weights, total_tokens=1000)
    assert given.reached == pytest.approx([500, 200], rel=0.01)
    with pytest.raises(ValueError, match="ignore them or give total_tokens"):
        mixing.solve_rates(frame.where("doc_id < 1000"), weights)


def members_of(spark, posterior, tokens=100, parts=3):
    return spark.createDataFrame(
        [(i, tokens, p.tolist()) for i, p in enumerate(posterior)],
        "doc_id long, n_tokens long, posterior array<double>",
    ).repartition(parts)


def test_a_domain_of_one_in_ten_thousand(spark):
    # Posteriors as a classifier gives them: none is quite 0 or 1.
    posterior = np.array([[1 - 1e-6, 1e-6]] * 9999 + [[0.001, 0.999]])
    members, weights = members_of(spark, posterior), np.array([0.99, 0.01])
    have = 100 * posterior.sum(axis=0)
    once = mixing.solve_rates(members, weights)
    assert once.wanted.sum() == pytest.approx((have / weights).min())
    assert once.reached == pytest.approx(once.wanted, rel=0.02)
    often = mixing.solve_rates(members, weights, most_copies=120)
    assert often.wanted.sum() == pytest.approx(have.sum())  # the corpus does not shrink
    assert often.converged and often.reached == pytest.approx(often.wanted, rel=0.01)
    found = rates(posterior, often.gradients, often.momenta, 120)
    assert 90 < found[-1] <= 120 and found[:-1].max() < 1.01
    left_out = mixing.solve_rates(members, weights, ignored=[1])
    assert left_out.wanted.sum() == pytest.approx(have[0] / 0.99, rel=1e-6)


def test_totals_above_the_supply(spark):
    posterior = np.array([[1.0, 0.0]] * 100 + [[0.0, 1.0]] * 300)
    members, weights = members_of(spark, posterior), np.array([0.5, 0.5])
    given = mixing.solve_rates(members, weights, total_tokens=46_000, most_copies=3)
    assert given.converged and given.reached == pytest.approx([23_000, 23_000], rel=0.01)
    found = rates(posterior, given.gradients, given.momenta, 3)
    assert found[:100] == pytest.approx(2.3, rel=0.01) and found[100:] == pytest.approx(23 / 30, rel=0.01)
    most = mixing.solve_rates(members, weights, total_tokens=200_000, most_copies=3)
    assert most.reached == pytest.approx([30_000, 90_000], rel=0.01)


def test_written_rates_are_the_rates(spark, monkeypatch):
    rng = np.random.default_rng(5)
    posterior = rng.dirichlet([0.3] * 4, 150)
    members, weights = members_of(spark, posterior), np.array([0.1, 0.2, 0.3, 0.4])
    every = mixing.solve_rates(members, weights)
    monkeypatch.setattr(mixing, "REPLAY", 1000)
    plain = mixing.solve_rates(members, weights)
    assert len(every.gradients) > 12 and len(every.gradients) == len(plain.gradients)
    assert every.reached == pytest.approx(plain.reached, rel=1e-9)
    at_last = 100 * rates(posterior, every.gradients, every.momenta) @ posterior
    assert at_last == pytest.approx(every.reached, rel=1e-9)


def test_a_wanted_domain_without_labelled_rows(mixed):
    targets = {"en": 0.4, "de": 0.5, "xx": 0.1}
    with pytest.raises(ValueError, match=r"no labelled rows of the wanted domains \['xx'\]"):
        mixing.fit(mixed, mixed, "lang", targets)
    with pytest.raises(ValueError, match="xx"):
        mixing.fit(mixed, mixed, "lang", targets, total_tokens=100)
    mixer, _ = mixing.fit(mixed, mixed, "lang", targets, ignored=["xx"])
    want = mixer.report.wanted
    assert want["xx"] == 0 and want["de"] / want["en"] == pytest.approx(1.25)
    assert mixer.report.reached["de"] == pytest.approx(want["de"], rel=0.01)
    assert sum(mixer.report.reached.values()) > 1000
    none = mixing.fit(mixed, mixed, "lang", {"en": 1.0, "xx": 0.0})[0].report
    assert none.reached["en"] > 0


def test_documents_taken_more_than_once(spark, mixed):
    targets = {"en": 0.2, "de": 0.8}
    options = {"total_tokens": 12_000.0, "most_copies": 4.0}
    got = mixing.mix(mixed, mixed, "lang", targets, **options).collect()
    assert max(r.rate for r in got) > 1.2 and all(r.kept == (r.copies > 0) for r in got)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    taken = sum(r.n_tokens * r.copies * np.array(r.posterior) for r in got)
    assert taken / taken.sum() == pytest.approx([0.8, 0.2], abs=0.06)
    mixer, _ = mixing.fit(mixed, mixed, "lang", targets, **options)
    whole = mixing.keep_mixed(mixed, mixer).groupBy("doc_id").count().collect()
    want = {}
    for r in got:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert {r.doc_id: r["count"] for r in whole} == {i: n for i, n in want.items() if n}
    with pytest.raises(ValueError, match="at least 1"):
        mixing.fit(mixed, mixed, "lang", targets, most_copies=0.5)


def test_mix_against_plain_python(spark):
    """Posteriors, rates and draws of whole documents, worked out again from counts of words."""
    import xxhash

    rng = random.Random(12)
    rows = [(i, text(rng, OTHER if i % 4 == 0 else GOOD), "de" if i % 4 == 0 else "en")
            for i in range(300)]
    rows += [(400, None, None), (401, "no such words", None), (402, rows[0][1] * 40, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    targets, labelled = {"en": 0.5, "de": 0.5}, docs.where("doc_id < 200")
    mixer, _ = mixing.fit(docs, labelled, "lang", targets)
    buckets = mixing.BUCKETS

    def places(t):
        return [xxhash.xxh3_64_intdigest(w) % buckets for w in (t or "").lower().encode().split()]

    counts = np.zeros((2, buckets))
    for i, t, lang in rows:
        if i < 200:
            np.add.at(counts[["de", "en"].index(lang)], places(t), 1)
    pool = (counts.sum(axis=0) + 1) / (counts.sum() + buckets)
    likely = np.log((counts + 50 * pool) / (counts.sum(axis=1, keepdims=True) + 50))
    shares = np.array([51, 151]) / 202
    got = {r.doc_id: r for r in mixing.mix(docs, labelled, "lang", targets).collect()}
    for i, t, _ in rows:
        found = places(t)
        logit = np.log(shares)
        if found:
            logit = logit + likely[:, found].mean(axis=1) * len(found) / (1 + len(found) / mixing.EVIDENCE)
        posterior = np.exp(logit - logit.max())
        posterior /= posterior.sum()
        rate = before = 1.0
        for g, m in zip(mixer.gradients, mixer.momenta, strict=True):
            rate, before = min(1.0, max(0.0, rate + m * (rate - before) - posterior @ g)), rate
        drawn = xxhash.xxh3_64_intdigest(f"mix {i}") / 2.0**64
        assert got[i].posterior == pytest.approx(posterior.tolist(), abs=1e-9)
        assert got[i].n_tokens == len(found) and got[i].rate == pytest.approx(rate, abs=1e-9)
        assert got[i].kept == (drawn < rate) and got[i].copies == int(drawn < rate)


def test_mixer_reports_what_it_reaches(mixed):
    mixer, _ = mixing.fit(mixed, mixed, "lang", {"en": 0.4, "de": 0.6})
    assert mixer.report.converged and not mixer.report.missed() and not mixer.report.ignored
    assert mixer.report.reached == pytest.approx(mixer.report.wanted, rel=0.01)


def test_mixing_edges(spark, mixed):
    empty = mixed.limit(0)
    assert mixing.mix(empty, empty, "lang", {"en": 1.0}).collect() == []
    got = mixing.mix(mixed, empty, "lang", {"en": 0.5, "de": 0.5}).collect()
    assert {tuple(r.posterior) for r in got} == {(0.5, 0.5)}


def page(rng, words, declared=None):
    lang = f' lang="{declared}"' if declared else ""
    return (f"<!DOCTYPE html><html{lang}><head><script>var der = 'die';</script></head><body>"
            f"<p>{text(rng, words)}</p><!-- x --></body></html>")  # fmt: skip


def test_language_of_pages(spark, mixed):
    rng = random.Random(8)
    rows = []
    for i in range(240):
        german = i % 4 == 0
        declared = rng.choice(["de" if german else "en"] * 4 + [None, "xx-long"])
        host = f"www.{'h%d' % (i % 4)}.example.{'de' if german else 'com'}"
        rows.append((i, f"http://{host}/{'de' if german else 'en'}/{i}?q=1",
                     page(rng, OTHER if german else GOOD, declared)))
    # No text at all: declaration, suffix and host have to say it.
    rows += [(500, "http://www.h0.example.de/de/x", '<html lang="de"></html>'), (501, None, None),
             (502, "no address", ""), (None, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(
        [(*r, "x") for r in rows], "page_id long, url string, html string, language string"
    ).repartition(3)
    got = language_id.identify(pages, mixed, mixed).collect()
    assert len(got) == len(rows)
    said = {r.page_id: r for r in got}
    assert np.mean([(said[i].language == "de") == (i % 4 == 0) for i in range(240)]) > 0.98
    assert said[500].language == "de" and said[500].host == "www.h0.example.de"
    assert all(0.5 <= r.confidence <= 1 for r in got)
    assert language_id.identify(pages.limit(0), mixed, mixed).collect() == []
    nothing = language_id.identify(pages, mixed, mixed.limit(0))
    assert {r.language for r in nothing.collect()} == {None}


def test_long_suffixes_and_codes_are_evidence(spark, mixed, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        german = i % 2 == 0
        suffix = ("berlin", "xn--p1ai")[i // 2 % 2] if german else ("online", "info")[i // 2 % 2]
        rows.append((i, f"http://h{i}.{suffix}/", page(rng, OTHER if german else GOOD,
                                                      "deutsch" if german else "english")))
    rows += [(500, "http://x.berlin/", ""), (501, "http://y.online/", ""),
             (502, "http://z.xn--p1ai/", ""), (503, "http://w.info/", ""),
             (504, None, '<html lang="deutsch">'), (505, None, '<html lang="english">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    expected = {500: "de", 501: "en", 502: "de", 503: "en", 504: "de", 505: "en"}
    for most in (200_000, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(language_id, "BROADCAST_ROWS", most, raising=False)
        got = language_id.identify(pages, mixed, mixed).collect()
        assert len(got) == len(rows)
        said = {r.page_id: r.language for r in got}
        assert {i: said[i] for i in expected} == expected
    assert language_id.declared_language(b"<html lang=deutsch>") == "deutsch"


def test_rare_classes_are_in_the_sample(spark, monkeypatch):
    rows = [(i, "en" if i % 500 else "fr", "the water" if i % 500 else "eau") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    sample = bayes.labelled_sample(docs, "lang", most=50)
    got = [r["class"] for r in sample.collect()]
    assert got.count("fr") == 4 and got.count("en") == 46
    found, shares, _ = bayes.fit(docs, sample, None, bayes.word_features(64), 64)
    assert found == ["en", "fr"]
    assert np.exp(shares) == pytest.approx([1997 / 2002, 5 / 2002])
    monkeypatch.setattr(bayes, "MOST_CLASSES", 1)
    with pytest.raises(ValueError, match="more than 1 classes"):
        bayes.labelled_sample(docs, "lang")


def test_visible_text():
    html = b"<html lang='fr'><style>p{}</style><p>l&eacute;ger<br>a &lt; b</p><!-- no --></html>"
    assert language_id.visible_text(html).decode().split() == ["léger", "a", "<", "b"]
    assert language_id.declared_language(html) == "fr"
