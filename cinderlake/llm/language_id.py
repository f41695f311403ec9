"""Language of web pages by fusing evidence.

Four kinds of evidence are multiplied: the likelihood of the visible text (byte trigrams, learned from a
bounded labelled sample of documents), the language the markup declares, the address suffix (the
host's last label, and a language code at the head of the path), and a prior of the host.
How far declarations and suffixes can be trusted is not assumed: grouped sums of the pages'
text posteriors say how often each value goes with each language. The host's prior is the
mean posterior of its other pages, leaning on the prior of its domain, which leans on that
of all pages, so small hosts borrow from their domain.

Declarations and suffixes are kept whole. Their tables are broadcast while they are small and else
joined by shuffle as hosts are; adaptive execution splits a value or host that holds many pages.

Pages are read in time that grows with their length, however broken they are.

Defined results: a NULL or empty page has no text evidence; comments, scripts and tags that are never
closed are text; what stands before an @ is no part of the host; a NULL or odd address has host "" and
suffix "?", and so has a last label without a letter; a NULL page_id stays NULL; repeated rows are judged each and count each;
without labelled documents there is no language to choose and it is NULL; an empty table
gives an empty table; only page_id, url and html are looked at.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.llm import bayes
from cinderlake.llm.common import BROADCAST_ROWS, blocks_of, text_bytes
from cinderlake.workspace import materialize

BUCKETS = 1 << 15
EVIDENCE = 60.0
HOST_STRENGTH = 5.0
DOMAIN_STRENGTH = 20.0
_TABLE_STRENGTH = 2.0
_OPENS = re.compile(rb"<!--|<(script|style|noscript)\b", re.I)
_CLOSES = {
    name: re.compile(rb"</%s\s*>" % name, re.I) for name in (b"script", b"style", b"noscript")
}
_CLOSES[b"!--"] = re.compile(rb"-->")
_TAG = re.compile(rb"<[a-zA-Z/!?][^>]*>")
_HTML = re.compile(rb"<html\b", re.I)
_LANG = re.compile(rb"\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)
# More digits than Python turns into a number; no character has such a one.
_ENDLESS = re.compile(r"&#[0-9]{4000,};?")


def _shown(page: bytes) -> bytes:
    """A page with a space for every comment and for all between a tag that hides its content and its end.

    One walk from opening to opening. What is never closed hides nothing, and is looked for once.
    """
    parts, at, open_ended = [], 0, set()
    opening = _OPENS.search(page)
    while opening:
        name = (opening.group(1) or b"!--").lower()
        closing = None if name in open_ended else _CLOSES[name].search(page, opening.end())
        if closing:
            parts.append(page[at : opening.start()])
            at = closing.end()
        else:
            open_ended.add(name)
        opening = _OPENS.search(page, at if closing else opening.end())
    return b" ".join([*parts, page[at:]])


def visible_text(page: bytes) -> bytes:
    text = _shown(page)
    last = text.rfind(b">") + 1  # no tag ends behind it
    text = _TAG.sub(b" ", text[:last]) + text[last:]
    if b"&" in text:
        text = html.unescape(_ENDLESS.sub("\ufffd", text.decode("utf-8", "replace"))).encode()
    return text


def declared_language(page: bytes) -> str:
    """The code of the first html tag that declares one, "" without."""
    searched = 0
    for tag in _HTML.finditer(page):
        if tag.end() < searched:
            continue  # the end of the tag before is the end of this one, and nothing was there
        end = page.find(b">", tag.end())
        end = len(page) if end < 0 else end
        found = _LANG.search(page, tag.end(), end)
        if found:
            return found.group(1).decode().lower()
        searched = end
    return ""


def _suffix(host: Column) -> Column:
    last = F.substring_index(host, ".", -1)
    return F.when(last.rlike(r"\p{L}"), last).otherwise(F.lit("?"))


def _address(url: Column) -> dict[str, Column]:
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z]+://(?:[^/?#]*@)?([^/?#:@]+)", 1)
    path = F.regexp_extract(
        F.lower(F.coalesce(url, F.lit(""))), r"^[a-z]+://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1
    )
    # The domain is the host without its first label, if two labels are left.
    domain = F.regexp_extract(host, r"^[^.]+\.([^.]+\..+)$", 1)
    return {
        "host": host,
        "domain": F.when(domain == "", host).otherwise(domain),
        "suffix": _suffix(host),
        "path_code": path,
    }


def _read_pages(pages: DataFrame, table: np.ndarray) -> DataFrame:
    """page_id, host, domain, suffix, path_code, declared, likely (array by language)."""
    shared = pages.sparkSession.sparkContext.broadcast(table)
    names = ["page_id", "host", "domain", "suffix", "path_code"]
    kinds = "page_id long, host string, domain string, suffix string, path_code string"

    def run(batches):
        read, likely = bayes.trigram_features(BUCKETS)(), shared.value
        for block in blocks_of(batches, lambda r: len(r[-1]), *names, "html"):
            *columns, pages_ = zip(*block, strict=True)
            found = [bayes.evidence(read(visible_text(p)), likely, EVIDENCE) for p in pages_]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    *[pa.array(c, pa.string()) for c in columns[1:]],
                    pa.array([declared_language(p) for p in pages_], pa.string()),
                    pa.array([(f - f.max()).tolist() for f in found], pa.list_(pa.float64())),
                ],
                names=[*names, "declared", "likely"],
            )

    given = pages.select("page_id", *[c.alias(n) for n, c in _address(F.col("url")).items()],
                         text_bytes("html"))
    return given.mapInArrow(run, kinds + ", declared string, likely array<double>")


def _normal(values: list[Column]) -> list[Column]:
    total = sum(values[1:], values[0])
    return [v / total for v in values]


def identify(pages: DataFrame, docs: DataFrame, labels: DataFrame, label: str = "lang") -> DataFrame:
    """page_id, language, confidence, text_language, declared, host: a row per row of ``pages``.

    ``labels`` has doc_id and ``label``, ``docs`` their texts.
    """
    sample = materialize(bayes.labelled_sample(labels, label), "sample")
    languages, _, table = bayes.fit(docs, sample, None, bayes.trigram_features(BUCKETS), BUCKETS)
    if not languages:
        none = F.lit(None).cast("string")
        return pages.select(
            F.col("page_id").cast("long"), none.alias("language"),
            F.lit(None).cast("double").alias("confidence"), none.alias("text_language"),
            none.alias("declared"), _address(F.col("url"))["host"].alias("host"),
        )
    every = range(len(languages))
    read = _read_pages(pages, table)
    odds = _normal([F.exp(F.col("likely")[k]) for k in every])
    read = materialize(
        read.select(
            "page_id", "host", "domain", "suffix", "path_code", "declared",
            *[F.col("likely")[k].alias(f"l{k}") for k in every],
            *[odds[k].alias(f"q{k}") for k in every],
        ),
        "page-evidence",
    )
    sums = [F.sum(f"q{k}").alias(f"s{k}") for k in every]
    overall = read.agg(F.count("*").alias("n"), *sums).first()
    n = max(1, overall["n"])
    share = [((overall[f"s{k}"] or 0.0) + 1) / (n + len(languages)) for k in every]

    scored = read
    # How often a value goes with a language: log of P(value | language) up to what all share.
    for column in ("declared", "suffix", "path_code"):
        counted = read.groupBy(column).agg(F.count("*").alias("m"), *sums)
        logs = [
            F.log(
                (F.col(f"s{k}") + _TABLE_STRENGTH * F.col("m") / n)
                / (share[k] * n + _TABLE_STRENGTH)
            ).alias(f"{column}{k}")
            for k in every
        ]
        said = materialize(counted.select(column, *logs), f"{column}-evidence")
        few = said.count() * len(languages) <= BROADCAST_ROWS
        scored = scored.join(F.broadcast(said) if few else said, column)

    hosts = read.groupBy("domain", "host").agg(F.count("*").alias("host_n"), *sums)
    domains = hosts.groupBy("domain").agg(
        F.sum("host_n").alias("domain_n"), *[F.sum(f"s{k}").alias(f"d{k}") for k in every]
    )
    hosts = hosts.join(domains, "domain").select(
        "host", "host_n",
        *[F.col(f"s{k}").alias(f"h{k}") for k in every],
        *[
            ((F.col(f"d{k}") + DOMAIN_STRENGTH * share[k])
             / (F.col("domain_n") + DOMAIN_STRENGTH)).alias(f"p{k}")
            for k in every
        ],
    )
    scored = scored.join(hosts, "host")
    logits = [
        F.log(
            (F.greatest(F.col(f"h{k}") - F.col(f"q{k}"), F.lit(0.0))
             + HOST_STRENGTH * F.col(f"p{k}")) / (F.col("host_n") - 1 + HOST_STRENGTH)
        )
        + F.col(f"l{k}") + F.col(f"declared{k}") + F.col(f"suffix{k}") + F.col(f"path_code{k}")
        for k in every
    ]
    named = [
        F.struct(v.alias("v"), (-F.lit(k)).alias("first"), F.lit(name).alias("name"))
        for k, (v, name) in enumerate(zip(logits, languages, strict=True))
    ]
    texts = [
        F.struct(F.col(f"l{k}").alias("v"), (-F.lit(k)).alias("first"), F.lit(name).alias("name"))
        for k, name in enumerate(languages)
    ]
    best = scored.select(
        "page_id", "declared", "host", F.array(*named).alias("all"),
        F.array_max(F.array(*texts))["name"].alias("text_language"),
    )
    top = F.array_max("all")
    rest = F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x["v"] - top["v"]))
    return best.select(
        "page_id", top["name"].alias("language"), (1 / rest).alias("confidence"),
        "text_language", "declared", "host",
    )
