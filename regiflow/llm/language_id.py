"""Operator 6: language of web pages by Bayesian fusion of independent evidence.

* text: a naive Bayes model of hashed byte trigrams, trained on all labelled
  documents; its evidence is tempered to that of ``EVIDENCE`` trigrams, since
  neighbouring trigrams are not independent;
* markup: the declared language, with P(declared | language) estimated from all
  pages, so a declaration counts as much as it proves reliable;
* address: a prior of the host, smoothed hierarchically towards its domain, its
  suffix and all pages.  The sums are grouped aggregates of the pages' own text
  posteriors; each page's own share is taken out of its host's sum.

The trained tables have a fixed bound (buckets x languages, declared values x
languages) and go to every task; hosts do not and are joined.

Defined cases: null or empty pages have no text evidence; a missing or unusable
address is the host ``""``; undeclared or unknown languages are classes of their
own (``none``, ``other``); repeated pages are rows of their own; null languages or
ones not in ``LANGUAGES`` do not train.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B
from regiflow.llm.graph import saved_table

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 14
EVIDENCE, SMOOTH = 100, 10.0

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style|nav)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,3})|"
                       r"<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)


def visible(page: str | None) -> str:
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def declared(page: str | None, languages) -> str:
    m = _DECLARED.search(page or "")
    code = (m[1] or m[2]).lower() if m else "none"
    return code if code in languages or code == "none" else "other"


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#\s]+)", url or "")
    return m[1].lower().rstrip(".") if m else ""


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all byte trigrams, text of each); texts are lower-cased."""
    data, at = B.text_bytes(pa.chunked_array([pa.array([" " + t.lower() + " " for t in texts], pa.string())]))
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = data.astype(np.uint64)
    h = B.mix(x[:-2] * np.uint64(65536) + x[1:-1] * np.uint64(256) + x[2:]) % np.uint64(BUCKETS)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    inside = doc[:-2] == doc[2:]
    return h[inside].astype(np.int64), doc[:-2][inside]


def train(docs: DataFrame, languages=LANGUAGES, text: str = "text", lang: str = "lang") -> np.ndarray:
    """log P(trigram bucket | language), languages x BUCKETS, from all rows in one of the languages."""
    def count(batches):
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            for part in range(0, len(b), 512):
                rows = b.slice(part, 512)
                h, doc = trigrams([t or "" for t in rows.column("text").to_pylist()])
                own = np.array([languages.index(x) for x in rows.column("lang").to_pylist()], np.int64)
                total += np.bincount(own[doc] * BUCKETS + h, minlength=total.size).reshape(total.shape)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[at, bucket], pa.int64())],
                                         ["l", "bucket", "n"])

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(F.col("lang").isin(*languages))
    sums = rows.mapInArrow(count, "l int, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n"))
    n = np.full((len(languages), BUCKETS), 0.5)
    for r in sums.collect():                          # at most languages x BUCKETS rows
        n[r["l"], r["bucket"]] += r["n"]
    return np.log(n / n.sum(axis=1, keepdims=True))


def identify(pages: DataFrame, docs: DataFrame, languages=LANGUAGES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every page with ``lang``, its ``posterior``, and the single pieces of evidence."""
    spark, names = pages.sparkSession, list(languages)
    model = spark.sparkContext.broadcast(train(docs, names).T.copy())

    def read(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                b = batch.slice(at, 256)
                source = b.column("html").to_pylist()
                texts = [visible(x) for x in source]
                h, doc = trigrams([t if t.strip() else "" for t in texts])
                n = np.bincount(doc, minlength=len(b))
                ll = np.stack([np.bincount(doc, model.value[h, k], len(b)) for k in range(len(names))], axis=1)
                ll *= np.minimum(1, EVIDENCE / np.maximum(n, 1))[:, None]
                ll[[not t.strip() for t in texts]] = 0
                p = np.exp(ll - ll.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                host = [host_of(u) for u in b.column("url").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    b.column("page_id"), pa.array([declared(x, names) for x in source]), pa.array(host),
                    pa.array([".".join(x.split(".")[-2:]) for x in host]), pa.array([x.rpartition(".")[2] for x in host]),
                    pa.array(list(ll), pa.list_(pa.float64())), pa.array(list(p), pa.list_(pa.float64()))],
                    ["page_id", "declared_lang", "host", "domain", "suffix", "ll", "p"])

    kind = pages.schema[page_id].dataType.simpleString()
    seen = saved_table(pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")).mapInArrow(
        read, f"page_id {kind}, declared_lang string, host string, domain string, suffix string, ll array<double>, p array<double>"))

    L = len(names)
    sums = [F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(L)]
    total = lambda: sum((F.col(f"s{k}") for k in range(1, L)), F.col("s0"))

    # P(declared | language), at most (languages + 2) rows
    said = {r["declared_lang"]: [r[f"s{k}"] for k in range(L)] for r in seen.groupBy("declared_lang").agg(*sums).collect()}
    values = [*names, "other", "none"]
    table = np.array([said.get(v, [0.0] * L) for v in values]) + 0.5
    table = np.log(table / table.sum(axis=0))
    markup = F.array(*[F.coalesce(*[F.when(F.col("declared_lang") == v, F.lit(float(table[i, k]))) for i, v in enumerate(values)]) for k in range(L)])

    # all pages -> suffix -> domain -> host
    hosts = seen.groupBy("host", "domain", "suffix").agg(F.count("*").alias("n"), *sums)
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(L)]
    overall = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.coalesce(x, F.lit(0.0)).alias(f"s{k}") for k, x in enumerate(again)]).first()
    root = [(overall[f"s{k}"] + 1) / (overall["n"] + L) for k in range(L)]

    def level(rows: DataFrame, keys: list[str], name: str, above: list) -> DataFrame:
        got = rows.groupBy(*keys).agg(F.sum("n").alias("n"), *again)
        return got.select(*keys, F.array(*[(F.col(f"s{k}") + SMOOTH * a) / (F.col("n") + SMOOTH) for k, a in enumerate(above)]).alias(name))

    by_suffix = level(hosts, ["suffix"], "p_suffix", [F.lit(x) for x in root])
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), *again).join(by_suffix, "suffix")
    by_domain = domains.select("domain", "suffix", F.array(*[(F.col(f"s{k}") + SMOOTH * F.col("p_suffix")[k]) / (F.col("n") + SMOOTH) for k in range(L)]).alias("p_domain"))
    by_host = hosts.join(by_domain, ["domain", "suffix"]).select("host", F.col("n").alias("host_pages"), F.array(*[F.col(f"s{k}") for k in range(L)]).alias("s"), "p_domain")

    x = seen.join(by_host, "host")
    prior = [F.greatest(F.col("s")[k] - F.col("p")[k] + SMOOTH * F.col("p_domain")[k], F.lit(1e-12)) / (F.col("host_pages") - 1 + SMOOTH) for k in range(L)]
    x = x.withColumn("log_prior", F.array(*[F.log(v) for v in prior])).withColumn("markup", markup)
    x = x.withColumn("w", F.array(*[F.col("ll")[k] + F.col("markup")[k] + F.col("log_prior")[k] for k in range(L)]))
    best = F.array_max("w")
    return x.select("page_id", "host", "declared_lang", F.element_at(F.array(*map(F.lit, names)), F.array_position("p", F.array_max("p")).cast("int")).alias("text_lang"),
                    F.element_at(F.array(*map(F.lit, names)), F.array_position("w", best).cast("int")).alias("lang"),
                    (F.lit(1.0) / F.aggregate("w", F.lit(0.0), lambda a, v: a + F.exp(v - best))).alias("posterior"))
