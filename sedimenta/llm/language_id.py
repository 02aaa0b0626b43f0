"""Language of a text by Bayesian evidence fusion.

Four kinds of evidence add up as logarithms: how likely the text's letter trigrams are
in each language (naive Bayes, counted over all texts with a declared language), the
declared markup language, and a prior for the host that is smoothed towards the prior
of its address suffix, which is smoothed towards all rows. A class for texts unlike
every language has a uniform trigram model.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import Scratch, fresh, quoted, ready, refuse_taken, slices, text_of, utf8

#: Trigrams are hashed to so many buckets; the model has one number for each and language.
BUCKETS = 1 << 14
#: So many declared languages, those declared most often, have a model, which is held in
#: memory (128 KB each). ISO 639-1 names 183; what lies beyond are stray labels.
MAX_LANGUAGES = 256

#: Columns that the result has beside those of the input.
RESULTS = ("language", "probability", "accepted")

_CLASS = np.zeros(256, np.uint32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:256] = np.arange(27, 155)


def trigram_buckets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bucket for each byte's trigram, ``BUCKETS`` where there is none: at the end of a
    text, or three bytes without a letter. Digits, marks and blanks are all alike."""
    n = len(data)
    out = np.full(n, BUCKETS, np.int64)
    if n < 3:
        return out
    c = _CLASS[data]
    code = (c[:-2] * np.uint32(155) + c[1:-1]) * np.uint32(155) + c[2:]
    some = code > 0
    code = (code * np.uint32(2654435761)) >> np.uint32(18)
    out[:-2] = np.where(some, code, BUCKETS)
    ends = offsets[1:]
    for back in (1, 2):
        at = ends - back
        out[at[(at >= offsets[:-1]) & (at >= 0)]] = BUCKETS
    return out


def _count_trigrams(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + 1), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            which = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
            for a, b in slices(offsets):
                part = offsets[a : b + 1] - offsets[a]
                bucket = trigram_buckets(data[offsets[a] : offsets[b]], part)
                row = np.repeat(which[a:b], np.diff(part))
                flat = np.bincount(row * (BUCKETS + 1) + bucket, minlength=total.size)
                total += flat.reshape(total.shape)
        row, bucket = np.nonzero(total[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[row, bucket])],
            names=["language", "bucket", "n"],
        )

    return run


def language_label(declared: Column) -> Column:
    """A declaration without case, region and script: ``en`` for ``EN``, ``en-GB``, ``en_us``;
    NULL if nothing is left of it."""
    return F.nullif(F.trim(F.split(F.lower(declared.cast("string")), "[-_]")[0]), F.lit(""))


def declared_most(docs: DataFrame, declared: Column, most: int) -> list[str]:
    """The labels that are declared most often, ties by name; at most ``most``."""
    counts = docs.select(declared.alias("label")).filter("label IS NOT NULL").groupBy("label").count()
    return sorted(r["label"] for r in counts.orderBy(F.desc("count"), "label").limit(most).collect())


def fit_trigrams(
    docs: DataFrame, text_col: str, declared: Column, languages: list[str], alpha: float = 0.5
) -> np.ndarray:
    """Log-likelihoods, languages by buckets, from every text with one of the languages.

    The result has ``BUCKETS`` numbers for each language whatever the input.
    """
    ready(docs.sparkSession)
    labelled = docs.filter(declared.isin(languages)).select(
        declared.alias("language"), F.lower(text_of(docs, text_col)).alias("text")
    )
    counts = (
        labelled.mapInArrow(_count_trigrams(languages), "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    table = np.zeros((len(languages), BUCKETS))
    table[counts["language"].to_numpy(), counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    table += alpha
    return np.log(table / table.sum(axis=1, keepdims=True))


def text_scores(model: np.ndarray):
    """UDF: a text's log-likelihood in each language and, last, its number of trigrams."""
    weights = np.concatenate([model, np.zeros((len(model), 1))], axis=1).astype(np.float32)

    def score(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column)
        out = np.zeros((len(column), len(weights) + 1))
        for a, b in slices(offsets):
            part = offsets[a : b + 1] - offsets[a]
            if part[-1] == 0:
                continue
            bucket = trigram_buckets(data[offsets[a] : offsets[b]], part)
            full = np.flatnonzero(np.diff(part))
            for k, row in enumerate(weights):
                out[a + full, k] = np.add.reduceat(row[bucket], part[full], dtype=np.float64)
            out[a + full, -1] = np.add.reduceat((bucket < BUCKETS).astype(np.int64), part[full])
        places = np.arange(len(column) + 1, dtype=np.int32) * out.shape[1]
        return pa.ListArray.from_arrays(pa.array(places), pa.array(out.ravel()))

    score.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, "array<double>")


def address_host(url: Column) -> Column:
    """Host of a URL in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def address_suffix(host: Column) -> Column:
    """Last part of a host's name, as ``fr`` or ``com``; empty if it has no dot."""
    return F.regexp_extract(host, r"\.([a-z]+)$", 1)


def markup_language(html: Column) -> Column:
    """What the ``html`` element declares, without a region: ``pt`` for ``pt-BR``."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    return F.nullif(F.lower(found), F.lit(""))


def host_priors(
    docs: DataFrame, host: Column, suffix: Column | None, declared: Column, languages: list[str], weight: float
) -> DataFrame:
    """``host``, ``prior`` (one probability per language): host, suffix and all rows
    as levels, each smoothed by ``weight`` rows of the level above. Without suffixes all
    hosts have the same one."""
    n = len(languages)
    count = [F.sum(F.when(declared == x, 1).otherwise(0)).alias(f"n{i}") for i, x in enumerate(languages)]
    level = [] if suffix is None else [suffix.alias("suffix")]
    hosts = docs.groupBy(host.alias("host"), *level).agg(*count)
    sums = [F.sum(f"n{i}").alias(f"s{i}") for i in range(n)]
    suffixes = hosts.groupBy(*["suffix" for _ in level]).agg(*sums)
    everything = suffixes.agg(*[F.sum(f"s{i}") for i in range(n)]).first()
    whole = [(x or 0) + 1.0 for x in everything]
    base = [x / sum(whole) for x in whole]

    def smooth(names: list[str], parent: list[Column]) -> list[Column]:
        size = sum((F.col(x) for x in names), F.lit(0))
        return [(F.col(x) + weight * p) / (size + weight) for x, p in zip(names, parent, strict=True)]

    if suffix is None:
        known = [x or 0 for x in everything]
        one = [F.lit((x + weight * p) / (sum(known) + weight)) for x, p in zip(known, base, strict=True)]
        return hosts.select("host", F.array(*smooth([f"n{i}" for i in range(n)], one)).alias("prior"))
    by_suffix = suffixes.select(
        "suffix", F.array(*smooth([f"s{i}" for i in range(n)], [F.lit(p) for p in base])).alias("up")
    )
    prior = F.array(*smooth([f"n{i}" for i in range(n)], [F.col("up")[i] for i in range(n)]))
    return hosts.join(by_suffix, "suffix").select("host", prior.alias("prior"))


def identify_language(
    docs: DataFrame,
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
    suffix_col: str | None = None,
    languages: list[str] | None = None,
    max_languages: int = MAX_LANGUAGES,
    trust: float = 0.9,
    smoothing: float = 20.0,
    text_weight: float = 50.0,
    unlike: float = 1e-3,
    min_probability: float = 0.5,
) -> DataFrame:
    """``docs`` with ``language``, ``probability`` and ``accepted``.

    Declarations count without case and region (``language_label``). ``languages`` are those
    declared anywhere, unless given; of more than ``max_languages`` those declared most often,
    and other labels are unknown declarations. ``trust`` is the probability that a declaration
    is right; a missing or unknown one is no evidence. A text of n
    trigrams counts as ``n * text_weight / (n + text_weight)`` independent ones. A row is
    rejected (``accepted`` false) if its text has no trigram of letters (NULL and empty
    texts too), if it is unlike every language, or if the best has less than
    ``min_probability``; its ``language`` is NULL then. No row is dropped; NULL hosts
    are one host. Texts are gone through whole, a mebibyte or a text at a time. Result columns must not be there already; other names may clash.
    """
    refuse_taken(docs, *RESULTS)
    spark = docs.sparkSession
    ready(spark)
    declared = language_label(quoted(declared_col))
    if languages is None:
        languages = declared_most(docs, declared, max_languages)
    else:
        languages = sorted({re.split("[-_]", x.lower())[0].strip(" ") for x in languages} - {""})
    if not languages:
        return docs.withColumns(
            {"language": F.lit(None).cast("string"), "probability": F.lit(0.0), "accepted": F.lit(False)}
        )
    model = fit_trigrams(docs, text_col, declared, languages)
    host_name, prior_name, score_name, sum_name = fresh(docs, "host", "prior", "score", "sums")
    host = F.coalesce(quoted(host_col).cast("string"), F.lit(""))
    suffix = F.coalesce(quoted(suffix_col).cast("string"), F.lit("")) if suffix_col else None
    scratch = Scratch(spark, "hosts")
    priors = scratch.keep(host_priors(docs, host, suffix, declared, languages, smoothing))
    scored = docs.withColumns(
        {host_name: host, score_name: text_scores(model)(F.lower(text_of(docs, text_col)))}
    )
    joined = scored.join(priors.toDF(host_name, prior_name), host_name, "left")
    score = quoted(score_name)
    n = F.get(score, F.lit(len(languages)))
    scale = text_weight / (n + text_weight)
    other = math.log((1 - trust) / max(len(languages) - 1, 1)) if trust < 1 else -50.0

    def evidence(i: int, name: str) -> Column:
        said = F.when(declared == name, math.log(trust)).when(declared.isin(languages), other).otherwise(0.0)
        return F.get(score, F.lit(i)) * scale + said + F.log(F.get(quoted(prior_name), F.lit(i)))

    # the class for other texts: any trigram is as likely as any, and so is any declaration
    none = n * scale * math.log(1 / BUCKETS) - math.log(len(languages)) + math.log(unlike)
    classes = [F.struct(evidence(i, x).alias("log"), F.lit(x).alias("name")) for i, x in enumerate(languages)]
    classes.append(F.struct(none.alias("log"), F.lit(None).cast("string").alias("name")))
    fused = joined.withColumn(sum_name, F.array(*classes))
    best = F.array_max(quoted(sum_name))
    total = F.aggregate(quoted(sum_name), F.lit(0.0), lambda acc, x: acc + F.exp(x["log"] - best["log"]))
    probability = 1 / total
    accepted = F.coalesce((n > 0) & best["name"].isNotNull() & (probability >= min_probability), F.lit(False))
    return fused.select(
        *[quoted(c) for c in docs.columns],
        F.when(accepted, best["name"]).alias("language"),
        probability.alias("probability"),
        accepted.alias("accepted"),
    )
