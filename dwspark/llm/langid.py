"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are combined for every page: the likelihood of its visible text under byte
trigram models, the language that its markup declares, the suffix of its address (a path segment or a
country domain), and the prior of its host. The priors are hierarchically smoothed: a host's counts of
text languages are shrunk towards its parent domain's, those towards the whole table's; the reliability
of declarations and suffixes is estimated from all pages as well, by grouped aggregation.

The trigram models are fitted on a bounded sample of labelled documents (``sample`` of them, those of the
least hashed ids); every page counts everywhere else. The driver holds the models (languages x buckets
numbers) and a table of (language x evidence value) counts, both bounded by ``max_languages``.

Defined results: null and empty markup has no text evidence (its likelihoods are equal); a null address
has host '' and no suffix; a page without any evidence gets the host's prior; ties go to the smaller
language code; repeated pages are classified each; an empty table gives an empty result, and without
labelled documents the language is null; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import save
from dwspark.llm.textbytes import LOWER, chunks, column

BUCKETS = 1 << 15
SAMPLE = 4000
MAX_LANGUAGES = 64
SEED = 5
STRENGTH = 8.0  # pages' worth of belief that a parent lends to a host or domain
TEMPER = 0.05  # trigrams overlap and depend on each other, so their evidence is weighed down
# Country domains that speak for one language.
COUNTRIES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "au": "en",
             "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "kr": "ko"}

HIDDEN = r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)"
SKIP = re.compile(HIDDEN + r"|<[^>]*+(?:>|(?P<open>\Z))", re.S | re.I)


def without_markup(html: str) -> str:
    """The text between the tags, in one pass. A ``<`` without a ``>`` anywhere after it is text."""
    kept = lambda m: " " if m["open"] is None else re.sub(HIDDEN, " ", m[0], flags=re.S | re.I)
    return SKIP.sub(kept, html)


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte trigram inside a text, and its text. Anything but letters counts as a space."""
    low = LOWER[data].astype(np.int64)
    low[(low < 97) | ((low > 122) & (low < 128))] = 32
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = (text[:-2] == text[2:]) & (code != 0x202020)
    return ((code[inside] * 0x9E3779B1) >> 12) & (BUCKETS - 1), text[:-2][inside]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column(batch.column("text"))
        lang = np.array(batch.column("lang").to_pylist(), dtype=object)
        for i, j in chunks(offsets):
            bucket, text = _buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            frame = pd.DataFrame({"lang": lang[i + text], "bucket": bucket})
            frame = frame.groupby(["lang", "bucket"], sort=False).size().reset_index(name="n")
            yield pa.RecordBatch.from_pandas(frame, pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())]), preserve_index=False)


def fit(labelled: DataFrame, sample: int = SAMPLE, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the logarithm of each bucket's smoothed share by language."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.lower("lang").alias("lang"), "text")
    # The sample's ids are chosen without the texts, which then come by a join with at most ``sample`` rows.
    ids = save(rows.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample), "sample")
    chosen = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    found = chosen.select("lang", "text").mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.toPandas()  # at most languages x BUCKETS rows
    languages = sorted(found["lang"].unique())
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counts = np.full((len(languages), BUCKETS), 0.5)
    place = {x: i for i, x in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(np.int64), found["bucket"].to_numpy(np.int64)] += found["n"].to_numpy()
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def _likelihoods(model: np.ndarray):
    table = np.ascontiguousarray(model.T.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [entities.unescape(without_markup(x or "")) for x in part.column("html").to_pylist()]
                data, offsets = column(pa.array(texts, pa.string()))
                out = np.zeros((len(texts), table.shape[1]))
                for i, j in chunks(offsets):
                    bucket, text = _buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    if len(text):
                        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                        out[i + text[first]] = np.add.reduceat(table[bucket], first, axis=0, dtype=np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in ("page_id", "url", "host", "domain", "declared", "suffix")] + [pa.array(list(out), pa.list_(pa.float64()))],
                    ["page_id", "url", "host", "domain", "declared", "suffix", "likelihood"])

    return run


def _evidence(pages: DataFrame, languages: list[str]) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    known = F.array(*[F.lit(x) for x in languages])
    declared = F.lower(F.regexp_extract(F.coalesce(F.col("html"), F.lit("")), r"(?is)<html\b[^<>]*?\slang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    segments = F.filter(F.transform(F.split(path, "/"), lambda x: F.split(x, "[-_]")[0]), lambda x: F.array_contains(known, x))
    country = F.coalesce(*[F.when(F.endswith(host, F.lit(f".{c}")), F.lit(x)) for c, x in COUNTRIES.items()], F.lit(""))
    value = lambda c: F.when(c == "", "none").when(F.array_contains(known, c), c).otherwise("other")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"),
        F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1).alias("domain"), value(declared).alias("declared"),
        value(F.when(F.size(segments) > 0, F.get(segments, F.lit(0))).otherwise(country)).alias("suffix"), "html")


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def classify(
    pages: DataFrame, labelled: DataFrame, sample: int = SAMPLE, strength: float = STRENGTH, temper: float = TEMPER,
) -> DataFrame:
    """page_id, url, host, ``declared``, ``suffix``, ``text_lang``, ``lang`` and its ``probability``."""
    languages, model = fit(labelled, sample)
    if not languages:
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), "url", *[F.lit(None).cast("string").alias(c) for c in ("host", "declared", "suffix", "text_lang", "lang")],
            F.lit(None).cast("double").alias("probability"))
    n = range(len(languages))
    names = F.array(*[F.lit(x) for x in languages])
    schema = "page_id long, url string, host string, domain string, declared string, suffix string, likelihood array<double>"
    rows = save(_evidence(pages, languages).mapInArrow(_likelihoods(model), schema), "evidence")
    weighed = rows.withColumns({f"t{i}": F.col("likelihood")[i] * temper for i in n})
    shares = _softmax([F.col(f"t{i}") for i in n])
    rows = weighed.withColumns({f"q{i}": s for i, s in enumerate(shares)})

    # Counts of text languages, soft: a page without text adds the same to each.
    sums = [F.sum(f"q{i}").alias(f"n{i}") for i in n]
    hosts = save(rows.groupBy("host", "domain").agg(*sums), "hosts")
    domains = save(hosts.groupBy("domain").agg(*[F.sum(f"n{i}").alias(f"d{i}") for i in n]), "domains")
    everywhere = domains.agg(*[F.coalesce(F.sum(f"d{i}"), F.lit(0.0)).alias(f"g{i}") for i in n]).first()
    whole = sum(everywhere) + len(languages)
    prior = [(everywhere[i] + 1.0) / whole for i in n]
    total = lambda p: sum((F.col(f"{p}{i}") for i in range(1, len(languages))), F.col(f"{p}0"))
    domains = domains.select("domain", *[((F.col(f"d{i}") + strength * prior[i]) / (total("d") + strength)).alias(f"d{i}") for i in n])
    priors = save(hosts.join(domains, "domain").select(
        "host", *[F.log((F.col(f"n{i}") + strength * F.col(f"d{i}")) / (total("n") + strength)).alias(f"p{i}") for i in n]), "priors")

    def reliability(kind: str) -> list[Column]:
        """log P(value | language) for each language, from all pages."""
        found = {r[kind]: r for r in rows.groupBy(kind).agg(*sums).collect()}  # languages, none, other
        values = [*languages, "none", "other"]
        out = []
        for i, x in enumerate(languages):
            # A value agrees with its language more often than not, before anything is counted.
            seen = {v: (found[v][f"n{i}"] if v in found else 0.0) + (2.0 if v == x else 0.5) for v in values}
            whole_i = sum(seen.values())
            pairs = [F.when(F.col(kind) == v, F.lit(float(np.log(c / whole_i)))) for v, c in seen.items()]
            out.append(F.coalesce(*pairs))
        return out

    said, ending = reliability("declared"), reliability("suffix")
    joined = rows.join(priors, "host", "left")
    scores = [F.col(f"t{i}") + F.col(f"p{i}") + said[i] + ending[i] for i in n]
    joined = joined.withColumns({f"z{i}": s for i, s in enumerate(_softmax(scores))})
    best = F.greatest(*[F.col(f"z{i}") for i in n]) if len(languages) > 1 else F.col("z0")
    text_best = F.greatest(*[F.col(f"t{i}") for i in n]) if len(languages) > 1 else F.col("t0")
    pick = lambda p, top: F.get(names, F.coalesce(*[F.when(F.col(f"{p}{i}") == top, F.lit(i)) for i in n]))
    return joined.select("page_id", "url", "host", "declared", "suffix", pick("t", text_best).alias("text_lang"),
                         pick("z", best).alias("lang"), F.round(best, 6).alias("probability"))
