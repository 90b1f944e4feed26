"""Language of a text, from all that is known about it.

Evidence is added up as log probabilities:

* the text's byte trigrams under a multinomial model of each language and of no language,
* the language that the markup declares, by how often texts of a language declare it,
* the address suffix, by how often texts of a language stand under it,
* the host as prior: counts of languages by host, smoothed with those of its domain, which
  are smoothed with those of all rows.

The last three come from grouped aggregation over all rows; only the trigram model is
fitted, on a bounded sample of labelled rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage
from .skew import spread_join

#: Labelled rows a language's model is fitted on, on average; a documented bound of the sample.
SAMPLE_ROWS = 1_000
BUCKETS = 1 << 16
#: Languages whose likelihoods a task holds at once, 64 MB; more languages make more passes.
BLOCK_LANGUAGES = 256
#: Neighbouring trigrams share two bytes of three, so each counts as a third.
TEMPER = 1 / 3
#: Pseudo-counts: of a trigram bucket, of a domain or all rows in a host's prior, of evidence tables.
SMOOTH, PRIOR_ROWS, TABLE_ROWS = 0.05, 5.0, 5.0
#: Share of declarations expected to be right before any is seen.
DECLARED_RIGHT = 0.8
#: Rows under this posterior, or best explained by no language, are rejected.
LEAST_POSTERIOR = 0.5
NO_LANGUAGE = "und"
_AT_ONCE, _CELLS = 1 << 20, 1 << 24

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# White space, digits and ASCII punctuation say nothing of the language: one blank for all.
_LOWER[[b for b in range(128) if not chr(b).isalpha()]] = 32


def grams(text: bytes | None):
    """Buckets of a text's byte trigrams, in pieces; letters only, A-Z lowered, gaps as one blank."""
    if not text:
        return
    for at in range(0, len(text), _AT_ONCE):
        raw = _LOWER[np.frombuffer(text[max(0, at - 2) : at + _AT_ONCE], np.uint8)]
        if at == 0:
            raw = np.concatenate([[np.uint8(32)], raw])
        if at + _AT_ONCE >= len(text):
            raw = np.concatenate([raw, [np.uint8(32)]])
        raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])]
        if len(raw) >= 3:
            x = raw.astype(np.uint32)
            code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
            yield (code * np.uint32(2654435761)) >> np.uint32(16)


class TextModel:
    """Log likelihoods of trigram buckets by language, in blocks; the last column is no language: all buckets alike."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages + [NO_LANGUAGE]
        self.blocks = []
        for at in range(0, len(languages), BLOCK_LANGUAGES):
            smoothed = counts[:, at : at + BLOCK_LANGUAGES] + SMOOTH
            self.blocks.append(np.log(smoothed / smoothed.sum(axis=0, keepdims=True)).astype(np.float32))
        uniform = np.full((BUCKETS, 1), -math.log(BUCKETS), np.float32)
        self.blocks[-1:] = [np.hstack([*self.blocks[-1:], uniform])]


def likelihoods(text: bytes | None, logs: np.ndarray) -> list[float]:
    """Log likelihoods of a text under each column of a block."""
    total, step = np.zeros(logs.shape[1]), _CELLS // logs.shape[1]
    for found in grams(text):
        for at in range(0, len(found), step):
            total += logs[found[at : at + step]].sum(axis=0, dtype=np.float64)
    return (total * TEMPER).tolist()


def fit_text_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id") -> TextModel:
    """A model of every label, from about `SAMPLE_ROWS` rows of each, chosen by a hash of id and label.

    The driver holds a quarter of a megabyte for each language.
    """
    rows = labelled.select(
        F.col(label_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), F.col(id_col).cast("long").alias("id")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return TextModel([], np.zeros((BUCKETS, 0)))
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, SAMPLE_ROWS / r["count"]))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("id", "lang"), F.lit(1 << 20)) < share * (1 << 20)

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for found in grams(text.as_py()):
                    own += np.bincount(found, minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "gram", "n"]
            )

    sample = rows.where(drawn).select("lang", "text")
    found = sample.mapInArrow(counted, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    column = {x: i for i, x in enumerate(languages)}
    for r in found.toLocalIterator():
        counts[r["gram"], column[r["lang"]]] = r["n"]
    return TextModel(languages, counts)


def text_scores(text: Column, logs: np.ndarray) -> Column:
    """Log likelihoods of a text under each language of a block."""

    @F.arrow_udf("array<double>")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([likelihoods(t.as_py(), logs) for t in texts], pa.list_(pa.float64()))

    return scored(text.cast("binary"))


def _array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _counts(n: int, of: str = "top") -> Column:
    """Rows by language, as an array."""
    return F.array(*[F.count(F.when(F.col(of) == i, 1)).cast("double") for i in range(n)])


def _sums(n: int, column: str) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(n)])


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _smoothed(counts: Column, prior: Column, rows: float) -> Column:
    """(counts + rows * prior) / (total + rows)."""
    total = _total(counts)
    return F.zip_with(counts, prior, lambda n, p: (n + p * rows) / (total + rows))


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """`rows` (text, declared, suffix, host, domain and any others) with lang, posterior, text_lang, accepted.

    Suffix and domain belong to the host. Any evidence may be null and then says nothing; a
    text without letters leaves the decision to the rest. Texts count whole. Without any
    language in the model, and where no language explains the text best, lang is `und`.
    A row is accepted if its language is none of that, its text has a letter, and the
    posterior is at least one half. Ties go to the first language in code-point order.
    Repeated rows count anew and get equal results; other columns stay but for those named
    like a result. An empty table gives an empty table.
    """
    n, names = len(model.languages), F.array(*[F.lit(x) for x in model.languages])
    best = lambda a: F.array_position(a, F.array_max(a)) - 1
    keep = [c for c in rows.columns if c not in ("text", "lang", "posterior", "text_lang", "accepted")]
    scored = rows.select(*keep, "text", text_scores(F.col("text"), model.blocks[0]).alias("scores"), F.col("text").rlike(r"\p{L}").alias("letters"))
    for logs in model.blocks[1:]:
        # Written in between, so that no task holds two blocks.
        scored = stage(scored, "scores").withColumn("scores", F.concat("scores", text_scores(F.col("text"), logs)))
    scored = scored.drop("text")
    scored = stage(scored.withColumn("letters", F.coalesce("letters", F.lit(False))).withColumn("top", best(F.col("scores"))), "scores")

    # What a row's text says counts for its host, domain, suffix and declaration.
    sure = scored.where("letters")
    hosts = sure.where("host IS NOT NULL").groupBy("host")
    hosts = hosts.agg(F.min("domain").alias("domain"), F.min("suffix").alias("suffix"), _counts(n).alias("c"))
    hosts = stage(hosts, "hosts")
    overall = sure.agg(_counts(n).alias("c")).first()["c"]
    overall = [(x + 1) / (sum(overall) + n) for x in overall]
    domains = hosts.groupBy("domain").agg(_sums(n, "c").alias("d"))
    suffixes = hosts.groupBy("suffix").agg(_sums(n, "c").alias("s"))
    kinds = suffixes.count()
    every = [max(1.0, x) for x in (suffixes.agg(_sums(n, "s").alias("s")).first()["s"] or []) if x is not None] or [1.0] * n
    suffix_log = F.zip_with("s", _array(every), lambda x, t: F.log((x + TABLE_ROWS / max(kinds, 1)) / (t + TABLE_ROWS)))
    hosts = spread_join(hosts, domains.where("domain IS NOT NULL"), "domain", "left", spread_by="host")
    hosts = stage(hosts, "hosts")
    hosts = spread_join(hosts, suffixes.where("suffix IS NOT NULL"), "suffix", "left", spread_by="host")
    nothing = _array([0.0] * n)
    wide = _smoothed(F.coalesce("d", nothing), _array(overall), PRIOR_ROWS)
    prior = F.transform(_smoothed(F.col("c"), wide, PRIOR_ROWS), lambda x: F.log(x))
    hosts = hosts.select("host", _plus(prior, F.coalesce(suffix_log, nothing)).alias("prior"))

    known = F.coalesce(F.array_position(names, F.lower("declared")) - 1, F.lit(n)).cast("int")
    declared = F.when(F.col("declared").isNotNull(), F.when(known < 0, n).otherwise(known))
    scored = scored.withColumn("said", declared)
    said = {r["said"]: r["c"] for r in scored.where("letters AND said IS NOT NULL").groupBy("said").agg(_counts(n).alias("c")).collect()}
    of = [sum(c[i] for c in said.values()) for i in range(n)]
    tables = []
    for d in range(n + 1):
        own, logs = said.get(d, [0.0] * n), []
        for i in range(n):
            expected = DECLARED_RIGHT if d == i else (1 - DECLARED_RIGHT) / n
            logs.append(math.log((own[i] + TABLE_ROWS * expected) / (of[i] + TABLE_ROWS)))
        tables.append((d, logs))
    # A row for each language and not an expression, which would grow with their square.
    tables = rows.sparkSession.createDataFrame(tables, "said int, told array<double>")
    scored = scored.join(F.broadcast(tables), "said", "left").drop("said")
    told = F.coalesce("told", nothing)

    out = spread_join(scored, hosts, "host", "left", spread_by="scores")
    start = F.coalesce("prior", _array([math.log(x) for x in overall]))
    out = out.withColumn("sum", _plus(_plus(F.col("scores"), start), told))
    top = F.array_max("sum")
    evidence = F.aggregate("sum", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    out = out.withColumn("posterior", F.round(1 / evidence, 6)).withColumn("lang", names[best(F.col("sum"))])
    out = out.withColumn("text_lang", F.when(F.col("letters"), names[F.col("top")]))
    good = F.col("letters") & (F.col("lang") != NO_LANGUAGE) & (F.col("posterior") >= LEAST_POSTERIOR)
    return out.select(*keep, "lang", "posterior", "text_lang", good.alias("accepted"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence: the source stands for the host; markup and address are unknown."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"),
        none.alias("suffix"), F.concat(F.lit("source:"), F.col("source")).alias("host"), none.alias("domain"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as evidence: text without markup, the lang attribute, host, domain and last label of the address."""
    html = F.col("html")
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    lang = F.regexp_extract(html, r"""(?i)<html[^>]*\slang\s*=\s*["']?([a-z]+)""", 1)
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    domain, suffix = F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)
    filled = lambda c: F.when(F.length(c) > 0, c)
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), bare.alias("text"),
        filled(lang).alias("declared"), filled(suffix).alias("suffix"), filled(host).alias("host"), filled(domain).alias("domain"),
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents with an accepted language, which takes the place of `lang`; other columns as they are.

    A model is fitted on the rows of `docs` that carry a label. Rows are told apart by their
    id and text, so rows without an id or with a repeated one are judged by their own text.
    """
    model = fit_text_model(docs)
    verdict = identify(document_rows(docs).withColumn("text_key", F.xxhash64("text")), model)
    verdict = verdict.where("accepted").select("doc_id", "text_key", "host", F.col("lang").alias("__lang")).distinct()
    same = (
        F.col("__d.doc_id").eqNullSafe(F.col("__v.doc_id")) & (F.xxhash64("__d.text") == F.col("__v.text_key"))
        & F.concat(F.lit("source:"), F.col("__d.source")).eqNullSafe(F.col("__v.host"))
    )
    out = docs.alias("__d").join(verdict.alias("__v"), same)
    return out.select(*[F.col("__lang").alias(c) if c == "lang" else F.col(f"__d.{c}") for c in docs.columns])


def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and pages, each row with its language; one id of the two is null."""
    docs, pages = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "pages"))
    rows = document_rows(docs).unionByName(page_rows(pages))
    return identify(rows, fit_text_model(docs)).drop("declared", "suffix", "host", "domain")
