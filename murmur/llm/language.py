"""Language identification by fusing text, markup, address and host evidence with Bayes' rule."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import clean_text, lean, ship, stored
from murmur.llm.words import groups, slices, utf8

ship(__name__)

UNKNOWN = "und"
# The text model is fitted to at most this many documents of each language, those of the
# smallest hash of doc_id. Every label is a language.
FIT_DOCUMENTS = 2000
# Ids of fitted documents that are sent to the documents; more are joined as Spark sees fit.
IDS_SENT = 1_000_000
BITS = 14
# Neighbouring trigrams are not independent: a text weighs as this many at most.
EFFECTIVE = 40.0
# Votes of a host's domain, and of all hosts, that a host's own votes are smoothed with.
KAPPA = 8.0
# Share of sites under a country's suffix that keep to its languages.
SUFFIX_TRUST = 0.8
ACCEPT = 0.6
# A vote of the text alone counts for its host from this posterior on.
VOTE = 0.9

# Country suffixes and the languages spoken there.
SUFFIX_LANGUAGES = {
    "at": ("de",), "au": ("en",), "be": ("fr", "nl"), "br": ("pt",), "ca": ("en", "fr"),
    "ch": ("de", "fr", "it"), "cl": ("es",), "co": ("es",), "cz": ("cs",), "de": ("de",),
    "dk": ("da",), "es": ("es",), "fi": ("fi",), "fr": ("fr",), "gr": ("el",), "ie": ("en",),
    "it": ("it",), "jp": ("ja",), "kr": ("ko",), "mx": ("es",), "nl": ("nl",), "no": ("no",),
    "nz": ("en",), "pl": ("pl",), "pt": ("pt",), "ru": ("ru",), "se": ("sv",), "tr": ("tr",),
    "uk": ("en",), "us": ("en",),
}

# Letters as themselves (A-Z as a-z), everything else as one blank; bytes of other
# scripts are letters.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def trigrams(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the byte trigram at each byte, whether it counts: it has a letter in the
    middle). One blank is put before and after the text."""
    folded = np.concatenate([[32], FOLD[body], [32]]).astype(np.uint32)
    key = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    bucket = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return bucket, folded[1:-1] != 32


def _counter():
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                bucket, counts = trigrams(body[offsets[i] : offsets[i + 1]])
                here = np.bincount(bucket[counts], minlength=1 << BITS)
                total[lang] = total[lang] + here if lang in total else here
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used), pa.array(counts[used])],
                ["lang", "bucket", "n"],
            )

    return run


def train(labelled: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages and log-likelihoods of trigram buckets; the last row is the unknown language.

    `labelled` has doc_id, text and lang. What comes to the driver grows with labels x
    buckets, not with documents. The unknown language gives every bucket the same chance.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    table = np.full((len(names) + 1, 1 << BITS), 0.5)
    if names:
        first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = (
            known.select("doc_id", "lang")
            .withColumn("_no", F.row_number().over(first))
            .where(F.col("_no") <= fit_documents)
            .select("doc_id", "lang")
            .distinct()
        )
        if len(names) * fit_documents <= IDS_SENT:
            chosen = F.broadcast(chosen)
        texts = known.join(chosen, ["doc_id", "lang"]).select("lang", "text")
        counts = (
            texts.mapInArrow(lean(_counter()), "lang string, bucket long, n long")
            .groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        place = {name: i for i, name in enumerate(names)}
        lang = counts.column("lang").combine_chunks().dictionary_encode()
        if isinstance(lang, pa.ChunkedArray):
            lang = lang.combine_chunks()
        where = np.array([place[v] for v in lang.dictionary.to_pylist()], np.int64)
        if len(where):
            table[where[lang.indices.to_numpy()], counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def _liker(table: np.ndarray, text: str, keep_text: bool):
    def run(batches):
        likes = table.astype(np.float32)
        for batch in slices(batches):
            out, sizes = [], []
            whole, where = utf8(batch.column(text))
            for first, last in groups(where, 1 << 20):
                offsets = where[first : last + 1] - where[first]
                body = whole[where[first] : where[last]]
                total = np.zeros((last - first, len(likes)))
                n = np.zeros(last - first, np.int64)
                if len(body):
                    # Texts are kept apart by the letters at their ends: each is folded alone
                    # where it meets the next, by reading the end as a blank.
                    bucket, counts = _apart(body, offsets)
                    edges = np.concatenate([[0], np.cumsum(counts)])[offsets]
                    n = np.diff(edges)
                    bucket = bucket[counts]
                    for k in range(len(likes)):
                        sums = np.concatenate([[0.0], np.cumsum(likes[k][bucket], dtype=np.float64)])
                        total[:, k] = np.diff(sums[edges])
                out.append(total * np.minimum(1.0, EFFECTIVE / np.maximum(n, 1))[:, None])
                sizes.append(n)
            likelihood = np.concatenate(out) if out else np.zeros((0, len(likes)))
            letters = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            names = [c for c in batch.schema.names if keep_text or c != text]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(list(likelihood), pa.list_(pa.float64())),
                    pa.array(letters),
                ],
                [*names, "likelihood", "letters"],
            )

    return run


def _apart(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`trigrams` of texts that stand one after another, as if a blank were around each."""
    bucket, counts = trigrams(body)
    folded = FOLD[body].astype(np.uint32)
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(body))])
    before = np.concatenate([[32], folded[:-1]]).astype(np.uint32)
    after = np.concatenate([folded[1:], [32]]).astype(np.uint32)
    before[cuts] = 32
    after[cuts - 1] = 32
    for at in (cuts, cuts - 1):
        key = (before[at] << np.uint32(16)) | (folded[at] << np.uint32(8)) | after[at]
        bucket[at] = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return bucket, counts


def with_likelihood(rows: DataFrame, model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds `likelihood` (log, per language and unknown) and `letters` (trigrams counted)."""
    _, table = model
    kept = rows if keep_text else rows.drop(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return rows.mapInArrow(
        lean(_liker(table, text, keep_text)), f"{schema}, likelihood array<double>, letters bigint"
    )


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    return F.transform(
        F.array(raised), lambda r: F.transform(r, lambda x: x / F.aggregate(r, F.lit(0.0), lambda a, v: a + v))
    )[0]


def text_vote(names: list[str], vote: float = VOTE) -> Column:
    """Position of the language that the text alone makes sure of, else null."""
    chance = _softmax(F.col("likelihood"))
    best = F.array_position(chance, F.array_max(chance)) - 1
    return F.when((F.col("letters") > 0) & (F.array_max(chance) >= vote), best.cast("int"))


def declared_language(column: Column, names: list[str]) -> Column:
    """Position of a declared language tag (primary subtag, any case), -1 for others, null for none."""
    tag = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,8})(?:[-_]|\s*$)", 1))
    # Of names that differ in case only, the last.
    last = {name.lower(): i for i, name in enumerate(names)}
    known = F.array(*[F.lit(n.lower() if last[n.lower()] == i else None) for i, n in enumerate(names)])
    place = F.array_position(known.cast("array<string>"), tag).cast("int") - 1
    return F.when(F.coalesce(tag, F.lit("")) != "", place)


def _votes(votes: DataFrame, keys: list[str], name: str) -> DataFrame:
    """`name`: a map from language to votes for each of `keys`, of the languages met there."""
    met = votes.groupBy(*keys, "vote").agg(F.sum("votes").cast("double").alias("_n"))
    return met.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("vote", "_n"))).alias(name))


def learn(evidence: DataFrame, names: list[str], name: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(votes of hosts, votes of all, reliability of declarations), by grouped aggregation.

    `evidence` has host, domain, declared, likelihood and letters. Rows are counted per
    (host, domain, declared, vote) first, so a host with a third of all rows is a few rows
    per task. The table of hosts (host, and the votes of host and domain) grows with the
    hosts and is joined, never sent whole unless Spark finds it small.
    """
    size = len(names) + 1
    votes = stored(
        evidence.withColumn("vote", text_vote(names))
        .groupBy("host", "domain", "declared", "vote")
        .agg(F.count(F.lit(1)).alias("votes")),
        name,
    )
    sure = votes.where(F.col("vote").isNotNull())
    host = _votes(sure, ["host", "domain"], "own")
    priors = host.join(_votes(sure, ["domain"], "shared"), "domain").drop("domain")
    table = np.ones((size, size))  # true language x declared (the last column: another one)
    everyone = np.zeros(size)
    for row in sure.groupBy("vote", "declared").agg(F.sum("votes").alias("n")).collect():
        everyone[row["vote"]] += row["n"]
        if row["declared"] is not None:
            table[row["vote"], row["declared"]] += row["n"]
    return priors, everyone, table / table.sum(axis=1, keepdims=True)


def _numbers(values) -> Column:
    """One literal however many there are; Spark reads it once, when it plans."""
    text = ",".join(repr(float(v)) for v in values)
    return F.transform(F.split(F.lit(text), ","), lambda v: v.cast("double"))


def fuse(evidence: DataFrame, names: list[str], learned, accept: float = ACCEPT) -> DataFrame:
    """Adds language, chance (its posterior), text_language and accepted to `evidence`.

    log posterior = log text likelihood + log P(declared | language) + log P(suffix |
    language) + log host prior. The host prior is the host's votes smoothed by its domain's,
    and these by all votes; a row's own vote is taken out first, as its text is counted
    already. Rows without a letter, and those whose best language is unknown or below
    `accept`, are not accepted.
    """
    priors, everyone, declared = learned
    size = len(names) + 1
    everywhere = (everyone + 1) / (everyone.sum() + size)
    suffixes = {}
    for suffix, spoken in SUFFIX_LANGUAGES.items():
        at = [i for i, n in enumerate(names) if n in spoken]
        if at:
            rest = (1 - SUFFIX_TRUST) / max(size - len(at), 1)
            suffixes[suffix] = [SUFFIX_TRUST / len(at) if i in at else rest for i in range(size)]
    none = _numbers([0.0] * size)
    by_suffix = none
    for suffix, chances in suffixes.items():
        by_suffix = F.when(F.col("suffix") == suffix, _numbers(np.log(chances))).otherwise(by_suffix)
    # Column by column; -1 stands for another language, the last one.
    column = F.when(F.col("declared") == -1, F.lit(size - 1)).otherwise(F.col("declared"))
    every = _numbers(np.log(declared).T.ravel())
    by_declared = F.when(F.col("declared").isNotNull(), F.slice(every, column * size + 1, size)).otherwise(none)
    index = F.sequence(F.lit(0), F.lit(size - 1))
    own_vote = F.transform(
        index, lambda i: F.when(F.coalesce("vote", F.lit(-1)) == i, F.lit(1.0)).otherwise(F.lit(0.0))
    )

    def less(votes: str) -> Column:
        met = F.transform(index, lambda i: F.coalesce(F.try_element_at(F.col(votes), i), F.lit(0.0)))
        return F.zip_with(met, F.col("own_vote"), lambda c, v: F.greatest(c - v, F.lit(0.0)))

    def smoothed(votes: Column, prior: Column) -> Column:
        n = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
        return F.zip_with(votes, prior, lambda c, p: (c + F.lit(KAPPA) * p) / (n + F.lit(KAPPA)))

    def plus(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    joined = (
        evidence.withColumn("vote", text_vote(names))
        .join(priors, "host", "left")
        .withColumn("own_vote", own_vote)
        .withColumn("prior", smoothed(less("shared"), _numbers(everywhere)))
        .withColumn("prior", smoothed(less("own"), F.col("prior")))
        .withColumn("by_suffix", by_suffix)
        .withColumn("by_declared", by_declared)
        .withColumn(
            "posterior",
            _softmax(
                plus(
                    plus(F.col("likelihood"), F.col("by_declared")),
                    plus(F.col("by_suffix"), F.transform("prior", lambda p: F.log(p))),
                )
            ),
        )
        .withColumn("chance", F.array_max("posterior"))
    )
    labels = F.array(*[F.lit(n) for n in [*names, UNKNOWN]])
    best = F.element_at(labels, F.array_position("posterior", F.col("chance")).cast("int"))
    language = F.when(F.col("letters") > 0, best).otherwise(F.lit(UNKNOWN))
    return (
        joined.withColumn("language", language)
        .withColumn("text_language", F.element_at(labels, F.col("vote") + 1))
        .withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("chance") >= accept))
        .drop(
            "own_vote", "prior", "by_suffix", "by_declared", "posterior", "own", "shared",
            "vote", "likelihood", "letters",
        )
    )


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def page_evidence(pages: DataFrame, names: list[str]) -> DataFrame:
    """page_id, host, domain, suffix, declared and the visible text of pages."""
    host = F.regexp_replace(host_of(F.col("url")), r":\d*$", "")
    tags = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    tag = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8}(?:[-_][A-Za-z0-9]+)*)", 1)
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id",
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
        declared_language(tag, names).alias("declared"),
        F.regexp_replace("html", tags, " ").alias("text"),
    )


def identify_pages(
    pages: DataFrame, labelled: DataFrame, fit_documents: int = FIT_DOCUMENTS, name: str = "language"
) -> DataFrame:
    """page_id, host, language, chance, text_language, declared_language, accepted of every page.

    `labelled` documents (doc_id, text, lang) teach the text model. A page without html has
    no text evidence and language `und`; one without an address belongs to the host of
    empty name. Repeated rows are judged alike; other columns are not read.
    """
    model = train(labelled, fit_documents)
    names = model[0]
    evidence = stored(with_likelihood(page_evidence(pages, names), model), f"{name}-evidence")
    learned = learn(evidence, names, f"{name}-votes")
    labels = F.array(*[F.lit(n) for n in names], F.lit(None).cast("string"))
    told = F.when(F.col("declared") >= 0, F.element_at(labels, F.col("declared") + 1))
    return fuse(evidence, names, learned).select(
        "page_id",
        "host",
        "language",
        "chance",
        "text_language",
        told.alias("declared_language"),
        "accepted",
    )


def accepted_documents(
    documents: DataFrame, labelled: DataFrame, fit_documents: int = FIT_DOCUMENTS, name: str = "language"
) -> DataFrame:
    """The documents in an accepted language; same columns.

    The `lang` column is the declaration and `source` the host. Texts are read twice (for
    the votes, then for the verdict) and, as long as Spark finds the table of sources small,
    never shuffled.
    """
    model = train(labelled, fit_documents)
    names = model[0]
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        F.coalesce("source", F.lit("")).alias("host"),
        F.lit("").alias("domain"),
        F.lit("").alias("suffix"),
        declared_language(F.col("lang"), names).alias("declared"),
        clean_text().alias("text"),
    )
    votes = with_likelihood(rows.drop("row"), model)
    learned = learn(votes, names, f"{name}-votes")
    return fuse(with_likelihood(rows, model), names, learned).where("accepted").select("row.*")
