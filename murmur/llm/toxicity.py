"""Toxicity by multiple-instance learning: sentences scored, documents labelled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import clean_text, lean, ship
from murmur.llm.words import groups, is_space, lower, mixed, slices, utf8, word_hashes

ship(__name__)

# The model is fitted to at most this many labelled documents of each class, those of the
# smallest hash of doc_id.
FIT_DOCUMENTS = 4000
# Words are hashed into this many weights.
BITS = 20
# Besides each word, its beginnings of so many bytes are features, for inflected words.
PREFIXES = (4, 5, 6, 7, 8)
# A feature is used when it is in this many fitted documents at least, and its shares in
# the two classes differ by so many standard errors.
SEEN_IN = 3
Z_LEAST = 6.0
# Longest part of a text that is one sentence, in words: long lines are cut into such parts.
SENTENCE_WORDS = 60
FOLDS = 5
STEPS = 250
RATE = 0.3
PENALTY = 2e-4
# Bias of a model that has seen nothing.
PRIOR = -8.0

SENTENCE = "start: int, end: int, score: double"


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod FOLDS; 0 is held out. A null doc_id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(FOLDS))


def sentences(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of each word's sentence in its batch, from 0 without gaps.

    A sentence ends after a word that ends in . ! or ?, before a word on another line, at
    the end of the text, and after SENTENCE_WORDS words.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    last = body[ends - 1]
    stop = (last == 46) | (last == 33) | (last == 63)
    new = np.zeros(n, bool)
    new[0] = True
    new[1:] = stop[:-1]
    lines = np.concatenate([[0], np.cumsum(body == 10)])
    new[1:] |= lines[starts[1:]] > lines[ends[:-1]]
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1][counts > 0]
    new[firsts] = True
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.cumsum(new | ((np.arange(n) - begin) % SENTENCE_WORDS == 0)) - 1


PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(texts: pa.Array):
    """Per group of texts: (bucket of each feature, its sentence, first word and end of each
    sentence in bytes of its text, number of sentences of each text, texts in the group).

    Punctuation at either end of a word is not part of it, A-Z count as a-z.
    """
    whole, where = utf8(texts)
    for first, last in groups(where):
        offsets = where[first : last + 1] - where[first]
        body = lower(whole[where[first] : where[last]])
        marks = PUNCTUATION[body]
        _, starts, ends, counts = word_hashes(body, offsets)
        number = sentences(body, starts, ends, counts)
        # The same hashes with outer punctuation read as blanks; inner marks stay.
        inner = body.copy()
        edge = marks & ~_inside(body, marks, offsets)
        inner[edge] = 32
        hashes, inner_starts, _, _, begun = word_hashes(inner, offsets, PREFIXES)
        owner = np.searchsorted(starts, inner_starts, side="right") - 1
        # A beginning is hashed apart from the word that is spelled like it.
        salted = [mixed(h + np.uint64(k)) for k, h in zip(PREFIXES, begun)]
        bucket = np.concatenate([hashes, *salted]) >> np.uint64(64 - BITS)
        bucket, owner = bucket.astype(np.int64), np.tile(owner, 1 + len(PREFIXES))
        firsts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, int)
        text_of_word = np.repeat(np.arange(last - first), counts)
        text = text_of_word[firsts]
        lasts = np.concatenate([firsts[1:], [len(number)]]).astype(int) - 1 if len(firsts) else firsts
        yield (
            bucket,
            number[owner] if len(owner) else owner,
            starts[firsts] - offsets[text],
            ends[lasts] - offsets[text],
            np.bincount(text, minlength=last - first),
            last - first,
        )


def _inside(body: np.ndarray, marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks that stand right between two bytes that are neither marks nor white space."""
    plain = ~(marks | is_space(body))
    inside = np.zeros(len(body), bool)
    inside[1:-1] = plain[:-2] & plain[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(body))]
    inside[cuts] = False
    inside[cuts - 1] = False
    return inside


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the sentence score, such that noisy-or of a document's sentences
    fits its label.

    Full-batch Adagrad on the log loss of p(document) = 1 - prod(1 - p(sentence)) with an
    L2 penalty. A document without words has no sentence and teaches nothing. Classes are
    weighed to count alike.
    """
    weights = np.zeros(1 << BITS)
    y = labels.astype(bool)
    n1, n0 = max(int(y.sum()), 1), max(int((~y).sum()), 1)
    # Once over the texts: in how many documents of each class a feature is.
    toxic, seen = np.zeros(1 << BITS), np.zeros(1 << BITS)
    sentence = doc = 0
    for bucket, number, firsts, _, per_text, n in features(texts):
        of_doc = np.repeat(np.arange(n), per_text)
        at_doc, at = np.divmod(np.unique(of_doc[number] * (1 << BITS) + bucket), 1 << BITS)
        toxic += np.bincount(at[y[doc + at_doc]], minlength=1 << BITS)
        seen += np.bincount(at, minlength=1 << BITS)
        sentence += len(firsts)
        doc += n
    if not sentence:
        return weights, PRIOR
    p = seen / (n0 + n1)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
    use = (seen >= SEEN_IN) & (np.abs(toxic / n1 - (seen - toxic) / n0) >= Z_LEAST * error)
    # Again: only the features in use are kept, a small part.
    buckets, owners, docs = [], [], []
    sentence = doc = 0
    for bucket, number, firsts, _, per_text, n in features(texts):
        kept = use[bucket]
        buckets.append(bucket[kept])
        owners.append(number[kept] + sentence)
        docs.append(np.repeat(np.arange(n), per_text) + doc)
        sentence += len(firsts)
        doc += n
    bucket, owner, of_doc = (np.concatenate(x) for x in (buckets, owners, docs))
    columns, bucket = np.unique(bucket, return_inverse=True)
    # A word counts once in a sentence.
    cells = np.unique(owner * max(len(columns), 1) + bucket)
    owner, bucket = np.divmod(cells, max(len(columns), 1))
    share = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1))
    w, b = np.zeros(len(columns)), PRIOR
    gw, gb = np.full(len(columns), 1e-8), 1e-8
    for _ in range(STEPS):
        z = b + np.bincount(owner, w[bucket], minlength=sentence)
        p = logistic(z)
        none = np.exp(np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=doc))
        # d loss / d z: p for clean documents, -p * none / (1 - none) for toxic ones.
        pull = np.where(y, -none / np.maximum(1 - none, 1e-9), 1.0) * share
        g = p * pull[of_doc]
        dw = np.bincount(bucket, g[owner], minlength=len(columns)) + PENALTY * w / max(len(columns), 1)
        db = g.sum()
        gw += dw**2
        gb += db**2
        w -= RATE * dw / np.sqrt(gw)
        b -= RATE * db / np.sqrt(gb)
    weights[columns] = w
    return weights, float(b)


def chosen_labels(labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """doc_id, toxic of at most `fit_documents` labelled documents of each class outside the fold.

    Those of the smallest hash of doc_id. A document labelled twice counts as toxic if it
    is in one of them; null labels are left out.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(remainder(F.col("doc_id")) != 0)
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    clean = known.where("toxic = 0").orderBy(*order).limit(fit_documents)
    return clean.unionAll(known.where("toxic = 1").orderBy(*order).limit(fit_documents))


def train(documents: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS):
    """(columns, their weights, bias) learned from the chosen documents.

    The documents are chosen by doc_id before any text is read and are at most
    2 x `fit_documents`, so their ids are sent to all executors and one task fits the
    model to their whole texts; only its weights come to the driver.
    """

    def run(batches):
        texts, toxic = [pa.array([], pa.string())], []
        for batch in batches:
            texts.append(batch.column("text").cast(pa.string()))
            toxic += batch.column("toxic").to_pylist()
        weights, bias = fit(pa.concat_arrays(texts), np.array(toxic, np.int64))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([used]), pa.array([weights[used]]), pa.array([bias])], ["columns", "weights", "bias"]
        )

    chosen = chosen_labels(labels, fit_documents)
    model = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .repartition(1)
        .sortWithinPartitions("doc_id")
        .select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(lean(run), "columns array<bigint>, weights array<double>, bias double")
        .collect()
    )
    if not model:  # no document to learn from
        return np.zeros(0, np.int64), np.zeros(0), PRIOR
    (row,) = model
    return np.array(row["columns"], np.int64), np.array(row["weights"]), float(row["bias"])


def _scorer(model, score: str, found: str):
    columns, values, bias = model

    def run(batches):
        weights = np.zeros(1 << BITS)
        weights[columns] = values
        for batch in slices(batches):
            scores, rows = [], []
            for bucket, number, starts, ends, per_text, n in features(batch.column("text")):
                # A word counts once in a sentence; most have no weight.
                told = weights[bucket] != 0
                cells = np.unique(number[told] * (1 << BITS) + bucket[told])
                z = bias + np.bincount(
                    cells >> BITS, weights[cells & ((1 << BITS) - 1)], minlength=len(starts)
                )
                p = logistic(z)
                doc = np.repeat(np.arange(n), per_text)
                scores.append(-np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)))
                bad: list[list[dict]] = [[] for _ in range(n)]
                for i in np.flatnonzero(p >= 0.5):
                    bad[doc[i]].append({"start": int(starts[i]), "end": int(ends[i]), "score": float(p[i])})
                rows += bad
            total = np.concatenate(scores) if scores else np.zeros(0)
            spans = pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total), spans], [*batch.schema.names, score, found]
            )

    return run


def with_scores(
    documents: DataFrame, model, score: str = "score", found: str = "sentences"
) -> DataFrame:
    """Adds the document score and the offending sentences to the rows, where they are.

    `score` is the noisy-or of the sentence scores, 0 for a text without words or null.
    `found` lists the sentences of score >= 0.5: start and end byte in the UTF-8 text, score.
    Columns of these two names are replaced, others kept; one narrow step.
    """
    keep = documents.drop(score, found)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema)
    return keep.mapInArrow(
        lean(_scorer(model, score, found)),
        f"{schema}, `{score}` double, `{found}` array<struct<{SENTENCE}>>",
    )


def score_documents(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and offending sentences of every document.

    Only the text is an input of the score. Without labels of both kinds the score is low
    everywhere.
    """
    model = train(documents, labels, **options)
    scored = with_scores(documents.select("doc_id", clean_text().alias("text")), model)
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
    )


def clean_documents(documents: DataFrame, model) -> DataFrame:
    """The documents of score below 0.5 by a trained model; same columns, in place."""
    rows = documents.select(
        F.struct(*documents.columns).alias("row"), clean_text().alias("text")
    )
    return with_scores(rows, model).where("score < 0.5").select("row.*")
