"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause is read as a sequence of token classes: O other, I insult, T threat verb, P person addressed,
N negation, Q reporting verb.  A look-ahead transducer reads the clause from its end and marks insults
and threat verbs whose target follows; then four transducers, composed into one, read it from its begin:

* reported speech: after Q, insults and threats of the clause count less;
* negation: within a few tokens after N they count less;
* target: within ``SPAN`` tokens of P, before or after it, an insult counts more (once), and a threat verb
  becomes a threat;
* the insult and threat reader: accepts I and a threat with its target, and drops all else.

The insult reader's lexicon is weighted: it holds stems (a word that begins with the stem matches).
Stems are learned from labelled documents: document counts of all word beginnings of 4 to 10 bytes are
gathered over every labelled training row, beginnings that toxic documents share and clean ones lack
become stems, and a logistic regression over the accepted clauses of a bounded sample
(``SAMPLE`` rows a class) sets their weights; a few general insults start with ``PRIOR`` weight.

A document's logit is a constant plus the sum of its stems' weights times log(1 + accepted clause
weight); no label, language, source or id is an input.

Defined results: a null or empty text has the score of a text without hits; without labelled rows of
both classes the prior weights are used; an empty table gives an empty result; repeated rows score
alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.text import FILTER_BYTES, Texts, chunks, field, releasing, small_side, span_hashes
from plinth.llm.transducer import Transducer, countdown

SYMBOLS = "OITPNQ"
#: With the marks of the look-ahead: J an insult and U a threat verb whose target follows.
MARKED = SYMBOLS + "JU"
#: Tokens between a person and an insult or threat verb that make it their target.
SPAN = 5
STEMS = (4, 5, 6, 7, 8, 9, 10)
#: Labelled rows of each class that the weights are fitted on.
SAMPLE = 10_000
#: Stems kept for the fit, and what a stem must show: share of toxic rows, rows, log odds of the shares.
MOST_STEMS, LEAST_SHARE, LEAST_ROWS, LEAST_ODDS = 400, 0.004, 3, 2.0
PRIOR, RIDGE, BIAS = 2.5, 0.3, -3.0
REPORTED, NEGATED, TARGETED = 0.5, 0.3, 1.5

# The grammar's word classes.
INSULTS = "idiot moron stupid scum trash loser worthless pathetic disgusting clown".split()
THREATS = "kill hurt destroy beat burn shoot stab attack töten tuer matar verletzen".split()
PERSONS = "you your he she they him her them du dich dir sie ihr tu te toi vous usted él ella ellos".split()
NEGATIONS = "not no never isn aren nicht kein keine nie ne pas jamais nunca ni sin".split()
REPORTS = "said says say called wrote claimed quote quoted sagte schrieb dit écrit dijo escribió".split()

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[65:91] = True
_LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?;:\n"]] = True


def grammar() -> tuple[Transducer, Transducer]:
    """The look-ahead, which reads a clause's token classes from right to left, and the composed transducer,
    which reads the look-ahead's symbols from left to right and writes H (a hit) or others, with weights."""
    ahead = countdown("P", SPAN, SYMBOLS, {"I": ("J", 1.0), "T": ("U", 1.0)})
    damped = lambda w: {x: (x, w) for x in "ITJU"}
    reported = Transducer({0: {"Q": (1, "Q", 1.0)}, 1: {x: (1, x, REPORTED) for x in "ITJU"}})
    negation = countdown("N", 3, MARKED, damped(NEGATED))
    target = countdown("P", SPAN, MARKED, {"I": ("H", TARGETED), "T": ("H", 1.0)})
    reader = Transducer({0: {"I": (0, "H", 1.0), "T": (0, "O", 0.0), "J": (0, "H", TARGETED), "U": (0, "H", 1.0)}})
    return ahead, reported.compose(negation, MARKED).compose(target, MARKED).compose(reader, MARKED)


class Words(Texts):
    """Letter runs in lower case (ASCII and Latin-1) with the number of the clause of each."""

    def __init__(self, col: pa.Array):
        super().__init__(col, lower=True)
        b = self.buf
        after = np.flatnonzero(b[:-1] == 0xC3) + 1
        upper = after[(b[after] >= 0x80) & (b[after] <= 0x9E) & (b[after] != 0x97)]
        b[upper] += 32
        letter = _LETTER[b]
        for lead in np.flatnonzero((b[:-2] == 0xE2) & (b[1:-1] == 0x80)):  # dashes and quotation marks
            letter[lead : lead + 3] = False
        self._split(letter)
        stops = np.cumsum(_STOP[b])
        # a text's first word opens a clause whatever ended before it
        self.clause = stops[self.starts] + self.owner() if self.starts.size else np.empty(0, np.int64)

    def stems(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each stem length: the words that have it, and its hash (never cut within a character)."""
        for k in STEMS:
            cut = self.starts + k
            ok = np.flatnonzero((cut <= self.ends) & ((self.buf[np.minimum(cut, self.buf.size - 1)] & 0xC0) != 0x80))
            yield k, ok, span_hashes(self.buf, self.starts[ok], cut[ok])


def is_training(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled training rows."""
    known = (labels.where(F.col("toxic").isNotNull() & is_training())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    return (docs.select("doc_id", "text").join(small_side(known), F.col("doc_id") == F.col("_id"))
            .select("doc_id", "text", "toxic"))


def stem_counts(rows: DataFrame) -> DataFrame:
    """(stem, toxic, clean): labelled documents of each class that have a word with this beginning.

    Beginnings that no toxic document of a task has are only counted where another task sends them too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            t = Words(field(batch, "text"))
            bad = field(batch, "toxic").to_numpy(zero_copy_only=False) > 0
            owner = t.owner()
            hashes, counts, names = [], [], []
            for k, ok, h in t.stems():
                if not ok.size:
                    continue
                order = np.lexsort((owner[ok], h))
                first = np.ones(order.size, bool)
                first[1:] = (h[order][1:] != h[order][:-1]) | (owner[ok][order][1:] != owner[ok][order][:-1])
                each = order[first]
                value, at, inverse = np.unique(h[each], return_index=True, return_inverse=True)
                toxic = np.bincount(inverse, weights=bad[owner[ok][each]], minlength=value.size).astype(np.int64)
                clean = np.bincount(inverse, minlength=value.size) - toxic
                where = t.starts[ok[each[at]]]
                hashes.append(value.view(np.int64))
                counts.append((toxic, clean))
                names += [t.buf[a : a + k].tobytes().decode("utf-8", "replace") if n else None for a, n in zip(where, toxic)]
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes)), pa.array(names, pa.string()),
                     *(pa.array(np.concatenate(x)) for x in zip(*counts))], ["hash", "stem", "toxic", "clean"])

    parts = rows.mapInArrow(releasing(count), "hash long, stem string, toxic long, clean long")
    return parts.groupBy("hash").agg(F.max("stem").alias("stem"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(rows: DataFrame) -> list[str]:
    """Beginnings that set toxic documents apart; of a chain of them, the longest that loses no documents."""
    n = {r["toxic"] > 0: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(True, 0), n.get(False, 0)
    if not toxic or not clean:
        return []
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    top = (stem_counts(rows).where(F.col("toxic") >= max(LEAST_ROWS, LEAST_SHARE * toxic)).withColumn("odds", odds)
           .where(F.col("odds") >= LEAST_ODDS).orderBy((F.col("odds") * F.col("toxic")).desc(), "stem").limit(MOST_STEMS * 8)
           .collect())
    seen = {r["stem"]: r["toxic"] for r in top}
    chosen: list[str] = []
    for stem in sorted(seen, key=lambda s: (len(s.encode()), s)):
        if not any(stem.startswith(c) for c in chosen):
            longer = [s for s in seen if s.startswith(stem) and seen[s] >= 0.97 * seen[stem]]
            chosen.append(max(longer, key=lambda s: (len(s.encode()), seen[s], s)))
    return sorted(set(chosen), key=lambda s: (-seen[s], s))[:MOST_STEMS]


class Lexicon:
    """Stems and word classes as sorted hash arrays."""

    def __init__(self, stems: list[str]):
        self.stems = stems
        hashed = lambda words: self._hash([w.encode() for w in words])
        sizes = {k: [i for i, s in enumerate(stems) if len(s.encode()) == k] for k in STEMS}
        self.by_size = {k: (hashed([stems[i] for i in own]), np.array(own)) for k, own in sizes.items() if own}
        self.classes = [(c, np.sort(hashed(words))) for c, words in (("T", THREATS), ("P", PERSONS), ("N", NEGATIONS), ("Q", REPORTS))]

    @staticmethod
    def _hash(words: list[bytes]) -> np.ndarray:
        buf = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        return span_hashes(buf, ends - [len(w) for w in words], ends)

    def read(self, t: Words) -> tuple[np.ndarray, np.ndarray]:
        """The class of each word (index in SYMBOLS) and its stem (-1: none); the longest stem wins."""
        kind, stem = np.zeros(t.starts.size, np.int8), np.full(t.starts.size, -1, np.int64)
        whole = t.hashes()
        for c, hashes in self.classes:
            at = np.minimum(np.searchsorted(hashes, whole), hashes.size - 1)
            kind[hashes[at] == whole] = SYMBOLS.index(c)
        for k, ok, h in t.stems():
            if k in self.by_size:
                hashes, own = self.by_size[k]
                order = np.argsort(hashes)
                at = np.minimum(np.searchsorted(hashes[order], h), hashes.size - 1)
                hit = hashes[order][at] == h
                kind[ok[hit]] = SYMBOLS.index("I")
                stem[ok[hit]] = own[order][at[hit]]
        return kind, stem


def clause_weights(col: pa.Array, lexicon: Lexicon, machines: tuple[Transducer, Transducer]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, weight) of all accepted patterns; feature ``len(stems)`` is threats."""
    ahead, machine = machines
    t = Words(col)
    kind, stem = lexicon.read(t)
    hits = np.flatnonzero((kind == 1) | (kind == 2))
    owner = t.owner()
    text, feature, weight = [], [], []
    for clause in np.unique(t.clause[hits]) if hits.size else ():
        a, b = np.searchsorted(t.clause, [clause, clause + 1])
        read = [SYMBOLS[k] for k in kind[a:b].tolist()]
        if "P" in read:
            state = 0
            for i in reversed(range(b - a)):
                state, read[i], _ = ahead.step(state, read[i])
        state = 0
        for i, symbol in enumerate(read, a):
            state, out, w = machine.step(state, symbol)
            if out == "H" and w:
                text.append(owner[i])
                feature.append(stem[i] if stem[i] >= 0 else len(lexicon.stems))
                weight.append(w)
    return np.array(text, np.int64), np.array(feature, np.int64), np.array(weight, float)


class Model:
    """The grammar with its weights; ``score(col)`` gives probabilities of a batch of texts."""

    def __init__(self, stems: list[str], weights: np.ndarray, bias: float):
        self.lexicon, self.weights, self.bias, self.machine = Lexicon(stems), weights, bias, grammar()

    def score(self, col: pa.Array) -> np.ndarray:
        text, feature, weight = clause_weights(col, self.lexicon, self.machine)
        logit = np.full(len(col), self.bias)
        if text.size:
            k = self.weights.size
            cell, inverse = np.unique(text * k + feature, return_inverse=True)
            total = np.log1p(np.bincount(inverse, weights=weight))
            np.add.at(logit, cell // k, total * self.weights[cell % k])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _regress(cells: list[tuple[int, int, float]], y: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with a Gaussian prior around ``prior``, by Newton steps."""
    x = np.zeros((y.size, prior.size + 1))
    for i, j, v in cells:
        x[i, j] += v
    x[:, :-1] = np.log1p(x[:, :-1])
    x[:, -1] = 1
    centre = np.append(prior, BIAS)
    beta, ridge = centre.copy(), np.diag(np.append(np.full(prior.size, RIDGE), 1e-3))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ (beta - centre))
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn stems from all labelled training rows and weights from a bounded sample of them."""
    rows = labelled(docs, labels)
    found = choose_stems(rows)
    stems = found + [s for s in INSULTS if not any(s.startswith(f) for f in found)]
    lexicon, machine = Lexicon(stems), grammar()
    prior = np.append(np.where(np.isin(stems, INSULTS), PRIOR, 0.0), PRIOR)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text, feature, weight = clause_weights(field(batch, "text"), lexicon, machine)
            own = [np.flatnonzero(text == i) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [field(batch, "toxic"), pa.array([feature[x] for x in own], pa.list_(pa.int64())),
                 pa.array([weight[x] for x in own], pa.list_(pa.float64()))], ["toxic", "feature", "weight"])

    n = {bool(r["toxic"]): r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Model(stems, prior, BIAS)
    # a bounded sample of each class, by a hash of the id
    bar = F.when(F.col("toxic") > 0, min(1.0, SAMPLE / n[True])).otherwise(min(1.0, SAMPLE / n[False]))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < bar * 1_000_000)
    got = sample.mapInArrow(releasing(features), "toxic int, feature array<long>, weight array<double>").collect()
    y = np.array([r["toxic"] > 0 for r in got], float)
    cells = [(i, j, v) for i, r in enumerate(got) for j, v in zip(r["feature"], r["weight"])]
    if y.min(initial=1) == y.max(initial=0):
        return Model(stems, prior, BIAS)
    return Model(stems, *_regress(cells, y, prior))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(model.score(field(batch, "text")))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(~is_training(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=FILTER_BYTES):
            yield batch.filter(pa.array(model.score(field(batch, "text")) < 0.5))

    return docs.mapInArrow(releasing(rows), docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
