"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The labelled rows that may be learned from are dealt into two halves and a rest by a hash of their id. Each half gives
two lexicons with weights, one of whole words and one of word beginnings, which make the features of the other half, so
that the trees see lexicons as they will on new texts. The lexicons that stay come from both halves; the rest calibrates.
Only texts make features.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbt
from .common import map_batches, text_of, texts, written

#: Parameters of fit(): at most this many labelled rows are learned from, chosen by a hash of their id; and the size of a
#: lexicon, of which the entries with the most weight times log count are taken. Both bound the model, not what is scored.
TRAIN_ROWS, LEXICON_ENTRIES = 30_000, 4_000
#: An entry must occur in this many labelled texts and have these log-odds.
MIN_TEXTS, MIN_LOG_ODDS = 2, 2.0
BEGINNINGS = (4, 5, 6)
CUT = 0.7
_STRIP = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"
#: Digits and symbols that stand for letters within a word.
_STANDS_FOR = str.maketrans("013457@$!", "oieastasi")
_NO_CAPITALS = {c: None for c in range(0x250) if chr(c).isupper()}
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus vosotros usted ustedes vuestro vuestra".split())
_MIXED = re.compile(r"[^\W\d_][013457@$!*]+[^\W\d_]|[^\W\d_](?:[.\-*_][^\W\d_]){3,}")
FEATURES = (
    "log_words", "word_sum", "word_density", "word_max", "begin_sum", "begin_density", "begin_max", "hits", "hit_density", "distinct_hits",
    "near_second_person", "nearest_second_person", "second_person_rate", "capital_rate", "shout_rate", "exclaim_rate", "question_rate", "symbol_rate", "obfuscated_rate", "obfuscated_hits",
)


def normal_word(run: str) -> tuple[str, bool]:
    """A run in lower case, without punctuation around it; digits and symbols within letters become letters (True then)."""
    word = run.lower().strip(_STRIP)
    if not word or word.isalpha():
        return word, False
    if not any(c.isalpha() for c in word):
        return word, False
    plain = word.translate(_STANDS_FOR)
    plain = "".join(c for c in plain if c.isalpha())
    return plain, True


class Featurizer:
    """The features of a text under the lexicons; weights are kept by run."""

    def __init__(self, words: dict[str, float], begins: dict[str, float], most: int = 300_000):
        self.words, self.begins, self.most = words, begins, most
        self.memo: dict[str, tuple[float, float, bool, bool]] = {}

    def _weigh(self, run: str) -> tuple[float, float, bool, bool]:
        word, odd = normal_word(run)
        begin = max((self.begins.get(word[:k], 0.0) for k in BEGINNINGS if len(word) >= k), default=0.0)
        return self.words.get(word, 0.0), begin, word in SECOND_PERSON, odd

    def __call__(self, text: str) -> list[float]:
        runs = text.split()
        if len(self.memo) > self.most:  # bounds the memory
            self.memo.clear()
        memo = self.memo
        for r in set(runs):
            if r not in memo:
                memo[r] = self._weigh(r)
        values = [memo[r] for r in runs]
        n = len(runs)
        hits = [(i, v) for i, v in enumerate(values) if v[0] or v[1]]
        second = [i for i, v in enumerate(values) if v[2]]
        word_sum, begin_sum = sum(v[0] for _, v in hits), sum(v[1] for _, v in hits)
        near, nearest = 0, 50.0
        if hits and second:
            s = np.array(second)
            at = np.array([i for i, _ in hits])
            k = np.searchsorted(s, at)
            gap = np.minimum(np.abs(s[np.minimum(k, len(s) - 1)] - at), np.abs(s[np.maximum(k - 1, 0)] - at))
            near, nearest = int((gap <= 5).sum()), float(min(50, gap.min()))
        letters, upper = max(1, len(text)), len(text) - len(text.translate(_NO_CAPITALS))
        d = max(1, n)
        return [
            math.log1p(n), word_sum, word_sum / d, max((v[0] for _, v in hits), default=0.0), begin_sum, begin_sum / d, max((v[1] for _, v in hits), default=0.0),
            len(hits), len(hits) / d, len({runs[i] for i, _ in hits}),
            near, nearest, len(second) / d, upper / letters,
            sum(1 for r in runs if len(r) > 2 and r.isupper()) / d, text.count("!") / d, text.count("?") / d, sum(text.count(c) for c in "#*$%&@") / d,
            len(_MIXED.findall(text)) / d, sum(1 for _, v in hits if v[3]),
        ]


def learnable(id_col: str = "doc_id"):
    """Whether a row's label may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def _entries(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per text its distinct words (kind 0) and word beginnings (kind 1)."""
    entry, kind, label = [], [], []
    for raw, y in zip(texts(batch.column("text")), batch.column("y").to_pylist(), strict=True):
        ws = {w for w, _ in map(normal_word, set(raw.decode().split())) if len(w) > 2}
        bs = {w[:k] for w in ws for k in BEGINNINGS if len(w) >= k}
        entry += [*ws, *bs]
        kind += [0] * len(ws) + [1] * len(bs)
        label += [y] * (len(ws) + len(bs))
    return pa.RecordBatch.from_arrays([pa.array(entry, pa.string()), pa.array(kind, pa.int32()), pa.array(label, pa.int32())], ["entry", "kind", "y"])


def _lexicons(part: DataFrame, entries: int) -> tuple[dict[str, float], dict[str, float]]:
    """Counts of labelled texts per entry, summed before they are shuffled; the best entries alone come to the driver."""
    totals = part.agg(F.sum("y"), F.count(F.lit(1))).first()
    pos, n = int(totals[0] or 0), int(totals[1])
    counts = map_batches(part.select("text", "y"), _entries, "entry string, kind int, y int").groupBy("kind", "entry").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("n") - F.col("p") + 0.5) / (n - pos + 1))
    best = counts.withColumn("w", odds).where((F.col("n") >= MIN_TEXTS) & (F.col("w") >= MIN_LOG_ODDS)).orderBy(F.desc(F.col("w") * F.log1p("p")), "kind", "entry").limit(entries)
    found = best.collect()
    return {r["entry"]: r["w"] for r in found if r["kind"] == 0}, {r["entry"]: r["w"] for r in found if r["kind"] == 1}


class Model:
    """What fit() learned; small, and sent with the tasks."""

    def __init__(self, words: dict[str, float], begins: dict[str, float], trees: gbt.Trees, calibrate: gbt.Isotonic):
        self.words, self.begins, self.trees, self.calibrate = words, begins, trees, calibrate

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.calibrate(self.trees.raw(x)), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "toxic", text: str = "text", most_rows: int = TRAIN_ROWS, entries: int = LEXICON_ENTRIES) -> Model:
    """Learns from rows of labels whose id is learnable and that docs holds.

    Null labels and ids are ignored; of several labels of an id the greatest counts. Without labels, or with one class
    only, the model gives the smoothed base rate. most_rows, entries: bounds of what is learned from and of a lexicon.
    """
    chosen = labels.where(learnable(id_col) & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    # At most most_rows ids and labels: a few hundred KB, whatever the input.
    rows = text_of(docs, F.col(id_col).alias("id"), text=text).join(F.broadcast(chosen), "id")
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5)).cast("int")), "labelled")
    halves = [F.col("part").isin(0, 1), F.col("part").isin(2, 3)]
    made = [_features(rows.where(other), *_lexicons(rows.where(half), entries)) for half, other in (halves, halves[::-1])]
    words, begins = _lexicons(rows.where("part < 4"), entries)
    trees = gbt.fit(np.concatenate([x for x, _ in made]), np.concatenate([y for _, y in made]))
    x, y = _features(rows.where("part = 4"), words, begins)
    return Model(words, begins, trees, gbt.isotonic(trees.raw(x), y))


def _features(rows: DataFrame, words: dict[str, float], begins: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most TRAIN_ROWS rows, on the driver: a few MB."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        f = Featurizer(words, begins)
        x = [f(t.decode()) for t in texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], ["id", "y", "x"])

    got = map_batches(rows.select("id", "y", "text"), kernel, "id string, y int, x array<double>").toArrow().sort_by("id")
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return x, got.column("y").to_numpy()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): 0 to 1, higher where label 1 is likelier. Null and empty texts get the score of a text without words.

    Rows correspond one to one, repeated rows too; an empty table stays empty; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featurizer(model.words, model.begins)
        for batch in batches:
            if batch.num_rows:
                x = np.array([f(t.decode()) for t in texts(batch.column("text"))], float)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(x))], ["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return text_of(docs, F.col(id_col).alias("id"), text=text).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): fits on the learnable labels and scores every row of docs."""
    scored = score(docs, fit(docs, labels, id_col, text=text), id_col, text)
    return scored.select(id_col, F.coalesce(~learnable(id_col), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
