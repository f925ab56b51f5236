"""Toxicity scores by a factorization machine over hashed terms.

Terms are lowered words and their beginnings, hashed to 32 bits. The machine adds, to
the weights of the terms of a text, the inner products of their factors, pair by pair:
a word that is harmless by itself can weigh in the company of another.

Fitting takes a sample of at most ``sample_rows`` labelled rows, chosen by a hash of the
id. Terms are counted on Spark over the whole texts of the sample; only the chosen terms
and the sample's vectors of them reach the driver, both bounded by parameters. Scoring
is row by row over whole texts, with a model of bounded size.

Null and empty texts get the score of no terms. Rows with a null label or id aren't
learned from; of ids with several labels, the highest counts. Without labels of both
kinds, the share of toxic labels is every text's score (sigmoid(-30) without any label).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.llm.common import add_columns, chunks, row_type, staged, texts_of, tidied

WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
#: Bound of the table of recent words.
CACHED_WORDS = 100_000


def hashed_terms(word: str) -> list[int]:
    """A word and its beginnings as 32-bit hashes; beginnings differ from equal words."""
    out = [zlib.crc32(word.encode())]
    return out + [zlib.crc32(f"{word[:n]}*".encode()) for n in BEGINNINGS if len(word) > n]


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


@dataclass(frozen=True)
class Model:
    """Chosen terms, sorted; their weights and factors; and the constant."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    constant: float

    def logit(self, places: np.ndarray) -> float:
        factors = self.factors[places]
        pairs = 0.5 * (np.square(factors.sum(axis=0)) - np.square(factors).sum(axis=0)).sum()
        return float(self.constant + self.weights[places].sum() + pairs)


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def held_out(doc_id: str) -> Column:
    """The rows that are never learned from: a quarter, by the CRC of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(labels: DataFrame, rows: int, label: str = "toxic") -> DataFrame:
    """At most ``rows`` labelled ids that may be learned from: ``doc_id``, ``label``."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    single = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return single.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def term_rows(docs: DataFrame) -> DataFrame:
    """``label`` and ``terms`` (distinct hashes, as long) of each labelled text."""
    schema = row_type(label="integer", terms=T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            terms = [sorted({t for w in words_of(x) for t in hashed_terms(w)}) for x in texts_of(batch, "text")]
            label = batch.column(batch.schema.get_field_index("label"))
            yield pa.RecordBatch.from_arrays([label, pa.array(terms, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("label", "text").mapInArrow(tidied(run), schema)


def choose_terms(rows: DataFrame, telling: int, frequent: int, least: int = 3) -> tuple[np.ndarray, int, int]:
    """The terms that tell the labels apart best, and the most frequent: sorted hashes.

    Also the number of rows and of toxic ones.
    """
    total, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    if not total:
        return np.zeros(0, np.int64), 0, 0
    share = (toxic or 0) / total
    counted = rows.select("label", F.explode("terms").alias("term")).groupBy("term")
    counted = counted.agg(F.count("*").alias("n"), F.sum("label").alias("t")).filter(F.col("n") >= least)
    spread = F.lit(max(share * (1 - share), 1e-9)) * F.col("n") * (1 - F.col("n") / (total + 1))
    score = (F.col("t") - F.col("n") * share) * F.abs(F.col("t") - F.col("n") * share) / spread
    counted = counted.withColumn("score", F.abs(score))
    best = counted.filter("score > 12").orderBy(F.desc("score"), "term").limit(telling).select("term")
    common = counted.orderBy(F.desc("n"), "term").limit(frequent).select("term")
    found = best.union(common).distinct().toArrow()["term"].to_numpy()
    return np.sort(found.astype(np.int64)), int(total), int(toxic or 0)


def vectors(rows: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and the places of the chosen terms of every row, on the driver."""
    schema = row_type(label="integer", places=T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "terms"):
            lists = batch.column(batch.schema.get_field_index("terms")).to_numpy(zero_copy_only=False)
            places = []
            for own in lists:
                at = np.searchsorted(terms, own)
                at = at[(at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == own)]
                places.append(at.astype(np.int32))
            label = batch.column(batch.schema.get_field_index("label"))
            yield pa.RecordBatch.from_arrays([label, pa.array(places, pa.list_(pa.int32()))], names=schema.names)

    table = rows.mapInArrow(tidied(run), schema).toArrow().combine_chunks()
    labels = table["label"].to_numpy().astype(np.float64)
    lists = table["places"].to_numpy(zero_copy_only=False) if len(labels) else []
    # The order in which rows arrive varies; that of the fit must not.
    order = sorted(range(len(labels)), key=lambda i: (zlib.crc32(lists[i].tobytes()), labels[i], lists[i].tobytes()))
    return labels[order], [lists[i] for i in order]


def train(
    labels: np.ndarray, places: list[np.ndarray], terms: np.ndarray, factors: int = 8,
    epochs: int = 12, steps: int = 600, batch: int = 256, rate: float = 0.1, penalty: float = 2e-5, seed: int = 7,
) -> Model:
    """Fit by AdaGrad on the logistic loss: so many epochs, and so many steps at least."""
    epochs = max(epochs, -(-steps * batch // max(1, len(labels))))
    rng = np.random.default_rng(seed)
    n, share = len(terms), float(np.clip(labels.mean(), 1e-4, 1 - 1e-4))
    w, v, constant = np.zeros(n), rng.normal(0, 0.01, (n, factors)), float(np.log(share / (1 - share)))
    w_sum, v_sum, c_sum = np.full(n, 1e-6), np.full((n, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            sizes = np.array([len(places[i]) for i in rows])
            at = np.concatenate([places[i] for i in rows]) if sizes.sum() else np.zeros(0, np.int32)
            row = np.repeat(np.arange(len(rows)), sizes)
            own = v[at]
            sums = np.zeros((len(rows), factors))
            np.add.at(sums, row, own)
            squares = np.bincount(row, np.square(own).sum(axis=1), minlength=len(rows))
            logit = constant + np.bincount(row, w[at], minlength=len(rows)) + 0.5 * (np.square(sums).sum(axis=1) - squares)
            error = (sigmoid(logit) - labels[rows]) / len(rows)
            used, place = np.unique(at, return_inverse=True)
            w_step = np.bincount(place, error[row], minlength=len(used)) + penalty * w[used]
            v_step = np.zeros((len(used), factors))
            np.add.at(v_step, place, error[row][:, None] * (sums[row] - own))
            v_step += penalty * v[used]
            w_sum[used] += np.square(w_step)
            v_sum[used] += np.square(v_step)
            w[used] -= rate * w_step / np.sqrt(w_sum[used])
            v[used] -= rate * 0.3 * v_step / np.sqrt(v_sum[used])
            c_step = error.sum()
            c_sum += c_step**2
            constant -= rate * c_step / np.sqrt(c_sum)
    return Model(terms, w.astype(np.float32), v.astype(np.float32), constant)


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, telling: int = 4_096, frequent: int = 256,
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """Learn from labelled documents; at most ``sample_rows`` of them."""
    chosen = sample(labels, sample_rows, label).withColumnRenamed("doc_id", "__id")
    source = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("text"))
    # The sample's ids have a size bound: sample_rows times a few bytes.
    # Of several texts of an id, always the same one.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    joined = source.join(F.broadcast(chosen), "__id").groupBy("__id").agg(F.first("label").alias("label"), one)
    rows = staged(term_rows(joined), "terms")
    terms, total, toxic = choose_terms(rows, telling, frequent)
    if not 0 < toxic < total:
        share = toxic / total if total else 0.0
        constant = 30.0 if share == 1 else -30.0
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros((0, 1), np.float32), constant)
    return train(*vectors(rows, terms), terms)


def score(docs: DataFrame, model: Model, text: str = "text", drop_text: bool = False, result: str = "score") -> DataFrame:
    """Add ``result`` (double, 0 to 1: higher is more toxic)."""

    def make() -> Callable:
        place = {int(t): i for i, t in enumerate(model.terms)}
        recent: dict[str, tuple[int, ...]] = {}
        none = np.zeros(0, np.int64)

        def one(text: str) -> float:
            found: set[int] = set()
            for word in words_of(text):
                places = recent.get(word)
                if places is None:
                    places = tuple(place[t] for t in hashed_terms(word) if t in place)
                    if len(recent) >= CACHED_WORDS:
                        recent.clear()
                    recent[word] = places
                if places:
                    found.update(places)
            return float(sigmoid(model.logit(np.array(sorted(found)) if found else none)))

        return lambda texts: [[one(t) for t in texts]]

    return add_columns(docs, text, row_type(**{result: "double"}), make, drop=[text] if drop_text else ())
