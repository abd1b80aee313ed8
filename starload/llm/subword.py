"""Quality scores from supervised subword embeddings.

A text is the mean of learned vectors: of its words, of its pairs of
neighbouring words and of the character n-grams of its words, each hashed into
a table of vectors.  A softmax over that mean gives the probability of every
label.  Vectors and softmax weights are learned together by stochastic gradient
descent in numpy, on a bounded sample of the labelled rows.

All hashing is done on arrays of code points, without a loop over words.  Case
and punctuation are kept, since they tell much of a text's quality.  A pair of
words is hashed by the difference of the words' hashes: neighbouring words that
are equal have the same vector, whichever word it is, so repetition can be
learned from few texts.

The softmax is linear in the mean, so for scoring each bucket's vector is
replaced by its contribution to each label's logit: the model sent to the tasks
is one number a bucket and label, whatever the size of the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import free_name, mix, rows_of, ship

#: Vectors are shared by the features of a bucket.
BUCKETS = 1 << 17

#: Length of a vector.
DIM = 12

#: Characters of the n-grams; a word's edges count as one character.
N_GRAMS = (3, 4, 5)

#: Code points of a text that are hashed at once.
PIECE = 1 << 20

#: Rows of a sample that leave the scan for each one that it takes.
SPARE = 4

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD, _PAIR = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_SHIFT = np.uint64(64 - (BUCKETS.bit_length() - 1))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> _SHIFT).astype(np.int32)


def _is_blank(code: np.ndarray) -> np.ndarray:
    return (code == 32) | ((code >= 9) & (code <= 13))


def _pieces(code: np.ndarray) -> Iterator[np.ndarray]:
    """The code points in stretches that end where a word ends."""
    at = 0
    while len(code) - at > PIECE:
        blanks = np.flatnonzero(_is_blank(code[at + PIECE : at + 2 * PIECE]))
        cut = at + PIECE + (int(blanks[0]) if len(blanks) else PIECE)
        yield code[at:cut]
        at = cut
    yield code[at:]


def _word_hashes(code: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """A hash of each word of a stretch that begins and ends with a blank."""
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE))
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = (code[~blank] + np.uint64(1)) * powers[place]
    return np.add.reduceat(letters, np.cumsum(lengths) - lengths)


def features(text: str | None) -> np.ndarray:
    """Buckets of all words, pairs of words and character n-grams of a whole
    text, repeats included; none of a text without words."""
    if not text:
        return np.zeros(0, np.int32)
    found, last = [], None
    for piece in _pieces(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")):
        code = np.full(len(piece) + 2, 32, np.uint64)
        code[1:-1] = piece
        blank = _is_blank(code)
        code[blank] = 32
        words = _word_hashes(code, blank)
        if not len(words):
            continue
        found.append(_bucket(words + _WORD))
        row = words if last is None else np.concatenate((last, words))
        found.append(_bucket(row[1:] - row[:-1] + _PAIR))
        last = words[-1:]
        inner = np.concatenate(([0], np.cumsum(blank)))
        gram = code
        for n in range(2, max(N_GRAMS) + 1):
            gram = gram[:-1] * _BASE + code[n - 1 :]
            if n in N_GRAMS and len(gram):
                whole = inner[n - 1 : len(gram) + n - 1] == inner[1 : len(gram) + 1]
                found.append(_bucket(gram[whole] + np.uint64(n)))
            if not len(gram):
                break
    return np.concatenate(found) if found else np.zeros(0, np.int32)


@dataclass(frozen=True)
class Model:
    """Logit of each label as ``bias + mean over features of table``."""

    labels: tuple[int, ...]
    bias: np.ndarray
    table: np.ndarray = field(repr=False)

    def probabilities(self, text: str | None) -> np.ndarray:
        at = features(text)
        logits = self.bias + (self.table[at].mean(axis=0, dtype=np.float64) if len(at) else 0.0)
        odds = np.exp(logits - logits.max())
        return odds / odds.sum()


def train(
    samples: list[tuple[np.ndarray, np.ndarray, int]],
    shares: dict[int, float],
    epochs: int = 8,
    rate: float = 1.0,
    dim: int = DIM,
    seed: int = 7,
) -> Model:
    """Stochastic gradient descent over ``(buckets, weights, label)``, the weights
    of a text adding up to 1, with a rate that falls to zero.

    ``shares`` are the labels' shares of all labelled rows: labels are sampled
    evenly, and the bias is moved back to the real shares in the end.
    """
    labels = tuple(sorted({y for *_, y in samples}))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights = np.zeros((len(labels), dim), np.float32)
    bias = np.zeros(len(labels), np.float32)
    target = np.eye(len(labels), dtype=np.float32)
    step, steps = 0, epochs * len(samples)
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            at, share, label = samples[k]
            now = rate * (1 - step / steps)
            step += 1
            own = vectors[at]
            mean = share @ own
            logits = weights @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum() - target[labels.index(label)]
            back = error @ weights
            weights -= now * np.outer(error, mean)
            bias -= now * error
            # a feature's share of a text is small; its own step is scaled to the largest one
            vectors[at] = own - (now / share.max()) * share[:, None] * back
    got = np.array([sum(1 for *_, y in samples if y == label) for label in labels]) / max(1, len(samples))
    wanted = np.array([shares[label] for label in labels])
    return Model(labels, (bias + np.log(wanted / got)).astype(np.float64), vectors @ weights.T)


def _sampled(batches):
    import pyarrow as pa

    for batch in batches:
        rows = []
        for text, label in rows_of(batch):
            at, n = np.unique(features(text), return_counts=True)
            if len(at):
                rows.append((at.tobytes(), (n / n.sum()).astype(np.float32).tobytes(), label))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.int64()))],
            ["buckets", "weights", "label"],
        )


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    rows_per_label: int = 800,
    bytes_per_label: int = 16 << 20,
    max_labels: int = 16,
    **training,
) -> Model:
    """A model from ``docs`` (``id, text``) and ``labels`` (``id, label``).

    The sample that is learned from is bounded by these parameters: of each label
    the first ``rows_per_label`` rows in the order of a hash of their identifier,
    as long as their whole texts have at most ``bytes_per_label`` bytes together;
    an error is raised above ``max_labels`` labels.  Nothing else is bounded: every
    labelled row can be drawn, and texts are taken whole.  Features are made in the
    tasks; the driver gets the sample's buckets and weights.

    Rows without an identifier, label or word teach nothing; of repeated rows
    one is taken; an identifier with two labels teaches both.  No rows at all
    give a model without labels.
    """
    ship(spark)
    known = labels.select("id", F.col("label").cast("long").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull())
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not counts:
        return Model((), np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    size = F.create_map(*[F.lit(x) for r in counts for x in (r.label, r.n)])[F.col("label")]
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 31)) / float(1 << 31)
    # a few times the rows wanted of each label, however many it has
    drawn = known.withColumn("draw", draw).where(F.col("draw") * size < SPARE * rows_per_label).distinct()
    texts = docs.select("id", "text").join(F.broadcast(drawn), "id").where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    once = texts.withColumn("same", F.xxhash64("text")).dropDuplicates(["label", "id", "same"])
    turn = Window.partitionBy("label").orderBy("draw", "id", "same")
    kept = once.select(
        "text", "label", F.row_number().over(turn).alias("n"),
        F.sum(F.octet_length("text")).over(turn.rowsBetween(Window.unboundedPreceding, 0)).alias("b"),
    ).where((F.col("n") <= rows_per_label) & (F.col("b") <= bytes_per_label))
    rows = kept.select("text", "label").mapInArrow(_sampled, "buckets binary, weights binary, label long").collect()
    samples = sorted(
        ((r.buckets, r.weights, r.label) for r in rows)
    )  # in an order of their own, whichever task was first
    total = sum(r.n for r in counts)
    return train(
        [(np.frombuffer(a, np.int32), np.frombuffer(w, np.float32), y) for a, w, y in samples],
        {r.label: r.n / total for r in counts}, **training,
    ) if samples else Model((), np.zeros(0), np.zeros((BUCKETS, 0), np.float32))


def score(
    spark: SparkSession, docs: DataFrame, model: Model, label: int, text: str = "text", name: str = "score"
) -> DataFrame:
    """``docs`` plus the probability of ``label``, in a column ``name``.

    Whole texts are scored, in pieces.  A text that is null, empty or without a
    word has no features and gets the label's share among the labelled rows as
    training left it.  Without a single label the probability is 0.5; a label that
    was never seen has 0.  Equal texts get equal scores, repeated rows stay, an
    empty table stays empty, and a column called ``name`` is replaced.
    """
    ship(spark)
    if not model.labels:
        return docs.withColumn(name, F.lit(0.5))
    if label not in model.labels:
        return docs.withColumn(name, F.lit(0.0))
    place = model.labels.index(label)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([float(model.probabilities(t)[place]) for t in texts], dtype="float64")

    at = free_name(docs, "_score")
    return docs.withColumn(at, probability(F.col(text))).withColumn(name, F.col(at)).drop(at)
