"""Language-model scores as masked pseudo-likelihood.

A small network predicts every word class from the classes on both sides: the vectors of ``REACH`` neighbours to each
side, one table per distance, are summed, and a softmax layer gives the conditional probabilities. The score of a text is
the sum of the log-probabilities of its words, each one masked in turn.

Word classes are the most frequent words of the whole corpus, and hashed classes for the rest. A word of a hashed class is
predicted in two steps: its class by the network, then the word in its class by its share of the class in the whole corpus.
The counts of all words stay a Spark table, which grows with the corpus; only those of frequent words travel with the tasks.

Training reads all rows:
each task runs plain gradient steps in numpy over its texts, starting from the shared weights, and the weights of all tasks
are averaged by their number of words, with sums by Spark; a round is one such pass.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenlake.llm.common import chunks, table, without
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

# Fixed sizes of the network: classes with a word of their own, all classes (0 is beyond the text), vector width, neighbours.
OWN_CLASSES = 192
CLASSES = 256
WIDTH = 16
REACH = 2
ROUNDS = 2
RATE = 0.5
# Positions per gradient step, and those whose probabilities are held at a time, so that they stay in the processor's cache.
STEP = 4096
PART = 512
# Logits up to this need no shift before single floats hold their exponentials.
SAFE = 60.0
HELD = 300_000
# Counts of words with at least this share of all occurrences travel with the tasks; so many words can have it at most.
SHARES = 400_000
# Added to each count of a word in its class, and to that of all unseen words together.
PLUS = 0.5
OFFSETS = [d for d in range(-REACH, REACH + 1) if d]


@dataclass(frozen=True)
class Network:
    """Class of each frequent word; input vectors by distance, output vectors and biases."""

    own: dict[str, int]
    inputs: np.ndarray  # distance, class, width
    outputs: np.ndarray  # class, width
    bias: np.ndarray  # class

    def flat(self) -> np.ndarray:
        return np.concatenate([self.inputs.ravel(), self.outputs.ravel(), self.bias])

    def with_flat(self, flat: np.ndarray) -> Network:
        a, b = self.inputs.size, self.inputs.size + self.outputs.size
        flat = flat.astype(np.float32)
        return Network(self.own, flat[:a].reshape(self.inputs.shape), flat[a:b].reshape(self.outputs.shape), flat[b:].copy())


@dataclass(frozen=True)
class Model:
    """A network, and what predicts a word within its class."""

    net: Network
    words: DataFrame  # word, n: all words of the corpus
    n_words: int  # rows of ``words``
    frequent: dict[str, int]  # counts of frequent words
    totals: np.ndarray  # class: log of the smoothed count of its words; 0 for a class of one own word


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def hashed_class(word: str) -> int:
    return 1 + OWN_CLASSES + zlib.crc32(word.encode("utf-8", "replace")) % (CLASSES - 1 - OWN_CLASSES)


class _Codes(dict):
    """A number for each word: the given one, else less than 0, minus its hashed class."""

    def __missing__(self, word: str) -> int:
        return -hashed_class(word)

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def classes_of(words: list[str], own: dict[str, int]) -> np.ndarray:
    """Class ids of words."""
    return np.abs(_Codes(own).of(words))


def _neighbours(ids: np.ndarray) -> np.ndarray:
    padded = np.pad(ids, REACH)
    return np.stack([padded[REACH + d : REACH + d + len(ids)] for d in OFFSETS])


def _widened(net: Network) -> np.ndarray:
    """Output vectors with their biases as one more column."""
    return np.concatenate([net.outputs, net.bias[:, None]], axis=1)


def _hidden(net: Network, near: np.ndarray) -> np.ndarray:
    """Sums of the vectors of the neighbours, and a 1 that meets the bias."""
    hidden = np.ones((near.shape[1], WIDTH + 1), net.inputs.dtype)
    sums = net.inputs[0].take(near[0], axis=0)
    for d in range(1, len(OFFSETS)):
        sums += net.inputs[d].take(near[d], axis=0)
    hidden[:, :WIDTH] = sums
    return hidden


def _logits(hidden: np.ndarray, outputs: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Logits of each class at each position, shifted where single floats could not hold their exponentials."""
    logits = np.matmul(hidden, outputs.T, out=out)
    # By Cauchy and Schwarz; beyond, the highest of each position becomes 0.
    if float(np.einsum("ij,ij->i", hidden, hidden).max()) * float(np.einsum("ij,ij->i", outputs, outputs).max()) > SAFE**2:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


class _Scratch:
    """Arrays that each step of the network fills anew."""

    def __init__(self):
        self.tables = np.empty((len(OFFSETS), CLASSES, CLASSES), np.float32)
        self.products = np.empty((2, PART, CLASSES), np.float32)
        self.columns = np.empty((WIDTH + 1, STEP))


def _tables(net: Network, out: np.ndarray) -> np.ndarray | None:
    """Exponentials of what each class at each distance adds to each logit, biases with the first; None where products might leave single floats.

    A logit is a sum over the neighbours, so its exponential is a product of entries: far fewer exponentials than positions times classes.
    """
    np.matmul(net.inputs.reshape(-1, WIDTH), net.outputs.T, out=out.reshape(-1, CLASSES))
    out[0] += net.bias
    if not sum(max(float(t.max()), -float(t.min())) for t in out) <= SAFE:
        return None
    return np.exp(out, out=out)


def _products(tables: np.ndarray, near: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Exponentials of the logits of each class at each position, in the first of two ``held`` blocks."""
    found, factor = held[:, : near.shape[1]]
    # Ids are in range; by "clip" no copy is made.
    np.take(tables[0], near[0], axis=0, out=found, mode="clip")
    for d in range(1, len(OFFSETS)):
        np.take(tables[d], near[d], axis=0, out=factor, mode="clip")
        found *= factor
    return found


def log_likelihoods(net: Network, ids: np.ndarray, near: np.ndarray, scratch: _Scratch | None = None) -> np.ndarray:
    """Log-probability of each class given both sides; with ``scratch``, by the tables of the network there."""
    out, outputs = np.empty(len(ids)), _widened(net)
    if scratch is not None:
        tables = scratch.tables
        held, ones = scratch.products, np.ones(CLASSES, tables.dtype)
        for at in range(0, len(ids), PART):
            part = ids[at : at + PART]
            found = _products(tables, near[:, at : at + PART], held)
            out[at : at + PART] = np.log(found[np.arange(len(part)), part].astype(np.float64) / (found @ ones))
        return out
    for at in range(0, len(ids), PART):
        part = ids[at : at + PART]
        logits = _logits(_hidden(net, near[:, at : at + PART]), outputs)
        own = logits[np.arange(len(part)), part]
        out[at : at + PART] = own - np.log(np.exp(logits, out=logits).sum(axis=1))
    return out


def pseudo_likelihood(net: Network, ids: np.ndarray) -> float:
    """Sum over all words of the log-probability given both sides."""
    return float(log_likelihoods(net, ids, _neighbours(ids)).sum())


def _sums_by_class(ids: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums of columns, a row each, over the positions of each class."""
    ids = ids.astype(np.intp)
    return np.stack([np.bincount(ids, column, CLASSES) for column in columns], axis=1)


def gradient_step(net: Network, ids: np.ndarray, near: np.ndarray, rate: float, scratch: _Scratch | None = None) -> None:
    """One step of descent on the mean negative log-probability, in place, for up to ``STEP`` positions."""
    scratch = scratch or _Scratch()
    # The probabilities stay undivided: a column of ones sums them on the way, and the words themselves are taken off at the end.
    outputs = _widened(net)
    summing = np.concatenate([net.outputs, np.ones((CLASSES, 1), net.outputs.dtype)], axis=1)
    grown = np.zeros_like(outputs)
    hidden, back = _hidden(net, near), np.empty((len(ids), WIDTH), net.outputs.dtype)
    for at in range(0, len(ids), PART):
        part = hidden[at : at + PART]
        found = _logits(part, outputs, scratch.products[0, : len(part)])
        np.exp(found, out=found)
        sums = found @ summing
        back[at : at + PART] = sums[:, :WIDTH] / sums[:, WIDTH:]
        grown += found.T @ (part / sums[:, WIDTH:])
    back -= net.outputs.take(ids, axis=0)
    step = rate / len(ids)
    columns = scratch.columns[:, : len(ids)]
    columns[:] = hidden.T
    grown = step * (grown - _sums_by_class(ids, columns))
    net.outputs[:] -= grown[:, :WIDTH]
    net.bias[:] -= grown[:, WIDTH]
    columns = columns[:WIDTH]
    columns[:] = back.T
    for d in range(len(OFFSETS)):
        net.inputs[d] -= (step * _sums_by_class(near[d], columns)).astype(net.inputs.dtype)


def _word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all rows, with counts combined in each task."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) > HELD:
                    yield out()
                    held = Counter()
        if held:
            yield out()

    return docs.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _class_totals(words: DataFrame, own: dict[str, int]) -> tuple[int, np.ndarray]:
    """Number of all words, and the log of the smoothed count of the words of each hashed class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            ids = classes_of(batch.column(0).to_pylist(), own)
            np.add.at(seen, ids, batch.column(1).to_numpy())
            np.add.at(kinds, ids, 1)
        yield pa.record_batch([pa.array(np.arange(CLASSES)), pa.array(seen), pa.array(kinds)], names=["class", "seen", "kinds"])

    sums = words.mapInArrow(count, "class long, seen long, kinds long").groupBy("class").agg(F.sum("seen").alias("seen"), F.sum("kinds").alias("kinds"))
    seen, kinds = np.zeros(CLASSES), np.zeros(CLASSES, np.int64)
    for r in sums.collect():
        seen[r["class"]], kinds[r["class"]] = r["seen"], r["kinds"]
    totals = np.log(seen + PLUS * (kinds + 1))
    totals[: 1 + OWN_CLASSES] = 0
    return int(kinds.sum()), totals


def train_network(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, seed: int = 7) -> Model:
    """A model of the texts of ``docs``; the same rows in the same partitions give the same one up to rounding.

    NULL and empty texts add nothing; without words the network stays as it began.
    """
    words = Workspace(docs.sparkSession, "lm-score").save(_word_counts(docs, text_col), "words")
    own = {r["word"]: at + 1 for at, r in enumerate(words.orderBy(F.desc("n"), "word").limit(OWN_CLASSES).collect())}
    n_words, totals = _class_totals(words, own)
    occurrences = words.agg(F.sum("n")).first()[0] or 0
    frequent = {r["word"]: r["n"] for r in words.filter(F.col("n") * SHARES >= occurrences).collect()}
    # Classes of frequent words need not be computed place by place.
    known = docs.sparkSession.sparkContext.broadcast({w: hashed_class(w) for w in frequent} | own)
    rng = np.random.default_rng(seed)
    net = Network(
        own,
        rng.normal(0, 0.1, (len(OFFSETS), CLASSES, WIDTH)).astype(np.float32),
        rng.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32),
        np.zeros(CLASSES, np.float32),
    )
    for round_number in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(net)

        def fit(batches: Iterator[pa.RecordBatch], shared=shared, rate=RATE / (1 + round_number)) -> Iterator[pa.RecordBatch]:
            mine = shared.value.with_flat(shared.value.flat())
            codes, scratch = _Codes(known.value), _Scratch()
            held, positions, seen = [], 0, 0

            def learn() -> None:
                ids, near = np.concatenate(held), np.concatenate([_neighbours(x) for x in held], axis=1)
                for at in range(0, len(ids), STEP):
                    gradient_step(mine, ids[at : at + STEP], near[:, at : at + STEP], rate, scratch)

            for batch in batches:
                for text in batch.column(0):
                    ids = np.abs(codes.of(words_of(text.as_py())))
                    seen, positions = seen + len(ids), positions + len(ids)
                    held.append(ids)
                    if positions >= STEP:
                        learn()
                        held, positions = [], 0
            if positions:
                learn()
            if seen:
                flat = mine.flat().astype(np.float64) * seen
                yield pa.record_batch(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat), pa.array(np.full(len(flat), seen, np.int64))],
                    names=["at", "value", "words"],
                )

        parts = docs.select(text_col).mapInArrow(fit, "at int, value double, words long")
        # As many rows as the network has weights.
        mean = parts.groupBy("at").agg((F.sum("value") / F.sum("words")).alias("value")).collect()
        if not mean:
            break
        flat = np.empty(len(mean))
        flat[[r["at"] for r in mean]] = [r["value"] for r in mean]
        net = net.with_flat(flat)
    return Model(net, words, n_words, frequent, totals)


class _Scorer:
    """Scores texts by what a model sends along with the tasks; several short texts share the steps of the network."""

    def __init__(self, net: Network, frequent: dict[str, int], totals: np.ndarray):
        self.net, self.totals, self.scratch = net, totals, _Scratch()
        # Without tables the probabilities are computed from the logits.
        if _tables(net, self.scratch.tables) is None:
            self.scratch = None
        # Numbers of words: classes for own ones, then all frequent ones.
        self.codes = _Codes({w: CLASSES + at for at, w in enumerate(frequent)} | net.own)
        self.classes = np.concatenate([np.arange(CLASSES), np.fromiter(map(hashed_class, frequent), np.int64, len(frequent))])
        self.logs = np.concatenate([np.zeros(CLASSES), np.log(np.fromiter(frequent.values(), np.float64, len(frequent)) + PLUS)])

    def scores(self, texts: list[str | None]) -> list[dict]:
        """Number of words, log-probability without that of the others within their classes, and the others, of each text."""
        out, held, positions = [], [], 0
        for text in texts:
            words = words_of(text)
            codes = self.codes.of(words)
            out.append({"n": len(words), "sum": 0.0, "others": [words[at] for at in np.flatnonzero(codes < 0).tolist()]})
            held.append(codes)
            positions += len(codes)
            if positions >= STEP:
                self._add(out[-len(held) :], held)
                held, positions = [], 0
        if positions:
            self._add(out[-len(held) :], held)
        return out

    def _add(self, rows: list[dict], held: list[np.ndarray]) -> None:
        codes = np.concatenate(held)
        known = np.maximum(codes, 0)
        ids = np.where(codes < 0, -codes, self.classes[known])
        sizes = [len(x) for x in held]
        near = np.concatenate([_neighbours(x) for x in np.split(ids, np.cumsum(sizes)[:-1])], axis=1)
        each = log_likelihoods(self.net, ids, near, self.scratch) + self.logs[known] - self.totals[ids]
        for row, total in zip(rows, np.bincount(np.repeat(np.arange(len(held)), sizes), each, len(held)).tolist()):
            row["sum"] = total


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words (BIGINT), log_likelihood (the sum) and mean_log_likelihood (per word).

    A word that the corpus of the model has not seen shares the rest of its class with as many others as there are words.
    NULL, empty and wordless texts have 0 words, sum 0 and a NULL mean. Every input row gives one row; columns with
    the names of added ones are replaced.
    """
    added = ("n_words", "log_likelihood", "mean_log_likelihood")
    clean = without(docs, added)
    shared = docs.sparkSession.sparkContext.broadcast((model.net, model.frequent, model.totals))
    kind = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("sum", T.DoubleType()), T.StructField("others", T.ArrayType(T.StringType()))]
    )

    out_type = to_arrow_type(kind)
    ship_package(docs.sparkSession)

    @F.arrow_udf(kind)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(*shared.value)
        for batch in batches:
            parts = [pa.array(scorer.scores(part.to_pylist()), out_type) for part in chunks(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], out_type)

    # Written first, so that the numbers of rows hold and each text is scored once.
    scored = clean.withColumn("_row", F.monotonically_increasing_id()).withColumn("_s", score(F.col(text_col)))
    scored = Workspace(docs.sparkSession, "lm-score").save(scored, "scored")
    # Counts of words that are not frequent are looked up by a join; no such word has many of the rows.
    others = scored.select("_row", F.explode("_s.others").alias("word")).join(model.words, "word", "left")
    log = F.when(F.col("n").isNull(), F.lit(float(np.log(PLUS) - np.log(model.n_words + 1)))).otherwise(F.log(F.col("n") + F.lit(PLUS)))
    others = others.groupBy("_row").agg(F.sum(log).alias("_others"))
    total = F.col("_s.sum") + F.coalesce("_others", F.lit(0.0))
    mean = F.when(F.col("_s.n") > 0, total / F.col("_s.n"))
    return scored.join(others, "_row", "left").select(*clean.columns, F.col("_s.n").alias(added[0]), total.alias(added[1]), mean.alias(added[2]))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, summed and mean conditional log-probability under a network trained on all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, train_network(docs)).select("doc_id", "n_words", "log_likelihood", "mean_log_likelihood")
