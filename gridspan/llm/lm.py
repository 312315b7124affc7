"""Language-model scores from a log-bilinear model.

The model predicts a word from the two words before: for each of the two places the score of
word w after context h is the product of h's context vector and w's vector, plus w's bias,
and a learned weight mixes the places' probabilities. Its vocabulary is the most frequent
training words, as many as grow with the root of the distinct words, the end of a text, and
one entry for all other words; among those other words probability goes by their smoothed
counts. It is trained in numpy by noise-contrastive estimation on all training texts. Exact
normalisers for all contexts come from batched matrix products.

Texts are dealt to learners by a hash of their ids, about LEARNER tokens to each, so what a
learner sees depends on the corpus and not on how its files are split. In each round every
learner starts from the same parameters and step sizes, learns from its share, and the
results are averaged by tokens seen.

Word counts are those of all training texts. The most frequent ones travel with the tasks,
a bounded table; counts of the remaining words are joined by a shuffle.

A missing text is an empty one: its only token is the end. A row without an id is training
text. Rows that repeat an id and text get equal scores, and are dealt apart. Without training
tokens every count is 0 and the model knows the end and unseen words only. Only doc_id and
text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan.llm.frames import held_out, lists, slices
from gridspan.llm.mixing import with_copy
from gridspan.session import materialize

#: Stands for the end of a text among words, which are never empty.
END = ""
#: Words whose counts travel with the tasks; about 20 bytes each.
FREQUENT = 200_000
#: Distinct words that a counting task holds before it passes their counts on.
HELD_WORDS = 200_000
#: Words whose scores are computed at a time.
SCORED = 1 << 15


@dataclass(frozen=True)
class Settings:
    """Parameters of the model and of its training."""

    words: int = 4096  # fewest words of the vocabulary, where there are so many
    growth: float = 4.0  # times the root of the number of distinct words, if that is more
    places: int = 2  # words of context
    size: int = 16
    noise: int = 25  # noise words per word
    always: int = 32  # the most frequent words stand in every noise sample, with their share
    drawn: int = 64  # of the rest so many are drawn for a batch
    batch: int = 2048
    rate: float = 0.1
    rounds: int = 3
    passes: int = 1
    learner: int = 8_000_000  # tokens dealt to a learner
    block: int = 1_000_000  # tokens whose word pairs are counted before they are learned
    seed: int = 7

    def vocabulary(self, distinct: int) -> int:
        return max(self.words, int(self.growth * distinct**0.5))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(held: Counter) -> pa.RecordBatch:
        names = pa.array(list(held), pa.binary()).cast(pa.string())
        counts = pa.array(np.fromiter(held.values(), np.int64, len(held)))
        return pa.RecordBatch.from_arrays([names, counts], ["word", "c"])

    held: Counter = Counter()
    for batch in batches:
        for _, texts in slices(batch, "text"):
            for text in texts:
                held.update(text.lower().split())
            held[END.encode()] += len(texts)
            if len(held) > HELD_WORDS:
                yield emit(held)
                held = Counter()
    yield emit(held)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all tokens of all texts."""
    parts = train.select("text").mapInArrow(_count, "word string, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words by descending count behind the end; the first `words` are the model's."""

    index: dict[bytes, int]
    counts: np.ndarray
    words: int
    tokens: int  # N
    distinct: int  # V

    @property
    def unseen_base(self) -> float:
        return float(self.tokens + self.distinct + 1)

    @property
    def others(self) -> tuple[int, int]:
        """Tokens and distinct words outside the model's vocabulary."""
        return self.tokens - int(self.counts[: self.words].sum()), self.distinct - int(
            (self.counts[: self.words] > 0).sum()
        )

    @property
    def others_base(self) -> float:
        tokens, distinct = self.others
        return float(tokens + distinct + 1)

    def unigram(self) -> np.ndarray:
        """Smoothed probabilities of the model's words and, last, of all others together."""
        c = np.append(self.counts[: self.words], self.others[0]) + 1.0
        return c / c.sum()

    def ids(self, text: bytes) -> tuple[list[bytes], np.ndarray]:
        own = text.lower().split()
        return own, np.fromiter(map(self.index.get, own, repeat(-1)), np.int64, len(own))

    def sequence(self, ids: np.ndarray, places: int) -> np.ndarray:
        """The model's entries for as many ends as there are places, the words and an end."""
        out = np.zeros(places + len(ids) + 1, np.int32)
        out[places:-1] = np.where((ids < 0) | (ids >= self.words), self.words, ids)
        return out


def vocabulary(counts: DataFrame, settings: Settings, frequent: int = FREQUENT) -> Vocabulary:
    """Out of a stored table of counts. At most `frequent` words reach the driver.

    Which these are follows from the sizes of classes of like counts, sixteen to a doubling:
    the highest classes that together have no more words, or of the highest one alone the
    words that come first. No task sends more than that.
    """
    totals = counts.agg(F.sum("c"), F.count("word")).first()
    ends = counts.filter(F.col("word") == END).agg(F.sum("c")).first()[0]
    classed = counts.filter(F.col("word") != END).withColumn(
        "class", F.floor(F.log2("c") * 16).cast("int")
    )
    sizes = classed.groupBy("class").count().orderBy(F.desc("class")).collect()
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > frequent:
            break
        least = r["class"]
    if least is None and sizes:
        highest = classed.filter(F.col("class") == sizes[0]["class"])
        top = highest.orderBy(F.desc("c"), "word").limit(frequent).collect()
    else:
        top = classed.filter(F.col("class") >= least).collect() if sizes else []
    top.sort(key=lambda r: (-r["c"], r["word"]))
    index = {r["word"].encode(): i for i, r in enumerate(top, 1)}
    own = np.array([ends or 0, *(r["c"] for r in top)], np.int64)
    words = settings.vocabulary(totals[1])
    return Vocabulary(index, own, min(words, len(own)), totals[0] or 0, totals[1])


@dataclass
class Model:
    context: np.ndarray
    word: np.ndarray
    bias: np.ndarray

    def log_normalisers(self) -> np.ndarray:
        """log of the sum over all words, for each context, by batched matrix products."""
        out = np.empty(len(self.bias))
        for a in range(0, len(out), 512):
            scores = self.context[a : a + 512] @ self.word.T + self.bias
            top = scores.max(axis=1)
            out[a : a + 512] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return out

    def scores(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        context, word = self.context.take(h, axis=0), self.word.take(w, axis=0)
        return np.einsum("ij,ij->i", context, word) + self.bias.take(w)

    def table(self) -> np.ndarray:
        return np.concatenate([self.context, self.word, self.bias[:, None]], axis=1)

    @staticmethod
    def of_table(values: np.ndarray) -> Model:
        d = values.shape[1] // 2
        parts = values[:, :d], values[:, d : 2 * d], values[:, -1]
        return Model(*(x.astype(np.float32, order="C") for x in parts))


def fresh(unigram: np.ndarray, settings: Settings, place: int = 0) -> Model:
    rng = np.random.default_rng([settings.seed, place])
    shape = (len(unigram), settings.size)
    context, word = rng.normal(0, 0.1, (2, *shape)).astype(np.float32)
    return Model(context, word, np.log(unigram).astype(np.float32))


@dataclass
class Mixture:
    """A model for each place of the context, the step sizes it was learned with, and weights."""

    models: list[Model]
    squares: list[Model]
    weights: np.ndarray

    @staticmethod
    def fresh(unigram: np.ndarray, settings: Settings) -> Mixture:
        models = [fresh(unigram, settings, k) for k in range(settings.places)]
        ones = [Model.of_table(np.ones_like(m.table())) for m in models]
        return Mixture(models, ones, np.full(settings.places, 1 / settings.places))

    def log_probabilities(self, sequences: np.ndarray, at: np.ndarray, log_z: list) -> np.ndarray:
        """Of the entries at the places `at` of joined sequences, each after its context."""
        w, total = sequences[at], None
        for k, (model, z) in enumerate(zip(self.models, log_z), 1):
            h = sequences[at - k]
            own = np.log(self.weights[k - 1]) + model.scores(h, w) - z[h]
            total = own if total is None else np.logaddexp(total, own)
        return total


class Trainer:
    """Noise-contrastive estimation with Adagrad, on counted word pairs."""

    def __init__(self, unigram: np.ndarray, settings: Settings, model: Model, squares: Model, seed: int = 1):
        self.settings = settings
        self.model, self.squares = (Model.of_table(m.table()) for m in (model, squares))
        self.rng = np.random.default_rng([settings.seed, seed])
        order = np.argsort(-unigram, kind="stable")
        self.always, self.rest = np.split(order, [min(settings.always, len(order))])
        self.cumulated = np.cumsum(unigram[self.rest])
        self.weight = settings.noise * unigram
        self.shift = np.log(settings.noise * unigram).astype(np.float32)

    def _grouped(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order that puts equal rows together, where each begins in it, and the rows."""
        small = rows.astype(np.uint16) if len(self.shift) <= 1 << 16 else rows  # sorted by radix
        order = np.argsort(small, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        return order, first, rows[first]

    def _move(self, name: str, grouped: tuple, gradient: np.ndarray) -> None:
        order, first, rows = grouped
        total = np.add.reduceat(gradient.take(order, axis=0), first, axis=0)
        squares = getattr(self.squares, name)
        squares[rows] += total * total
        getattr(self.model, name)[rows] += self.settings.rate * total / np.sqrt(squares[rows])

    def learn(self, h: np.ndarray, w: np.ndarray, n: np.ndarray) -> None:
        """Pairs of context and word with how often each occurs."""
        for _ in range(self.settings.passes):
            order = self.rng.permutation(len(h))
            for a in range(0, len(h), self.settings.batch):
                part = order[a : a + self.settings.batch]
                self._batch(h[part], w[part], n[part].astype(np.float32))

    def _noise(self) -> tuple[np.ndarray, np.ndarray]:
        """Noise words of a batch and how many of a word's noise words each stands for."""
        if not len(self.rest):
            return self.always, self.weight[self.always]
        mass, n = self.cumulated[-1], self.settings.drawn
        at = np.searchsorted(self.cumulated, self.rng.random(n) * mass)
        drawn = self.rest[np.minimum(at, len(self.rest) - 1)]
        weight = np.full(n, self.settings.noise * mass / n)
        return np.append(self.always, drawn), np.append(self.weight[self.always], weight)

    def _batch(self, h: np.ndarray, w: np.ndarray, n: np.ndarray) -> None:
        m, shift = self.model, self.shift
        noise, weight = self._noise()
        context, word, drawn = (x.take(i, axis=0) for x, i in ((m.context, h), (m.word, w), (m.word, noise)))
        data = np.einsum("ij,ij->i", context, word) + m.bias[w] - shift[w]
        off = context @ drawn.T + (m.bias[noise] - shift[noise])
        up = n / (1 + np.exp(data))
        down = (-n[:, None] * weight.astype(np.float32)) / (1 + np.exp(-off))
        self._move("context", self._grouped(h), up[:, None] * word + down @ drawn)
        words = self._grouped(np.concatenate([w, noise]))
        self._move("word", words, np.concatenate([up[:, None] * context, down.T @ context]))
        self._move("bias", words, np.concatenate([up, down.sum(axis=0)]))


def _sequences(shared, places: int):
    """Model entries of each text, with the ends before and behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = [v.sequence(v.ids(t)[1], places) for t in texts]
                joined = np.concatenate(rows)
                entries = lists(joined, np.array([len(r) for r in rows]))
                yield pa.RecordBatch.from_arrays([part.column(0), entries], ["k", "entries"])

    return run


def _parameters(settings: Settings) -> list[str]:
    return [f"p{i}" for i in range(2 * (2 * settings.size + 1))]


def _places(offsets: np.ndarray, places: int) -> np.ndarray:
    """Where the words and ends that are predicted stand in joined sequences."""
    counts = np.diff(offsets) - places
    starts = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(offsets[:-1] + places - starts, counts)


def _credit(models: list[Model], weights: np.ndarray, contexts: list, w: np.ndarray) -> np.ndarray:
    """Each place's share in the probabilities of all words `w`, added up."""
    total, shift = np.zeros(len(models)), np.log(weights).astype(np.float32)
    for a in range(0, len(w), SCORED):
        part = slice(a, a + SCORED)
        logs = [c + m.scores(h[part], w[part]) for c, m, h in zip(shift, models, contexts)]
        for k, own in enumerate(logs):
            others = sum((np.exp(x - own) for x in logs if x is not own), np.ones_like(own))
            total[k] += (1 / others).sum(dtype=np.float64)
    return total


def _learner(shared, state, settings: Settings, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        start: Mixture = state.value
        unigram, width, n = v.unigram(), v.words + 1, settings.places
        trainers = [
            Trainer(unigram, settings, m, s, turn * n + k)
            for k, (m, s) in enumerate(zip(start.models, start.squares))
        ]
        seen, held, credit = 0, [], np.zeros(n)

        def learn() -> None:
            w = np.concatenate([e[at] for e, at in held]).astype(np.int64)
            contexts = []
            for k, trainer in enumerate(trainers, 1):
                h = np.concatenate([e[at - k] for e, at in held]).astype(np.int64)
                pairs, count = np.unique(h * width + w, return_counts=True)
                trainer.learn(pairs // width, pairs % width, count)
                contexts.append(h)
            credit[:] += _credit([t.model for t in trainers], start.weights, contexts, w)
            held.clear()

        for batch in batches:
            column = batch.column(0)
            entries = column.flatten().to_numpy()
            offsets = column.offsets.to_numpy()
            at = _places(offsets - offsets[0], n)
            held.append((entries, at))
            seen += len(at)
            if sum(len(at) for _, at in held) >= settings.block:
                learn()
        if held:
            learn()
        for k, trainer in enumerate(trainers) if seen else ():
            values = np.concatenate([trainer.model.table(), trainer.squares.table()], axis=1)
            values = values * np.float64(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(width, k, np.int32)), pa.array(np.arange(width, dtype=np.int32)),
                 pa.array(np.full(width, float(seen))), pa.array(np.full(width, credit[k])),
                 *map(pa.array, np.ascontiguousarray(values.T))],
                ["place", "id", "seen", "credit", *_parameters(settings)],
            )

    return run


def dealt(train: DataFrame, shared, settings: Settings) -> tuple[DataFrame, int]:
    """Stored (k, entries) of all training texts, and how many learners they are for.

    `k` is a hash of the id, and of the row's place among those that repeat it.
    """
    rows = with_copy(train.select(
        "doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    ))
    rows = rows.select(F.xxhash64(F.col("doc_id").cast("string"), "copy").alias("k"), "text")
    own = rows.mapInArrow(_sequences(shared, settings.places), "k long, entries array<int>")
    learners = max(1, -(-shared.value.tokens // settings.learner))
    return materialize(own, "lm-entries"), learners


def trained(train: DataFrame, shared, settings: Settings) -> Mixture:
    """The model after all rounds. Its parameters, which reach the driver, are bounded by words."""
    names = _parameters(settings)
    state = Mixture.fresh(shared.value.unigram(), settings)
    if not shared.value.tokens:
        return state
    rows, learners = dealt(train, shared, settings)
    rows = rows.withColumn("learner", F.pmod("k", F.lit(learners)).cast("int"))
    rows = rows.repartitionById(learners, "learner").sortWithinPartitions("k", F.size("entries"))
    schema = "place int, id int, seen double, credit double, " + ", ".join(f"{p} double" for p in names)
    for turn in range(settings.rounds):
        started = train.sparkSession.sparkContext.broadcast(state)
        own = rows.select("entries").mapInArrow(_learner(shared, started, settings, turn), schema)
        mean = own.groupBy("place", "id").agg(
            *[(F.sum(p) / F.sum("seen")).alias(p) for p in names],
            (F.sum("credit") / F.sum("seen")).alias("credit"),
        )
        found = mean.orderBy("place", "id").toArrow()
        values = np.stack([found[p].to_numpy() for p in names], axis=1)
        values = values.reshape(settings.places, -1, len(names))
        half = len(names) // 2
        credit = found["credit"].to_numpy().reshape(settings.places, -1)[:, 0]
        state = Mixture(
            [Model.of_table(x[:, :half]) for x in values], [Model.of_table(x[:, half:]) for x in values],
            np.maximum(credit, 1e-6) / np.maximum(credit, 1e-6).sum(),
        )
        started.unpersist()
    return state


def _scorer(shared, learned):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        model, log_z = learned.value
        places = len(model.models)
        base = np.log10((v.counts + 1.0) / v.unseen_base)
        other = np.log10((v.counts + 1.0) / v.others_base)
        other[: v.words] = 0
        names = ["doc_id", "h", "held_out", "n_tokens", "n_known", "base", "score", "rare"]
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows, rare, rare_counts = [], [], []
                for text in texts:
                    own, ids = v.ids(text)
                    unknown = np.flatnonzero(ids < 0).tolist()
                    rare += [own[i] for i in unknown]
                    rare_counts.append(len(unknown))
                    rows.append(ids)
                sizes = np.array([len(x) + 1 for x in rows])
                starts = np.cumsum(sizes) - sizes
                steps = [v.sequence(x, places) for x in rows]
                offsets = np.cumsum([0, *map(len, steps)])
                entries, at = np.concatenate(steps), _places(offsets, places)
                ids = np.concatenate([np.append(x, 0) for x in rows])
                known = ids >= 0
                own_base = np.where(known, base[ids], 0)
                score = model.log_probabilities(entries, at, log_z) / np.log(10)
                score = score + np.where(known, other[ids], 0)
                sums = [np.add.reduceat(x, starts) for x in (own_base, score)]
                n_known = np.add.reduceat((known & (v.counts[ids] > 0)).astype(np.int64), starts)
                words = pa.array(rare, pa.binary()).cast(pa.string())
                ends = np.concatenate([[0], np.cumsum(rare_counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(sizes), pa.array(n_known),
                     *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(ends), words)],
                    names,
                )

    return run


def score(
    docs: DataFrame, settings: Settings = Settings(), modulus: int = 7, rest: int = 2,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Unigram and model scores of every row; ids with the remainder `rest` aren't learned from."""
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("h"), held_out(modulus, rest).alias("held_out"), "text"
    )
    train = rows.filter(~F.col("held_out"))
    counts = materialize(word_counts(train), "word-counts")
    v = vocabulary(counts, settings, frequent)
    shared = spark.sparkContext.broadcast(v)
    model = trained(train, shared, settings)
    model = Mixture(model.models, [], model.weights)
    log_z = [m.log_normalisers() for m in model.models]
    learned = spark.sparkContext.broadcast((model, log_z))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = rows.mapInArrow(
        _scorer(shared, learned),
        f"doc_id {id_type}, h long, held_out boolean, n_tokens long, n_known long, "
        "base double, score double, rare array<string>",
    )
    # A row for the text itself and one for each rare word. The text's row has a key of its own
    # that no word is equal to, so it finds no count and is no hot key.
    itself = F.concat(F.lit("\n"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("h").cast("string"))
    sums = ["n_tokens", "n_known", "base", "score"]
    parts = own.select(
        "doc_id", "h", "held_out", *sums,
        F.posexplode(F.concat(F.array(itself), F.col("rare"))).alias("at", "word"),
    )
    parts = parts.select(
        "doc_id", "h", "held_out", "word",
        *[F.when(F.col("at") == 0, F.col(c)).alias(c) for c in sums],
    )
    joined = parts.join(counts, "word", "left")
    rare = ~F.startswith("word", F.lit("\n"))
    c = F.coalesce(F.col("c"), F.lit(0)) + 1.0
    texts = F.count("n_tokens")  # rows that repeat an id and text
    out = joined.groupBy("doc_id", "h", "held_out").agg(
        texts.alias("times"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(rare & (F.col("c") > 0), 1).otherwise(0)) / texts)
        .cast("bigint").alias("n_known"),
        (F.max("base") + F.sum(F.when(rare, F.log10(c / v.unseen_base)).otherwise(0.0)) / texts)
        .alias("base_score"),
        (F.max("score") + F.sum(F.when(rare, F.log10(c / v.others_base)).otherwise(0.0)) / texts)
        .alias("score"),
    )
    return out.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
