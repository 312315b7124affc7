"""Language identification by a byte convolutional network.

Bytes are folded to 64 symbols. Filters of several widths slide over their vectors, the
largest response of each filter in a window of fixed length is kept, and a softmax layer
turns these into log-probabilities. A text's languages are the mean over all its windows,
weighted by their letters. The network is trained in numpy; for scoring, a filter's products
are tabulated for all pairs of symbols, so a response is a sum of table entries.

Learned from at most SAMPLE labelled texts, those whose ids have the smallest hashes, one text
of each id, never from held-out ids; PER_TEXT windows each reach the driver. A missing text, one without a
letter, and every text if there is nothing to learn from, is `und` with score 0. Texts of any
length are read whole. Each row is judged by itself. Only doc_id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.llm.frames import held_out, releasing, slices

#: Texts that are learned from, and windows of each.
SAMPLE, PER_TEXT = 3000, 4
#: Bytes of a window.
WINDOW = 256
SYMBOLS, SIZE = 64, 8
WIDTHS, FILTERS = (2, 3, 4), 16
PASSES, BATCH, RATE = 6, 64, 0.01
#: Windows whose responses are held at a time.
AT_ONCE = 256
UNKNOWN = "und"


def _fold() -> np.ndarray:
    """Symbols of bytes: 0 for what is no letter, then a-z without case, then the upper half."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[[0x41 + i, 0x61 + i]] = 1 + i
    table[0x80:] = 27 + np.arange(128) % (SYMBOLS - 27)
    return table


FOLD = _fold()


def windows(text: bytes) -> np.ndarray:
    """All windows of a text as rows of symbols; the last one is filled up with 0."""
    symbols = FOLD[np.frombuffer(text, np.uint8)]
    out = np.zeros((-(-len(symbols) // WINDOW), WINDOW), np.uint8)
    out.ravel()[: len(symbols)] = symbols
    return out


@dataclass
class Network:
    """Symbol vectors, filters by width, and the softmax layer."""

    languages: list[str]
    vectors: np.ndarray
    filters: list[np.ndarray]  # width x SIZE x FILTERS
    shifts: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width the responses to pairs of symbols, and to a single last one."""
        out = []
        for f, shift in zip(self.filters, self.shifts):
            single = [(self.vectors @ own).astype(np.float32) for own in f]
            parts = [
                (a[:, None] + b[None]).reshape(-1, FILTERS)
                for a, b in zip(single[::2], single[1::2])
            ]
            parts += single[len(parts) * 2 :]
            parts[0] = parts[0] + shift.astype(np.float32)
            out.append(parts)
        return out

    def log_probabilities(self, rows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Of every language for each window."""
        out = []
        for a in range(0, len(rows), AT_ONCE):
            part = rows[a : a + AT_ONCE].astype(np.int64)
            pairs = part[:, :-1] * SYMBOLS + part[:, 1:]
            pooled = []
            for width, entries in zip(WIDTHS, tables):
                n = WINDOW - width + 1
                total = entries[0][pairs[:, :n]]
                for j, entry in enumerate(entries[1:], 1):
                    at = 2 * j
                    index = pairs if len(entry) > SYMBOLS else part
                    total += entry[index[:, at : at + n]]
                pooled.append(np.maximum(total.max(axis=1), 0))
            out.append(_log_softmax(np.concatenate(pooled, axis=1) @ self.weights + self.offset))
        return np.concatenate(out)


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train(rows: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 11) -> Network:
    """Learns from windows of symbols and the index of each one's language."""
    rng = np.random.default_rng(seed)
    width_total = FILTERS * len(WIDTHS)
    p = [rng.normal(0, 0.5, (SYMBOLS, SIZE)), rng.normal(0, 0.1, (width_total, len(languages))),
         np.zeros(len(languages))]
    p += [rng.normal(0, 0.3, (w * SIZE, FILTERS)) for w in WIDTHS]
    p += [np.zeros(FILTERS) for _ in WIDTHS]
    p = [x.astype(np.float32) for x in p]
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    steps, k = 0, len(WIDTHS)
    for _ in range(PASSES):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), BATCH):
            part = order[a : a + BATCH]
            steps += 1
            for i, g in enumerate(_gradients(p, rows[part].astype(np.int64), target[part])):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.01 * (g * g - second[i])
                mean = first[i] / (1 - 0.9**steps)
                p[i] -= RATE * mean / (np.sqrt(second[i] / (1 - 0.99**steps)) + 1e-6)
    filters = [f.reshape(w, SIZE, FILTERS) for w, f in zip(WIDTHS, p[3 : 3 + k])]
    return Network(languages, p[0], filters, p[3 + k :], p[1], p[2])


def _gradients(p: list[np.ndarray], rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    vectors, weights, offset = p[:3]
    k, n = len(WIDTHS), len(rows)
    x = vectors[rows]
    flat = x.reshape(n, -1)
    pooled, places = [], []
    for w, f, shift in zip(WIDTHS, p[3 : 3 + k], p[3 + k :]):
        # Overlapping stretches of w vectors, without copying them.
        view = np.lib.stride_tricks.sliding_window_view(flat, w * SIZE, axis=1)[:, ::SIZE]
        response = view @ f + shift
        at = response.argmax(axis=1)
        pooled.append(np.take_along_axis(response, at[:, None], axis=1)[:, 0])
        places.append(at)
    features = np.maximum(np.concatenate(pooled, axis=1), 0)
    error = np.exp(_log_softmax(features @ weights + offset))
    error[np.arange(n), target] -= 1
    error /= n
    back = (error @ weights.T) * (features > 0)
    d_vectors = np.zeros_like(vectors)
    d_filters, d_shifts = [], []
    for i, (w, f) in enumerate(zip(WIDTHS, p[3 : 3 + k])):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        at = places[i][:, :, None] + np.arange(w)
        symbols = np.take_along_axis(rows[:, None, :], at, axis=2)
        seen = vectors[symbols].reshape(n, FILTERS, w * SIZE)
        d_filters.append(np.einsum("nf,nfd->df", g, seen))
        d_shifts.append(g.sum(axis=0))
        spread = (g[:, :, None] * f.T[None]).reshape(-1, SIZE)
        np.add.at(d_vectors, symbols.reshape(-1), spread)
    return [d_vectors, features.T @ error, error.sum(axis=0), *d_filters, *d_shifts]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows spread over each text."""
    for batch in batches:
        for part, texts in slices(batch, "text"):
            own, which = [], []
            for i, text in enumerate(texts):
                rows = windows(text)
                chosen = np.unique(np.linspace(0, len(rows) - 1, PER_TEXT).astype(int))
                own += [rows[j].tobytes() for j in (chosen if len(rows) else [])]
                which += [i] * (len(chosen) if len(rows) else 0)
            index = pa.array(which, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(index), part.column(1).take(index), pa.array(own, pa.binary())],
                ["doc_id", "lang", "window"],
            )


def learned(docs: DataFrame, train_rows=None) -> Network | None:
    """A network from labelled texts; `train_rows` is the condition on their ids."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(train_rows) if train_rows is not None else known
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    chosen = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    chosen = chosen.filter(F.rlike("text", F.lit(r"\p{L}")))
    # Of rows that repeat an id, the one whose text has the smallest hash.
    row = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("row")
    chosen = chosen.groupBy("doc_id").agg(row).select("doc_id", "row.lang", "row.text")
    found = chosen.mapInArrow(_sampled, f"doc_id {id_type}, lang string, window binary")
    rows = sorted(tuple(r) for r in found.collect())
    languages = sorted({r[1] for r in rows})
    if not languages:
        return None
    symbols = np.stack([np.frombuffer(r[2], np.uint8) for r in rows])
    return train(symbols, np.array([languages.index(r[1]) for r in rows]), languages)


def _judge(network: Network, tables: list, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and probability of texts that aren't empty."""
    rows = [windows(t) for t in texts]
    stacked = np.concatenate(rows)
    weight = (stacked > 0).sum(axis=1) + 1e-9
    cuts = np.cumsum([len(r) for r in rows]) - [len(r) for r in rows]
    logs = network.log_probabilities(stacked, tables)
    sums = np.add.reduceat(logs * weight[:, None], cuts)
    mean = _log_softmax(sums / np.add.reduceat(weight, cuts)[:, None])
    best = mean.argmax(axis=1)
    return [network.languages[b] for b in best], np.exp(mean.max(axis=1)).tolist()


def prediction(docs: DataFrame, network: Network | None, text: str = "text") -> Column:
    """A struct of `lang_pred` and `score`; only texts with a letter are sent to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    @releasing
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net: Network | None = shared.value
        tables = net.tables() if net else []
        for column in batches:
            languages = np.full(len(column), UNKNOWN, object)
            scores = np.zeros(len(column))
            if net:
                batch = pa.RecordBatch.from_arrays([column, pa.array(range(len(column)))], ["t", "i"])
                for part, texts in slices(batch, "t"):
                    some = [i for i, t in enumerate(texts) if t]
                    if some:
                        at = part.column(1).to_numpy()[some]
                        found = _judge(net, tables, [texts[i] for i in some])
                        languages[at], scores[at] = found
            yield pa.StructArray.from_arrays(
                [pa.array(languages, pa.string()), pa.array(scores)], ["lang_pred", "score"]
            )

    lettered = F.when(F.rlike(text, F.lit(r"\p{L}")), F.col(text)).otherwise("")
    return predict(lettered)


def identified(docs: DataFrame, modulus: int = 4, rest: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; held-out rows aren't learned from."""
    network = learned(docs, ~held_out(modulus, rest))
    out = docs.select("doc_id", prediction(docs, network).alias("p"))
    return out.select(
        "doc_id", held_out(modulus, rest).alias("held_out"), "p.lang_pred", "p.score"
    )


#: A text whose best language is less likely than this is rejected by `filtered`.
LEAST_SCORE = 0.4


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of `docs` in a language that the network knows, with their own columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    found = prediction(plain, learned(docs), names[docs.columns.index("text")])
    kept = (F.col("_p.lang_pred") != UNKNOWN) & (F.col("_p.score") >= LEAST_SCORE)
    return plain.withColumn("_p", found).filter(kept).select(*names).toDF(*docs.columns)
