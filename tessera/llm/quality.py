"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer numpy network.

1. *Word vectors.* Every word and every word shape (case, digits, marks, and
   whether it repeats the word before) is hashed into a fixed number of rows. A row's vector
   is the sum of the sparse ternary index vectors of its neighbours within two words,
   over the whole corpus. Each task adds up its own matrix and sends its rows once;
   the sums are integers, so their order does not matter. The result has WORDS + SHAPES rows.
2. *Pooling.* A document is the mean of its words' vectors, weighted by a / (a + p)
   with p the row's share of all words, beside the plain mean of its shapes' vectors.
3. *Network.* Inputs are standardised, one hidden layer, fitted by Adam on at most
   SAMPLE labelled rows (those of least hash); a tenth of them set the temperature
   that divides the logit.

Edge cases: null and empty texts have zero vectors and a score like any other;
without labelled rows of both classes the score is the share of label 1 (0.5 without
any label); repeated rows each get a score; labels without a document and null labels
are ignored, a label given twice counts once, and an id labelled both 0 and 1 is not learnt
from; an empty table gives no rows; other columns, also of the labels, are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import claim, named, table

WORDS, SHAPES, DIM, NONZERO, WINDOW = 32_768, 4_096, 32, 2, 2
ROWS = WORDS + SHAPES
SAMPLE, HIDDEN, THRESHOLD = 20_000, 32, 0.3
SLICE, CHUNK, CACHE = 1_500_000, 100_000, 200_000
_rows: dict[str, tuple[int, int]] = {}
_RUN = re.compile(r"(.)\1+")
_CLASS = {c: "A" if chr(c).isupper() else "a" if chr(c).isalpha() else "0" for c in range(0x250) if chr(c).isalnum()}


def _row(word: str) -> tuple[int, int]:
    shape = _RUN.sub(r"\1\1", word.translate(_CLASS))
    return zlib.crc32(word.lower().encode()) % WORDS, WORDS + 1 + zlib.crc32(shape.encode()) % (SHAPES - 1)


def index_vectors(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the NONZERO entries of each row's index vector."""
    random = np.random.default_rng(seed)
    return random.integers(0, DIM, (ROWS, NONZERO)), random.choice([-1.0, 1.0], (ROWS, NONZERO))


def _slices(batch, column: str):
    """(first row, words' rows, shapes' rows, document starts) of parts of a batch; one array entry a word."""
    import pyarrow.compute as pc

    claim("quality", _rows)
    texts = pc.fill_null(batch.column(column), "")
    ends = pc.cumulative_sum(pc.binary_length(texts).cast("int64")).to_numpy(zero_copy_only=False) if len(texts) else []
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        pieces = pc.ascii_split_whitespace(texts.slice(at, upto - at))
        bounds = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        flat = pieces.flatten()
        filled = pc.not_equal(flat, "")  # leading and trailing white space leave empty pieces
        keep = filled.to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(keep)])[bounds]
        coded = flat.filter(filled).dictionary_encode()
        pairs = []
        for word in coded.dictionary.to_pylist():
            pair = _rows.get(word)
            if pair is None:
                pair = _row(word)
                if len(_rows) < CACHE:
                    _rows[word] = pair
            pairs.append(pair)
        codes = coded.indices.to_numpy()
        both = np.array(pairs, np.int64).reshape(-1, 2)[codes]
        shapes = both[:, 1].copy()
        again = np.flatnonzero(codes[1:] == codes[:-1]) + 1
        shapes[again] = WORDS
        yield at, both[:, 0], shapes, starts
        at = upto


def vector_sums(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """(ROWS, DIM + 1): sums of neighbours' index vectors, and how often each row occurs."""
    names = ["h", "n", *[f"c{k}" for k in range(DIM)]]

    def run(stream):
        import pyarrow as pa

        place, sign = index_vectors()
        sums, seen = np.zeros((ROWS, DIM)), np.zeros(ROWS)
        for batch in stream:
            for _, words, shapes, starts in _slices(batch, "text"):
                doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                for rows, first, size in ((words, 0, WORDS), (shapes, WORDS, SHAPES)):
                    seen[first : first + size] += np.bincount(rows - first, minlength=size)
                    ends = []
                    for step in range(1, WINDOW + 1):
                        same = doc[step:] == doc[:-step]
                        left, right = rows[:-step][same], rows[step:][same]
                        ends += [(left, right), (right, left)]
                    one, other = (np.concatenate(x) for x in zip(*ends))
                    one = (one - first) * DIM
                    for k in range(NONZERO):
                        sums[first : first + size] += np.bincount(one + place[other, k], sign[other, k], size * DIM).reshape(size, DIM)
        used = np.flatnonzero(seen)
        table_ = sums[used].astype(np.int64)
        columns = [pa.array(used.astype(np.int32)), pa.array(seen[used].astype(np.int64)), *[pa.array(table_[:, k]) for k in range(DIM)]]
        if len(used):
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "h int, n bigint, " + ", ".join(f"c{k} bigint" for k in range(DIM))
    parts = named(docs, text=text_column).mapInArrow(run, schema)
    out = np.zeros((ROWS, DIM + 1))
    for r in parts.groupBy("h").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow().to_batches():
        values = [r.column(i).to_numpy() for i in range(DIM + 2)]
        out[values[0], :DIM] = np.stack(values[2:], axis=1)
        out[values[0], DIM] = values[1]
    return out


@dataclass
class Model:
    """All that scoring needs; its size does not depend on the corpus."""

    vectors: np.ndarray
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple
    temperature: float
    prior: float

    def pooled(self, count: int, words: np.ndarray, shapes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(count, 2 DIM + 1) document vectors."""
        doc = np.repeat(np.arange(count), np.diff(starts))
        out, total = np.zeros((count, 2 * DIM + 1), np.float64), np.zeros((count, 2))
        for at in range(0, len(words), CHUNK):
            part = slice(at, at + CHUNK)
            own = doc[part]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            who = own[first]
            w = self.weights[words[part]]
            out[who, :DIM] += np.add.reduceat(self.vectors[words[part]] * w[:, None], first, axis=0)
            out[who, DIM : 2 * DIM] += np.add.reduceat(self.vectors[shapes[part]], first, axis=0)
            total[who, 0] += np.add.reduceat(w, first)
            total[who, 1] += np.add.reduceat(np.ones(len(own)), first)
        out[:, :DIM] /= np.maximum(total[:, :1], 1e-9)
        out[:, DIM : 2 * DIM] /= np.maximum(total[:, 1:], 1)
        out[:, -1] = np.log1p(total[:, 1])
        return out

    def score(self, pooled: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(pooled), self.prior)
        return _sigmoid(_forward((pooled - self.mean) / self.scale, self.layers)[1] / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = layers
    hidden = np.tanh(x @ a + b)
    return hidden, hidden @ c + d


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 3) -> tuple:
    """Adam on the log loss with a small weight decay."""
    random = np.random.default_rng(seed)
    layers = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    first, second, t = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for epoch in range(epochs):
        order, rate = random.permutation(len(x)), 0.01 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(x), 128):
            own = order[at : at + 128]
            hidden, logit = _forward(x[own], tuple(layers))
            off = (_sigmoid(logit) - y[own]) / len(own)
            back = np.outer(off, layers[2]) * (1 - hidden**2)
            slopes = [x[own].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ off + 1e-4 * layers[2], off.sum()]
            t += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(layers)


def calibrated(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on a fixed grid."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 8, 61)
    loss = [-np.mean(np.where(y == 1, np.log(_sigmoid(logit / t)), np.log(_sigmoid(-logit / t)))) for t in grid]
    return float(grid[int(np.argmin(loss))])


def held_out(column: str) -> Column:
    """Whether crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", sample: int = SAMPLE) -> Model:
    """Vectors from all of ``docs``; the network from at most ``sample`` labelled rows that are not held out."""
    sums = vector_sums(docs, text_column)
    seen, vectors = sums[:, DIM], sums[:, :DIM]
    vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    weights = 1e-3 / (1e-3 + seen / max(1.0, seen[:WORDS].sum()))
    model = Model(vectors, weights, np.zeros(1), np.ones(1), (), 1.0, 0.5)
    known = named(labels, label_id="doc_id", label=label_column).filter("label in (0, 1)").filter(~held_out("label_id"))
    known = known.groupBy("label_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most")
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = named(docs, doc_id=id_column, text=text_column).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one row a label, however often an id is repeated
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream):
        import pyarrow as pa

        for batch in stream:
            for at, words, shapes, starts in _slices(batch, "text"):
                count = len(starts) - 1
                x = shared.value.pooled(count, words, shapes, starts).astype("<f8")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, count), batch.column("label").slice(at, count).cast(pa.int32()), pa.array([v.tobytes() for v in x], pa.binary())], names=["doc_id", "label", "x"])

    found = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, x binary").toArrow().to_pydict()
    shared.destroy()
    order = sorted(range(len(found["doc_id"])), key=lambda i: (zlib.crc32(str(found["doc_id"][i]).encode()), found["doc_id"][i], found["x"][i]))
    y = np.array([found["label"][i] for i in order], np.float64)
    if len(y):
        model.prior = float(y.mean())
    if 0 < y.sum() < len(y):
        x = np.stack([np.frombuffer(found["x"][i], "<f8") for i in order])
        model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - model.mean) / model.scale
        rest = np.arange(len(y)) % 10 == 9
        if not 0 < y[~rest].sum() < (~rest).sum():
            rest[:] = False
        model.layers = fit_network(x[~rest], y[~rest])
        model.temperature = calibrated(_forward(x[rest], model.layers)[1], y[rest])
    return model


def _scored(shared, text_name: str):
    def run(batch):
        parts = [shared.value.score(shared.value.pooled(len(s) - 1, w, h, s)) for _, w, h, s in _slices(batch, text_name)]
        return np.concatenate(parts) if parts else np.zeros(0)

    return run


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    work = _scored(docs.sparkSession.sparkContext.broadcast(model), "text")

    def run(stream):
        import pyarrow as pa

        for batch in stream:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(work(batch))], names=["doc_id", "score"])

    return named(docs, doc_id=id_column, text=text_column).mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    work = _scored(shared, text_column)

    def run(stream):
        import pyarrow as pa

        for batch in stream:
            yield batch.filter(pa.array(work(batch) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Score all of ``documents`` with a model fitted on ``documents`` and ``labels``."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op6_quality": op6_quality}
ORACLE: dict[str, str] = {}
