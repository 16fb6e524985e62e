"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

1. Words.  A token is a run free of ASCII white space, cut into letters, digits
   and punctuation; letters are folded with a mark for their case, digits are
   counted, and a token that repeats its predecessor becomes a repeat mark.
   Words are hashed to ``buckets`` rows, so the table of word vectors has a
   fixed size whatever the corpus (``buckets`` x ``dims`` numbers).
2. Random indexing over all documents: each bucket has a sparse ternary index
   vector made from the seed; a bucket's word vector is the normalised sum of
   the index vectors of its neighbours within ``window`` parts.  Tasks sum
   locally and Spark adds up at most ``buckets`` rows a task.
3. A document is the mean of its words' vectors.
4. A network with one hidden layer learns ``quality`` from at most ``fit_rows``
   labelled rows (the documented bound; chosen by a hash of doc_id); a fifth of
   them is set aside to fit the temperature that calibrates its probabilities.

Labels are only learned from rows whose crc32(doc_id) mod 5 is not 0.  A score
depends on the text alone.

Defined results: null text counts as empty; an empty text has the zero vector
and gets that vector's score; labels other than 0 and 1 are ignored, and so is a
doc_id with as many labels 0 as 1; without labels of both classes every row
gets the smoothed share of label 1; repeated rows each get a result; an empty
table gives an empty result; other columns pass through or are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import crc_mod, like, text_rows

PART = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SCORE = "__quality_score"


@dataclass(frozen=True)
class QualitySpec:
    buckets: int = 4096
    dims: int = 64
    nonzero: int = 2
    window: int = 2
    fit_rows: int = 40_000
    hidden: int = 32
    epochs: int = 30
    learning_rate: float = 3e-3
    threshold: float = 0.3
    seed: int = 17


@dataclass
class Network:
    words: np.ndarray  # buckets x dims, float32
    prior: float
    temperature: float = 1.0
    layers: list = field(default_factory=list)  # mean, scale, w1, b1, w2, b2


def index_vectors(spec: QualitySpec) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(spec.seed)
    return (np.ascontiguousarray(rng.integers(0, spec.dims, (spec.nonzero, spec.buckets))),
            np.ascontiguousarray(rng.choice([-1.0, 1.0], (spec.nonzero, spec.buckets))))


def word_codes(token: str, buckets: int) -> list[int]:
    """The buckets of a token's parts; bucket 0 is the repeat mark's alone."""
    found = []
    for part in PART.findall(token):
        if part[0].isalpha():
            case = "U" if len(part) > 1 and part.isupper() else "C" if part[0].isupper() else "l"
            key = case + part.lower()
        elif part[0].isdigit():
            key = f"#{min(len(part), 20)}"
        else:
            key = part[:4]
        found.append(1 + zlib.crc32(key.encode("utf-8", "surrogatepass")) % (buckets - 1))
    return found


def coded(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' codes one after another, and each text's number of codes."""
    lists = pc.ascii_split_whitespace(texts)
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    token = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(token):
        return np.empty(0, np.int64), np.zeros(len(per_text), np.int64)
    parts = [word_codes(t, buckets) for t in flat.dictionary.to_pylist()] + [[0]]
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    values = np.array([c for p in parts for c in p], np.int64)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (owner[1:] == owner[:-1]) & (sizes[token[1:]] > 0)
    token = np.where(again, len(parts) - 1, token)
    n = sizes[token]
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    codes = values[np.repeat(starts[token], n) + offset]
    return codes, np.bincount(owner, weights=n, minlength=len(per_text)).astype(np.int64)


def slices(batches, rows: int = 512):
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def word_vectors(docs: DataFrame, spec: QualitySpec) -> np.ndarray:
    """Context vectors of all buckets, from all documents (buckets x dims)."""
    place, sign = index_vectors(spec)
    names = [f"d{i}" for i in range(spec.dims)]

    def count(batches):
        table = np.zeros(spec.buckets * spec.dims)
        for part in slices(batches):
            codes, sizes = coded(part.column(0), spec.buckets)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            for gap in range(1, spec.window + 1):
                inside = owner[:-gap] == owner[gap:]
                left, right = codes[:-gap][inside], codes[gap:][inside]
                for j in range(spec.nonzero):
                    table += np.bincount(left * spec.dims + place[j][right], sign[j][right], table.size)
                    table += np.bincount(right * spec.dims + place[j][left], sign[j][left], table.size)
        table = table.reshape(spec.buckets, spec.dims)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(table[used, i]) for i in range(spec.dims))],
            names=["bucket", *names])

    sums = (text_rows(docs).select("text")
            .mapInArrow(count, "bucket int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]))
    found = sums.toPandas()  # at most ``buckets`` rows
    table = np.zeros((spec.buckets, spec.dims))
    if len(found):
        table[found["bucket"].to_numpy()] = found[names].to_numpy()
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(texts: pa.Array, words: np.ndarray) -> np.ndarray:
    codes, sizes = coded(texts, len(words))
    out = np.zeros((len(sizes), words.shape[1]), np.float32)
    stop = np.cumsum(sizes)
    for i in np.flatnonzero(sizes):
        out[i] = words[codes[stop[i] - sizes[i]:stop[i]]].mean(axis=0)
    return out


def label_table(labels: DataFrame) -> DataFrame:
    """doc_id, quality: the majority label of each doc_id that may be learned from."""
    vote = F.avg(F.col("quality").cast("double"))
    return (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod() != 0))
            .groupBy("doc_id").agg(vote.alias("vote")).filter("vote <> 0.5")
            .select("doc_id", (F.col("vote") > 0.5).cast("int").alias("quality")))


def fit_sample(docs: DataFrame, labels: DataFrame, words: np.ndarray, spec: QualitySpec):
    """At most ``fit_rows`` labelled rows with their pooled vectors, on the driver."""
    rows = text_rows(docs)
    known = label_table(labels).join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary"))).limit(spec.fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def pool(batches):
        for part in slices(batches):
            vectors = pooled(part.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(list(vectors), pa.list_(pa.float32()))],
                names=["doc_id", "quality", "vector"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = (rows.join(F.broadcast(chosen), "doc_id")  # at most fit_rows ids
             .mapInArrow(pool, f"doc_id {id_type}, quality int, vector array<float>")
             .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "vector")
             .limit(spec.fit_rows).toPandas())
    return found


def train(sample, words: np.ndarray, spec: QualitySpec) -> Network:
    y = sample["quality"].to_numpy(dtype=float) if len(sample) else np.empty(0)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y.tolist())) < 2:
        return Network(words, prior)
    x = np.stack(sample["vector"].to_numpy()).astype(float)
    aside = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in sample["doc_id"]])
    if not (0 < y[aside].sum() < aside.sum() and 0 < y[~aside].sum() < (~aside).sum()):
        aside = np.zeros(len(y), bool)
    mean, scale = x[~aside].mean(axis=0), x[~aside].std(axis=0) + 1e-6
    z = (x - mean) / scale
    rng = np.random.default_rng(spec.seed)
    params = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], spec.hidden)), np.zeros(spec.hidden),
              rng.normal(0, (1 / spec.hidden) ** 0.5, spec.hidden), np.zeros(())]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    rows, step = np.flatnonzero(~aside), 0
    for _ in range(spec.epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            step += 1
            for i, g in enumerate(_gradients(params, z[part], y[part])):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g ** 2
                params[i] = params[i] - spec.learning_rate * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(words, prior, 1.0, [mean, scale, *params])
    if aside.any():
        net.temperature = _temperature(logits(net, x[aside]), y[aside])
    return net


def _gradients(params, x, y):
    w1, b1, w2, b2 = params
    h = np.maximum(x @ w1 + b1, 0)
    g = (_sigmoid(h @ w2 + b2) - y) / len(x)
    gh = np.outer(g, w2) * (h > 0)
    return x.T @ gh + 1e-4 * w1, gh.sum(axis=0), h.T @ g + 1e-4 * w2, g.sum()


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by a search over 1/4 to 16."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(16), 241))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def logits(net: Network, x: np.ndarray) -> np.ndarray:
    mean, scale, w1, b1, w2, b2 = net.layers
    return np.maximum(((x - mean) / scale) @ w1 + b1, 0) @ w2 + b2


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    if not net.layers:
        return np.full(len(x), net.prior)
    return np.clip(_sigmoid(logits(net, x.astype(float)) / net.temperature), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, spec: QualitySpec = QualitySpec()) -> Network:
    words = word_vectors(docs, spec)
    return train(fit_sample(docs, labels, words, spec), words, spec)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """All columns of ``docs`` and ``__quality_score``; needs a column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    frame = docs.drop(SCORE)
    names = frame.columns
    at = names.index("text")

    def run(batches):
        for part in slices(batches):
            texts = pc.fill_null(part.column(at), "")
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(probabilities(shared.value, pooled(texts, shared.value.words)))],
                names=[*names, SCORE])

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields])
    return frame.mapInArrow(run, schema.add(SCORE, "double"))


def accepted(docs: DataFrame, labels: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """The documents that the classifier accepts, unchanged."""
    scored = score(docs, fit(docs, labels, spec))
    return like(scored.filter(F.col(SCORE) >= spec.threshold), docs)
