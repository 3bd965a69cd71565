"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words (white-space separated); the bag has a label, the passages have none. A
passage is encoded as h = tanh(E x) from the square roots of its shares of bytes, of hashed byte pairs and of words that
repeat the word before, and from its number of words; gated attention
weighs the passages, a_k proportional to exp(w (tanh(V h_k) * sigmoid(U h_k))); the score is sigmoid(c z + b) of the
weighted passage representation z = sum a_k h_k. All of E, V, U, w, c and b are learned together from document labels
alone, by Adam, on a bounded sample of labelled documents.

Bounds of the fit, parameters: at most `per_class` documents of each label (those of the smallest hash of the id), and of
them as many as begin within the first `per_class_bytes` of their texts. Fitting and scoring cover every passage of every
whole text; a long one is scored in slabs of SLAB passages, over which the softmax of the attention runs on.

Defined cases: a null or empty text is one empty passage and has a score like any other; equal texts have equal scores;
labels that are null, neither 0 nor 1, or contradict each other for one document are left out; with labels of one kind
or none, the score is the smoothed share of label 1; an empty table gives an empty table; output columns replace input
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, give_back, lean, text_runs

PASSAGE_WORDS = 64
PAIRS = 512
#: Bytes, hashed byte pairs, words equal to the word before, words.
INPUTS = 256 + PAIRS + 2
HIDDEN, GATE = 32, 16
PER_CLASS = 1_500
PER_CLASS_BYTES = 24_000_000
EPOCHS = 40
#: Texts of more bytes are scored in slabs of so many passages.
LONG_BYTES, SLAB = 400_000, 1_000
CHUNK_BYTES = 250_000
#: A document is predicted good from this score on.
THRESHOLD = 0.3

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.random.default_rng(3).integers(1, 2**40, 256)
_LETTER[_SPACE] = 0
_PAIR = ((np.arange(65536, dtype=np.uint32) * np.uint32(2654435761)) >> np.uint32(23)).astype(np.int64)


def passages(texts: list[bytes], words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(counts per passage, passages per text); the columns are those of INPUTS."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    space = _SPACE[data]
    starts = ~space
    starts[1:] &= space[:-1]
    word = np.cumsum(starts)
    before = word[ends - sizes] - starts[ends - sizes]
    n_words = word[ends - 1] - before
    per_text = np.maximum(1, -(-n_words // words))
    base = np.cumsum(per_text) - per_text
    # the passage of every byte: that of its word, or of the word before
    passage = np.repeat(base, sizes) + np.maximum(word - np.repeat(before, sizes) - 1, 0) // words
    pair = _PAIR[(data[:-1].astype(np.int64) << 8) | data[1:]]
    within = np.ones(len(data), bool)
    within[ends - 1] = False
    total = int(per_text.sum())
    counts = np.empty((total, INPUTS), np.float32)
    counts[:, :256] = np.bincount(passage * 256 + data, minlength=total * 256).reshape(total, 256)
    at = np.flatnonzero(within[:-1])
    counts[:, 256 : 256 + PAIRS] = np.bincount(passage[at] * PAIRS + pair[at], minlength=total * PAIRS).reshape(total, PAIRS)
    at = np.flatnonzero(starts)
    spelt = np.add.reduceat(_LETTER[data], at) if len(at) else np.zeros(0, np.int64)
    text = np.searchsorted(ends, at, side="right")
    again = np.flatnonzero((spelt[1:] == spelt[:-1]) & (text[1:] == text[:-1])) + 1
    counts[:, -2] = np.bincount(passage[at[again]], minlength=total)
    counts[:, -1] = np.bincount(passage[at], minlength=total)
    return counts, per_text


def _opening_words(data: np.ndarray, step: int) -> list[int]:
    """Where the words of the numbers step, 2 step, ... begin (from 0), found block by block."""
    found, seen = [], 0
    for at in range(0, len(data), LONG_BYTES):
        word = ~_SPACE[data[max(at - 1, 0) : at + LONG_BYTES]]
        start = word.copy()
        start[1:] &= ~word[:-1]
        own = np.flatnonzero(start[1:] if at else start) + at
        number = np.arange(seen, seen + len(own))
        found += own[(number % step == 0) & (number > 0)].tolist()
        seen += len(own)
    return found


def slabs(text: bytes, words: int = PASSAGE_WORDS, size: int = SLAB) -> Iterator[np.ndarray]:
    """The counts that passages() has of a text, `size` passages at a time; what crosses a bound counts, too."""
    data = np.frombuffer(text, np.uint8)
    spelt = lambda word: int(_LETTER[np.frombuffer(word, np.uint8)].sum())
    cuts = [0, *_opening_words(data, words * size), len(text)]
    before = None
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        counts, _ = passages([text[a:b]], words)
        own = text[a:b].split(None, 1)
        if before is not None:
            counts[0, -2] += spelt(own[0]) == before
        if b < len(text):
            # passages() ends what it is given with a line end; here the text goes on
            end = int(data[b - 1]) << 8
            counts[-1, ord("\n")] -= 1
            counts[-1, 256 + _PAIR[end | ord("\n")]] -= 1
            counts[-1, 256 + _PAIR[end | int(data[b])]] += 1
            before = spelt(text[a:b].rsplit(None, 1)[-1])
        yield counts


def inputs(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares, scaled, and the logarithm of the number of words."""
    x = counts.copy()
    for part in (x[:, :256], x[:, 256 : 256 + PAIRS]):
        part /= np.maximum(part.sum(1, keepdims=True), 1)
    x[:, -2] /= np.maximum(x[:, -1], 1)
    x[:, :-1] = np.sqrt(x[:, :-1]) * 4
    x[:, -1] = np.log1p(x[:, -1]) / 2
    return x


@dataclass
class Model:
    """The learned weights and the shift of the logit to the labels' own shares."""

    weights: dict[str, np.ndarray]
    shift: float

    def forward(self, x: np.ndarray, per_bag: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        at = np.cumsum(per_bag) - per_bag
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        raw = (t * s) @ p["w"]
        a = np.exp(raw - np.repeat(np.maximum.reduceat(raw, at), per_bag))
        a /= np.repeat(np.add.reduceat(a, at), per_bag)
        z = np.add.reduceat(h * a[:, None], at, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ p["c"] + p["b"]}

    def gradients(self, x: np.ndarray, per_bag: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Derivatives of the weighted logistic loss of the bags."""
        p, f = self.weights, self.forward(x, per_bag)
        g = ((1 / (1 + np.exp(-f["logit"])) - y) * weight).astype(x.dtype)
        d_z = np.repeat(g[:, None] * p["c"], per_bag, axis=0)
        h, t, s, a = f["h"], f["t"], f["s"], f["a"]
        own = (d_z * h).sum(1)
        d_raw = a * (own - np.repeat(np.add.reduceat(own * a, np.cumsum(per_bag) - per_bag), per_bag))
        d_ts = d_raw[:, None] * p["w"]
        d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
        d_h = d_z * a[:, None] + d_t @ p["V"].T + d_s @ p["U"].T
        d_pre = d_h * (1 - h * h)
        return {"E": x.T @ d_pre, "e": d_pre.sum(0), "V": h.T @ d_t, "U": h.T @ d_s, "w": (t * s).T @ d_raw, "c": f["z"].T @ g, "b": g.sum()}

    def pooled(self, text: bytes) -> tuple[float, np.ndarray]:
        """(logit, attention weights) of one long text, slab by slab: sums are rescaled when a larger weight comes."""
        p, most, total, z, raws = self.weights, -np.inf, 0.0, 0.0, []
        for counts in slabs(text):
            h = np.tanh(inputs(counts) @ p["E"] + p["e"])
            raw = ((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]).astype(np.float64)
            top = max(most, float(raw.max()))
            e, keep = np.exp(raw - top), np.exp(most - top)
            most, total, z = top, total * keep + e.sum(), z * keep + e @ h
            raws.append(raw)
        return float(z / total @ p["c"] + p["b"]), np.exp(np.concatenate(raws) - most) / total

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores in 0..1 and each text's attention weights."""
        if not self.weights:
            flat = 1 / (1 + np.exp(-self.shift))
            per_text = [sum(len(c) for c in slabs(t)) if len(t) > LONG_BYTES else len(passages([t])[0]) for t in texts]
            return np.full(len(texts), flat), [np.full(n, 1 / n) for n in per_text]
        logits, weights = np.empty(len(texts)), [np.zeros(0)] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= LONG_BYTES]
        if short:
            counts, per_text = passages([texts[i] for i in short])
            f = self.forward(inputs(counts), per_text)
            logits[short] = f["logit"]
            for i, a in zip(short, np.split(f["a"], np.cumsum(per_text)[:-1]), strict=True):
                weights[i] = a
        for i, t in enumerate(texts):
            if len(t) > LONG_BYTES:
                logits[i], weights[i] = self.pooled(t)
        return 1 / (1 + np.exp(-np.clip(logits + self.shift, -40, 40))), weights


def fit_bags(x: np.ndarray, per_bag: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Adam on the logistic loss, both labels weighing the same, by the gradients of forward()."""
    rng = np.random.default_rng(seed)
    make = lambda *d: (rng.standard_normal(d) / np.sqrt(d[0])).astype(np.float32)
    p = {"E": make(x.shape[1], HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": make(HIDDEN, GATE), "U": make(HIDDEN, GATE), "w": make(GATE), "c": make(HIDDEN), "b": np.zeros((), np.float32)}
    model, m, v, step = Model(p, 0.0), {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    first = np.cumsum(per_bag) - per_bag
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // 128)):
            n = per_bag[part]
            rows = np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            xs = x[rows].astype(np.float32)
            step += 1
            for k, grad in model.gradients(xs, n, y[part], weight[part] / len(part)).items():
                grad = grad + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.99 * v[k] + 0.01 * grad * grad
                p[k] -= (0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(key: Column) -> Column:
    """True for a fifth of the documents, which no model is fitted on."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, inputs of all passages in half precision) of every document."""
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for a, _, texts in text_runs(batch.column(1), 1):
            for t in texts:
                rows = b"".join(inputs(c).astype("<f2").tobytes() for c in slabs(t))
                yield pa.RecordBatch.from_pydict({"label": pa.array([labels[a]], pa.int32()), "x": pa.array([rows], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS, per_class_bytes: int = PER_CLASS_BYTES) -> Model:
    """A model from the labelled documents that are not held out; labels are joined by `key`."""
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where((F.col("label") == F.col("most")) & ~held_out(F.col("key")))
    )
    shares = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log((shares.get(1, 0) + 1) / (shares.get(0, 0) + 1)))
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("key"), "key").limit(per_class) for c in (0, 1)]
    # at most 2 * per_class ids: a proven bound
    sample = F.broadcast(parts[0].unionByName(parts[1]).select("key", "label"))
    own = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sized = own.join(sample, "key").select("key", "label", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    # a window over at most 2 * per_class keys (more only where keys repeat)
    before = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < per_class_bytes)
    chosen = F.broadcast(sized.groupBy("key").agg(F.min("label").alias("label")))
    rows = own.join(chosen, "key").select("label", "text").mapInArrow(lean(_encoded), "label int, x binary").collect()
    rows.sort(key=lambda r: (r.label, bytes(r.x)))
    y = np.array([r.label for r in rows])
    if len(set(y.tolist())) < 2:
        return Model({}, prior)
    bags = [np.frombuffer(r.x, "<f2").reshape(-1, INPUTS) for r in rows]
    per_bag, x = np.array([len(b) for b in bags]), np.concatenate(bags)
    del rows, bags
    model = fit_bags(x, per_bag, y)
    model.shift = prior
    del x
    give_back()
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, attention: bool = False, within: bool = False) -> DataFrame:
    """`docs` (columns `keep`, all by default) with `score`, and with `attention` each passage's weight.

    `within` says that the text is one of `keep`, a string, and need not be sent a second time.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "attention")]
    fields = [docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())]
    fields += [T.StructField("attention", T.ArrayType(T.FloatType()))] * attention
    shared = Shared(docs.sparkSession, model)  # of fixed size
    own = docs.select(*keep) if within else docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return own.mapInArrow(_scorer(shared, keep, attention, text if within else "__text"), T.StructType(fields))


def _scorer(model, keep: list[str], attention: bool, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_runs(batch.column(batch.schema.get_field_index(text)), CHUNK_BYTES):
                scores, weights = model.value.score(texts)
                rows = batch.slice(a, b - a)
                columns = [rows.column(rows.schema.get_field_index(c)) for c in keep] + [pa.array(scores, pa.float64())]
                names = [*keep, "score"]
                if attention:
                    columns.append(pa.array([w.tolist() for w in weights], pa.list_(pa.float32())))
                    names.append("attention")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return lean(run)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that a model fitted on `labels` doesn't reject, with their own columns; a text travels once."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    kept = score(docs.toDF(*names), fit(docs, labels), text=names[docs.columns.index("text")], within=True)
    return kept.where(F.col("score") >= threshold).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = score(docs, fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
