"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased and everything between them is one blank; n-grams of one to three characters
are hashed into 65,536 bins. Document frequencies count all training documents. The regression is
trained with follow-the-regularised-leader and elastic-net penalties on a sample of about ``per_label``
documents for each label (all of them if there are fewer), of which a fifth is held back to fit
one temperature for all scores. The model has labels x bins weights, most of them zero, and is all that reaches the driver.

Null texts and those without a letter are ``und`` with score 0, as is everything if there is no
training document. Whole texts are used, however long. Documents with a null label are never trained on; labels that tie go to the
first in order. Repeated rows are each predicted; an empty table gives no rows. Only ``text``, ``lang`` and ``doc_id`` are read,
the last two for training alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.llm.spans import quoted
from betaloom.llm.tokens import CODES, code_points, release_memory, text_batches, tidy
from betaloom.tables import materialize

UNKNOWN = "und"
BITS = 16
BINS = 1 << BITS
ORDERS = (1, 2, 3)
PER_LABEL = 1500
MOST_LABELS = 1000
BATCH = 250_000  # characters; n-grams take about 100 bytes a character while they are counted
FEATURES = "lang string, place long, bins array<int>, counts array<int>"
MODEL = "label string, bin int, weight double, temperature double"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    if not _letters:
        out = np.full(CODES, 32, np.uint32)
        for code in range(CODES):
            if (c := chr(code)).isalpha():
                out[code] = ord(low) if len(low := c.lower()) == 1 else code
        _letters.append(out)
    return _letters[0]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bin, count) of all n-grams of a batch, sorted by document and bin, and which texts have a letter."""
    codes = letters()[code_points(" ".join(["", *texts, ""]))]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.append(np.repeat(np.arange(len(texts)), lengths), max(0, len(texts) - 1))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    known = np.bincount(owner[codes != 32], minlength=len(texts)) > 0
    keys = []
    with np.errstate(over="ignore"):
        gram = np.zeros(len(codes), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            gram = gram[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            if n in ORDERS and len(gram):
                inside = owner[: len(gram)] == owner[n - 1 :]
                bins = (gram[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
                keys.append((owner[: len(gram)][inside] << BITS) | bins.astype(np.int64))
    keys = np.concatenate(keys)
    keys = np.sort(keys.astype(np.uint32)) if len(texts) < BINS else np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first].astype(np.int64)
    return keys >> BITS, keys & (BINS - 1), counts, known


def strings(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that have each bin, and documents at all. Tasks count in an array; sums are at most as many rows as bins."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BINS + 1, np.int64)
        for frame in frames:
            for batch in text_batches(strings(frame["text"]), BATCH):
                _, bins, _, known = gram_counts(batch)
                total[:BINS] += np.bincount(bins, minlength=BINS)
                total[BINS] += known.sum()
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bin": some, "n": total[some]})

    summed = docs.select("text").mapInPandas(tidy(run), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    out = np.zeros(BINS + 1, np.int64)
    for row in summed.collect():  # at most BINS + 1 rows
        out[row["bin"]] = row["n"]
    return out[:BINS], int(out[BINS])


def inverse_frequencies(seen: np.ndarray, documents: int) -> np.ndarray:
    return np.log((1 + documents) / (1 + seen)) + 1


def sample(docs: DataFrame, per_label: int) -> DataFrame:
    """About ``per_label`` documents of each label by a hash of the text, as counted n-grams."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels: the weights of so many don't fit the driver")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(17), "text", "doc_id"), 11)
    upto = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(float(1 << 53) * min(1.0, per_label / n)))]
    chosen = docs.withColumn("place", place).where(F.col("place") < F.element_at(F.create_map(*upto), F.col("lang")) if upto else F.lit(False))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            low = 0
            for batch in text_batches(strings(frame["text"]), BATCH):
                own, bins, counts, known = gram_counts(batch)
                cuts = np.searchsorted(own, np.arange(len(batch) + 1))
                rows = [(bins[a:b].astype(np.int32), counts[a:b].astype(np.int32)) for a, b in zip(cuts, cuts[1:], strict=False)]
                out = frame.iloc[low : low + len(batch)][["lang", "place"]].copy()
                out["bins"], out["counts"] = [r[0] for r in rows], [r[1] for r in rows]
                yield out[known]
                low += len(batch)

    return chosen.select("lang", "place", "text").mapInPandas(tidy(run), FEATURES)


def weights_of(counts: np.ndarray, bins: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts)) * idf[bins]


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int, epochs: int, alpha: float, beta: float, l1: float, l2: float
) -> np.ndarray:
    """Weights (labels, bins) after ``epochs`` passes, one document at a time with a learning rate per weight."""
    z, n = np.zeros((labels, BINS)), np.zeros((labels, BINS))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for bins, values, label in rows:
            zi, ni = z[:, bins], n[:, bins]
            w = weights(zi, ni)
            logits = w @ values
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            g = p[:, None] * values
            more = ni + g * g
            z[:, bins] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[:, bins] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by narrowing an interval of its logarithm.

    The targets leave each label one document's share, or a sample without errors would ask for certainty.
    """
    n, k = logits.shape
    targets = np.full((n, k), 1 / (n + k))
    targets[np.arange(n), truth] += n / (n + k)

    def loss(at: float) -> float:
        x = logits / np.exp(at)
        x = x - x.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(x).sum(axis=1)) - (targets * x).sum(axis=1)))

    low, high = -4.0, 4.0
    for _ in range(60):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    """Labels, weights (labels, bins), bins' inverse frequencies and the temperature."""

    def __init__(self, labels: list[str], weights: np.ndarray, idf: np.ndarray, temperature: float):
        self.labels, self.weights, self.idf, self.temperature = labels, weights, idf, temperature

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        own, bins, counts, known = gram_counts(texts)
        values = weights_of(counts, bins, self.idf)
        norm = np.sqrt(np.bincount(own, values * values, len(texts)))
        norm[norm == 0] = 1
        logits = np.stack([np.bincount(own, values * w[bins], len(texts)) for w in self.weights], axis=1) / norm[:, None] if self.labels else np.zeros((len(texts), 0))
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        x = logits / self.temperature
        p = np.exp(x - x.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, p[np.arange(len(p)), best], 0.0)


def train(
    docs: DataFrame, per_label: int = PER_LABEL, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01
) -> Model:
    """A model from ``text`` and ``lang`` of all rows with a label."""
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    seen, documents = frequencies(labelled)
    idf = inverse_frequencies(seen, documents)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat([*frames, pd.DataFrame(columns=["lang", "place", "bins", "counts"])], ignore_index=True)
        frame = frame.sort_values(["place", "lang"], kind="stable")
        labels = sorted(set(frame["lang"]))
        if not labels:
            return
        rows = []
        for lang, bins, counts in zip(frame["lang"], frame["bins"], frame["counts"], strict=True):
            values = weights_of(counts, bins, idf)
            rows.append((bins, values / np.sqrt(values @ values), labels.index(lang)))
        held = [r for i, r in enumerate(rows) if i % 5 == 4]
        w = follow_the_leader([r for i, r in enumerate(rows) if i % 5 != 4], len(labels), epochs, alpha, beta, l1, l2)
        temperature = 1.0
        if held:
            temperature = fit_temperature(np.stack([w[:, b] @ v for b, v, _ in held]), np.array([y for *_, y in held]))
        for k, label in enumerate(labels):
            some = np.flatnonzero(w[k])
            some = some if len(some) else np.array([0])
            yield pd.DataFrame({"label": label, "bin": some, "weight": w[k][some], "temperature": temperature})

    fitted = materialize(sample(labelled, per_label).repartition(1).mapInPandas(tidy(run), MODEL), "language-model").toPandas()
    labels = sorted(set(fitted["label"]))
    weights = np.zeros((len(labels), BINS))
    weights[[labels.index(x) for x in fitted["label"]], fitted["bin"]] = fitted["weight"]
    return Model(labels, weights, idf, float(fitted["temperature"].iloc[0]) if labels else 1.0)


def held_out() -> Column:
    """Whether a document is for judging the model; a null id isn't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, then lang_pred and score, which replace input columns of those names."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # labels x bins numbers

    @F.pandas_udf("lang_pred string, score double")
    def predict(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in columns:
            labels, scores = [], []
            for batch in text_batches(strings(texts), BATCH):
                got = shared.value.predict(batch)
                labels += got[0]
                scores.append(got[1])
            yield pd.DataFrame({"lang_pred": labels, "score": np.concatenate([*scores, np.zeros(0)])})
            release_memory()

    # a filter on what was predicted must not make a second prediction below it
    found = predict.asNondeterministic()("text").alias("found")
    kept = F.struct(F.lit(0).alias("none"), *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)]).alias("rest")
    out = docs.select(kept, found)
    return out.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(names)], F.col("found.lang_pred").alias("lang_pred"), F.col("found.score").alias("score"))


def identify(docs: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Train on the documents not held out and predict all of them."""
    return predictions(docs, train(docs.where(~held_out()), per_label))
