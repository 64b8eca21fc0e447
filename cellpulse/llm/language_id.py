"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, every run of non-letters becomes one blank, and n-grams of one to three
characters are hashed into ``features`` cells. Their weights are (1 + log count) times the
inverse document frequency over all rows one may learn from, scaled to unit length.

The regression is trained by follow-the-regularised-leader with L1 and L2 penalties on a bounded
sample: about ``sample`` rows per language (parameter), chosen by a hash of the row. Each round,
shards of the sample start from the same state, make one pass, and their states are averaged, so
training is a handful of Spark jobs whose state is ``features`` x languages numbers. One row in
five of the sample is kept out of training and sets the temperature that calibrates the
probabilities.

Null text, or text without a letter, is ``und`` with score 0. Null languages are not learned
from. Without any row to learn from, every text is ``und``. Equal probabilities go to the
language that sorts first. Repeated rows get equal answers; empty tables give empty results.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.llm.text import release
from cellpulse.session import materialise

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 15
    sample: int = 1000          # expected rows per language used to fit
    shards: int = 8
    rounds: int = 4
    alpha: float = 0.5          # step size
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    temperatures: tuple = field(default=tuple(0.05 * 1.1 ** i for i in range(64)))


@dataclass
class LanguageModel:
    languages: list
    settings: Settings
    idf: object = None          # one number per feature
    weights: object = None      # features x languages
    temperature: float = 1.0


_LETTER = []


def _letters():
    import numpy as np
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def cells(text: str, features: int):
    """Feature cells of all n-grams of a text, with repeats; None if it has no letter."""
    import numpy as np
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]     # one blank after each run of letters
    codes = np.concatenate((np.uint32([32]), codes[keep], np.uint32([32])))
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + codes[1:]
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE35) + codes[2:]
    grams = np.concatenate((one, two * np.uint32(0x9E3779B1), three * np.uint32(0x9E3779B1)))
    grams ^= grams >> np.uint32(15)
    return (grams * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - (features.bit_length() - 1))


def counted(text: str, features: int):
    """(cells, counts) of a text, or None without a letter."""
    import numpy as np
    found = cells(text, features) if text else None
    if found is None:
        return None
    counts = np.bincount(found, minlength=features)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at, counts, idf):
    import numpy as np
    x = (1.0 + np.log(counts)) * idf[at]
    return x / np.sqrt((x * x).sum())


def softmax(z):
    import numpy as np
    e = np.exp(z - z.max())
    return e / e.sum()


def _leader(z, n, s: Settings):
    """Weights that the state (z, n) stands for."""
    import numpy as np
    shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0.0)
    return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def _document_frequencies(learn: DataFrame, s: Settings):
    """(rows, rows that hold each feature) over all rows to learn from."""
    import numpy as np
    features = s.features

    def count(batches):
        import pyarrow as pa
        held, rows = np.zeros(features + 1, "int64"), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = counted(text, features)
                if found:
                    held[found[0]] += 1
                    rows += 1
        held[features] = rows
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("int32")), pa.array(held[at])],
                                         names=["feature", "n"])
    total = (learn.select("text").mapInArrow(count, "feature int, n bigint")
             .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())
    held = np.zeros(features + 1, "int64")
    held[total["feature"].to_numpy()] = total["n"].to_numpy()
    return int(held[features]), held[:features]


def _sample(learn: DataFrame, counts: dict, languages: list, s: Settings) -> DataFrame:
    """Stored feature counts of the sampled rows: shard (-1: calibration), order, y, cells."""
    place = F.pmod(F.xxhash64("row", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.create_map(*[F.lit(v) for k in languages
                          for v in (k, min(1.0, s.sample / counts[k]))])
    index = F.create_map(*[F.lit(v) for i, k in enumerate(languages) for v in (k, i)])
    spot = F.pmod(F.xxhash64("row", F.lit(12)), F.lit(5 * s.shards))
    chosen = learn.where(place < rate[F.col("lang")]).select(
        F.when(spot % 5 == 0, -1).otherwise(F.floor(spot / 5)).cast("int").alias("shard"),
        F.xxhash64("row", F.lit(13)).alias("place"), index[F.col("lang")].alias("y"), "text")
    features = s.features

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = [counted(t, features) for t in batch.column(3).to_pylist()]
            kept = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(kept) for i in range(3)]
                + [pa.array([f[0].astype("int32") for f in found if f], pa.list_(pa.int32())),
                   pa.array([f[1].astype("int32") for f in found if f], pa.list_(pa.int32()))],
                names=["shard", "place", "y", "at", "n"])
    return materialise(chosen.mapInArrow(
        run, "shard int, place bigint, y int, at array<int>, n array<int>"), "language-sample")


def _round(sample: DataFrame, state, idf, s: Settings):
    """One pass of every shard from the same state; the averaged state."""
    import numpy as np
    shared = sample.sparkSession.sparkContext.broadcast((state, idf))
    shape = state[0].shape

    def run(frame):
        import pandas as pd
        (z0, n0), weight = shared.value
        z, n = z0.copy(), n0.copy()
        frame = frame.sort_values(["place", "y"], kind="stable")
        for at, counts, y in zip(frame["at"], frame["n"], frame["y"]):
            x = weighted(at, counts, weight)
            w = _leader(z[at], n[at], s)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            n_new = n[at] + g * g
            z[at] += g - (np.sqrt(n_new) - np.sqrt(n[at])) / s.alpha * w
            n[at] = n_new
        at = np.flatnonzero((n != 0).ravel())
        return pd.DataFrame({"spot": at, "z": z.ravel()[at], "n": n.ravel()[at],
                             "shards": 1})
    summed = (sample.where("shard >= 0").groupBy("shard")
              .applyInPandas(run, "spot bigint, z double, n double, shards int")
              .groupBy("spot").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toPandas())
    shards = max(1, sample.where("shard >= 0").select("shard").distinct().count())
    z, n = np.zeros(shape).ravel(), np.zeros(shape).ravel()
    z[summed["spot"].to_numpy()] = summed["z"].to_numpy() / shards
    n[summed["spot"].to_numpy()] = summed["n"].to_numpy() / shards
    return z.reshape(shape), n.reshape(shape)


def _temperature(sample: DataFrame, idf, weights, s: Settings) -> float:
    """Temperature of least log loss on the rows kept out of training."""
    import numpy as np
    shared = sample.sparkSession.sparkContext.broadcast((idf, weights))

    def run(frames):
        import pandas as pd
        loss = np.zeros(len(s.temperatures))
        idf, w = shared.value
        for frame in frames:
            for at, counts, y in zip(frame["at"], frame["n"], frame["y"]):
                z = weighted(at, counts, idf) @ w[at]
                for i, t in enumerate(s.temperatures):
                    scaled = z / t
                    top = scaled.max()
                    loss[i] += top + np.log(np.exp(scaled - top).sum()) - scaled[y]
        yield pd.DataFrame({"i": np.arange(len(loss)), "loss": loss})
    losses = (sample.where("shard = -1").mapInPandas(run, "i int, loss double")
              .groupBy("i").agg(F.sum("loss").alias("loss")).collect())
    if not losses or not any(r["loss"] for r in losses):
        return 1.0
    return s.temperatures[min(losses, key=lambda r: (round(r["loss"], 9), r["i"]))["i"]]


def fit(docs: DataFrame, learn: Column = None, key: str = "doc_id", text: str = "text",
        label: str = "lang", settings: Settings = Settings()) -> LanguageModel:
    """Learn from the rows where ``learn`` holds and the label is not null."""
    import numpy as np
    rows = docs.where(F.lit(True) if learn is None else learn).select(
        F.col(f"`{key}`").alias("row"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{label}`").cast("string").alias("lang")).where("lang IS NOT NULL")
    # One count per language, not per row.
    counts = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    model = LanguageModel(languages, settings)
    if not languages:
        return model
    total, held = _document_frequencies(rows, settings)
    model.idf = np.log((1.0 + total) / (1.0 + held)) + 1.0
    sample = _sample(rows, counts, languages, settings)
    state = (np.zeros((settings.features, len(languages))),) * 2
    for _ in range(settings.rounds):
        state = _round(sample, state, model.idf, settings)
    model.weights = _leader(*state, settings)
    model.temperature = _temperature(sample, model.idf, model.weights, settings)
    return model


def predict_one(text: str, model: LanguageModel) -> tuple:
    """(language, probability) of a text."""
    found = counted(text, model.settings.features) if model.languages else None
    if not found:
        return UNKNOWN, 0.0
    at, counts = found
    p = softmax(weighted(at, counts, model.idf) @ model.weights[at] / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def predict(docs: DataFrame, model: LanguageModel, keep: list, text: str = "text") -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` of every row."""
    slim = docs.select(*[f"`{k}`" for k in keep], F.col(f"`{text}`"))
    kinds = slim.dtypes
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            answers = [predict_one(t, shared.value) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([a for a, _ in answers], pa.string()),
                 pa.array([b for _, b in answers], pa.float64())],
                names=[*keep, "lang_pred", "score"])
    return slim.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in kinds[:len(keep)])
                           + ", lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageModel, min_score: float = 0.5,
               text: str = "text") -> DataFrame:
    """The rows whose language is known with at least ``min_score``; columns unchanged."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            answers = (predict_one(t, shared.value) for t in batch.column(at).to_pylist())
            yield batch.filter(pa.array([a != UNKNOWN and b >= min_score for a, b in answers],
                                        pa.bool_()))
        release()
    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows never learned from: checksum of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 3 == 1,
                      F.lit(False))


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predict every document, learning from the rows that are not held out."""
    model = fit(docs, ~held_out(), settings=settings)
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


