"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is folded to lower case and cut into runs of letters; its subwords are all runs of 1 to ``MAX_GRAM`` characters of a
word, the word's borders counting as a character. Each subword has a bucket by hash, each bucket a small
vector; the mean of a text's vectors goes through one linear layer and a softmax. Vectors and layer are
learned together by stochastic gradient descent in numpy, text by text, on a bounded sample: at most
``TRAIN_ROWS`` rows are expected in it, the same number from each language that has that many, chosen by hash over the whole
table, and from each a fragment of a few words besides. A fifth of the sample is kept from training; on it a temperature is fitted, so that a score is a
probability, and the least score is looked for above which at most ``MAX_ERROR`` of the texts are wrong. Answers with
a lower score are marked ``rejected``.

Both layers are linear, so vectors and layer are one table of bucket by language when it comes to predicting: a
text's logits are the mean of its subwords' lines. Texts are read whole, long ones in pieces.

A prediction depends on the text alone. A null text, and one without a letter, is ``und`` with score 0 and
rejected. Rows with a null language or a null id teach nothing, and rows with a null id are not held out. Repeated rows teach once; each gets
its answer. Of languages with equal scores the first in order of name is taken. If nothing can be learned, all is ``und``. An
empty table gives no rows. Only the id, the text and the language are read. More than ``MAX_LANGUAGES`` language values are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

MAX_GRAM = 4
BUCKETS = 1 << 15
DIMENSIONS = 16
TRAIN_ROWS = 4096
# Passes over the sample; more, if these are not so many steps in all.
EPOCHS = 10
LEAST_STEPS = 4000
FRAGMENT_WORDS = 12
RATE = 0.5
SEED = 11
MAX_ERROR = 0.01
MAX_LANGUAGES = 1000
# Characters that are worked on at once.
PIECE = 1 << 19
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _buckets(codes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of the subword of length ``n`` that begins at each place."""
    many = len(codes) - n + 1
    h = np.full(many, n, np.uint64)
    for i in range(n):
        h = (h ^ codes[i : i + many].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % buckets


def subwords(codes: np.ndarray, docs: np.ndarray, begin: int, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of all subwords that end at ``begin`` or later. Borders of words have code 0 and stand alone."""
    for n in range(1, MAX_GRAM + 1):
        many = len(codes) - n + 1
        if many <= 0:
            return
        if n == 1:
            good = codes != 0
        else:
            good = np.ones(many, bool)
            for i in range(1, n - 1):
                good &= codes[i : i + many] != 0
        good[: max(0, begin - n + 1)] = False
        at = np.flatnonzero(good)
        # A border belongs to the word behind it if the subword begins there.
        yield _buckets(codes, n, buckets)[at], docs[at + (codes[at] == 0) if n > 1 else at]


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Texts as codes with the document of each, in pieces of bounded size. A piece of a long text begins with the end of
    the piece before it."""
    letters = _letters()
    carry_codes, carry_docs = np.zeros(1, np.uint32), np.zeros(1, np.int64)
    waiting: list[str] = []
    owners: list[int] = []
    size = 0

    def piece():
        nonlocal carry_codes, carry_docs
        folded = [w.casefold() for w in waiting]
        raw = _codes("".join(folded))
        raw = np.where(letters[np.minimum(raw, 0x10FFFF)], raw, 0)
        docs = np.repeat(np.array(owners, np.int64), [len(f) for f in folded])
        keep = (raw != 0) | (np.r_[carry_codes[-1:], raw[:-1]] != 0)
        codes, docs, begin = np.r_[carry_codes, raw[keep]], np.r_[carry_docs, docs[keep]], len(carry_codes)
        carry_codes, carry_docs = codes[-(MAX_GRAM - 1) :], docs[-(MAX_GRAM - 1) :]
        return codes, docs, begin

    for number, text in enumerate(texts):
        # A line end closes each text.
        text = (text or "") + "\n"
        for low in range(0, len(text), PIECE):
            part = text[low : low + PIECE]
            waiting.append(part)
            owners.append(number)
            size += len(part)
            if size >= PIECE:
                yield piece()
                waiting, owners, size = [], [], 0
    if waiting:
        yield piece()


def bucket_weights(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and the share of each in its subwords."""
    counts = np.zeros(buckets, np.int64)
    for codes, docs, begin in _pieces([text]):
        for bucket, _ in subwords(codes, docs, begin, buckets):
            counts += np.bincount(bucket, minlength=buckets)
    hit = np.flatnonzero(counts)
    return hit.astype(np.int32), (counts[hit] / max(1, counts.sum())).astype(np.float32)


class Model:
    """Lines of bucket by language, bias, temperature and the least score that is not rejected."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, least: float = 0.0):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.least = temperature, least

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and the number of subwords."""
        total, number = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for codes, docs, begin in _pieces(texts):
            for bucket, doc in subwords(codes, docs, begin, len(self.table)):
                if len(doc):
                    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    total[doc[starts]] += np.add.reduceat(self.table[bucket], starts, axis=0)
                    number[doc[starts]] += np.diff(np.r_[starts, len(doc)])
        return total / np.maximum(number, 1)[:, None] + self.bias, number

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """language, score, rejected"""
        logits, number = self.logits(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(number > 0, p[np.arange(len(p)), best], 0.0)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, number)]
        return names, score, (score < self.least) | (number == 0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray]], answers: np.ndarray, languages: list[str], buckets: int = BUCKETS) -> Model:
    """Stochastic gradient descent, one text at a step, with a rate that falls to zero."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (buckets, DIMENSIONS)) / DIMENSIONS
    layer, bias = np.zeros((len(languages), DIMENSIONS)), np.zeros(len(languages))
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(samples)))
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            at, share = samples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ vectors[at]
            slope = softmax(layer @ hidden + bias)
            slope[answers[i]] -= 1
            back = slope @ layer
            layer -= rate * np.outer(slope, hidden)
            bias -= rate * 0.1 * slope
            vectors[at] -= rate * share[:, None] * back
    return Model(languages, vectors @ layer.T, bias)


def calibrate(model: Model, samples: list[tuple[np.ndarray, np.ndarray]], answers: np.ndarray, max_error: float = MAX_ERROR) -> None:
    """Temperature with the least loss, then the least score with at most ``max_error`` wrong answers above it."""
    if not len(samples):
        return
    logits = np.array([share @ model.table[at] for at, share in samples]) + model.bias
    rows, n = np.arange(len(answers)), len(answers)
    # A few rows without an error do not prove that there are none, hence targets a little below one.
    target = np.full(logits.shape, 1 / (n + 2) / max(1, logits.shape[1] - 1))
    target[rows, answers] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return -(target * (z - np.log(np.exp(z).sum(axis=1, keepdims=True)))).sum(axis=1).mean()

    # The loss is smooth in the temperature; the scale of the logits says where to look.
    scale = max(float(np.abs(logits - logits.mean(axis=1, keepdims=True)).mean()), 1e-9)
    model.temperature = float(min(scale * np.geomspace(0.01, 10, 151), key=loss))
    p = softmax(logits / model.temperature)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != answers
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share <= max_error)
    # As far down as the share of errors stays within bounds.
    model.least = float(score[order[good[-1]]]) if len(good) and good[-1] < len(order) - 1 else (0.0 if len(good) else 1.0)


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Rows that teach nothing; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def fragment(text: str, pick: int) -> str:
    """A few words from somewhere in a text, so that short texts are learned, too."""
    rng = np.random.default_rng(pick & (2**63 - 1))
    many = int(rng.integers(1, FRAGMENT_WORDS + 1))
    at = int(rng.integers(0, len(text)))
    return " ".join(text[at : at + 32 * (many + 1)].split()[1 : many + 1])


SAMPLE = "lang string, pick bigint, buckets array<int>, shares array<float>"


def training_sample(docs: DataFrame, rows: int, id_col: str, text_col: str, lang_col: str, buckets: int) -> DataFrame:
    """lang, pick, buckets, shares of about ``rows`` rows, spread evenly over the languages."""
    learnable = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    learnable = learnable.where(F.col(text_col).rlike(r"\p{L}"))
    counts = learnable.groupBy(F.col(lang_col).alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    quota = rows / max(1, len(counts))
    rate = F.lit(0.0)
    for line in counts:
        rate = F.when(F.col(lang_col) == line["lang"], F.lit(quota / line["count"])).otherwise(rate)
    pick = F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col))
    chosen = learnable.where((F.shiftrightunsigned(pick, 11) / F.lit(float(1 << 53))) < rate)
    # Repeated rows have the same hash: either none or all of them are chosen, and one is kept.
    chosen = chosen.select(F.col(lang_col).cast("string").alias("lang"), pick.alias("pick"), F.col(text_col).alias("text")).dropDuplicates(["lang", "pick"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, pick, text in zip(batch["lang"].to_pylist(), batch["pick"].to_pylist(), batch["text"].to_pylist()):
                lines = [bucket_weights(t, buckets) for t in (text, fragment(text, pick))]
                lines = [line for line in lines if len(line[0])]
                columns = [
                    pa.array([lang] * len(lines)), pa.array([pick] * len(lines), pa.int64()),
                    pa.array([a for a, _ in lines], pa.list_(pa.int32())), pa.array([s for _, s in lines], pa.list_(pa.float32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "pick", "buckets", "shares"])

    return chosen.mapInArrow(weigh, SAMPLE)


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """The model of the sample, trained on the driver: some ``2 * rows`` lists of at most ``buckets`` numbers."""
    sample = materialize(training_sample(docs, rows, id_col, text_col, lang_col, buckets), "sample").toArrow()
    lines = sorted(zip(sample["pick"].to_pylist(), sample["lang"].to_pylist(), range(sample.num_rows)))
    languages = sorted({lang for _, lang, _ in lines})
    if not languages:
        return Model([], np.zeros((buckets, 0)), np.zeros(0))
    features = [
        (sample["buckets"][i].values.to_numpy().astype(np.int64), sample["shares"][i].values.to_numpy().astype(np.float64)) for _, _, i in lines
    ]
    answers = np.array([languages.index(lang) for _, lang, _ in lines])
    kept = np.array([pick % 5 == 0 for pick, _, _ in lines])
    if kept.all() or len(set(answers[~kept])) < len(languages):
        kept[:] = False  # too few rows to do without any
    model = train([f for f, k in zip(features, kept) if not k], answers[~kept], languages, buckets)
    calibrate(model, [f for f, k in zip(features, kept) if k], answers[kept])
    return model


def predict_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected. The model has one line per bucket and is sent once to each executor."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, score, rejected = sent.value.predict(list(texts))
            yield pd.DataFrame({"lang_pred": names, "score": score, "rejected": rejected})

    return docs.withColumn("_answer", answers(F.col(text_col))).select(*docs.columns, "_answer.*")


def identify(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score, rejected of every document, by a model fitted on those that are not held out."""
    model = fit(docs, rows, id_col, text_col, lang_col)
    answered = predict_language(docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("_text")), model, "_text")
    return answered.drop("_text")
