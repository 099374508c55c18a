"""Language of texts by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from chuvisco.llm.shared import flat, slices, stored, table, texts_of

#: Features: byte pairs as they are, and byte triples hashed to as many places.
PLACES = 1 << 16
UNKNOWN = "und"
#: Distinct labelled texts from which on it is learned what no longer is a text of a learned language; unknown n-grams
#: that a single odd word brings, for these do not come one by one.
LEAST, BURST = 30, 16

#: White space becomes a blank, other ASCII that is no letter vanishes, A-Z become lower case.
_MAP = np.zeros(256, np.uint8)
_MAP[128:] = np.arange(128, 256)
_MAP[[9, 10, 11, 12, 13, 32]] = 32
_MAP[97:123] = np.arange(97, 123)
_MAP[65:91] = np.arange(97, 123)
_DROPPED = _MAP == 0


def code_words(classes: int) -> np.ndarray:
    """A row of +1 and -1 per class. Up to 7 classes: every way to part them in two (the exhaustive code, any two rows
    differ in more than half of the bits); beyond: rows of a Hadamard matrix without its constant column, which differ
    in half of the bits."""
    if classes <= 7:
        parts = [p for p in itertools.product((1, -1), repeat=classes) if p[0] == 1 and -1 in p]
        return np.array(parts, np.int8).T.reshape(classes, -1)
    size = 1 << int(np.ceil(np.log2(classes)))
    h = np.ones((1, 1), np.int8)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    columns = h[:classes, 1:]
    return columns[:, np.abs(columns.sum(axis=0)) < classes]


def grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all n-grams of all texts, and the text each belongs to; n-grams never cross texts."""
    kept = ~_DROPPED[data]
    bytes_ = _MAP[data[kept]].astype(np.uint32)
    bounds = np.r_[0, np.cumsum(kept)][starts]
    n = len(bytes_)
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(bounds))
    if n < 2:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    pair = bytes_[:-1] << 8 | bytes_[1:]
    triple = PLACES + (((pair[:-1] << 8 | bytes_[2:]) * np.uint32(2654435761)) >> 16)
    in_pair, in_triple = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    blank = pair != (32 << 8 | 32)
    return (
        np.r_[pair[in_pair & blank], triple[in_triple & blank[:-1]]],
        np.r_[owner[:-1][in_pair & blank], owner[:-2][in_triple & blank[:-1]]],
    )


@dataclass(frozen=True)
class Model:
    """``weights``: per place a weight for each bit; ``codes``: per language its bits; ``limits``: the share of unknown
    n-grams and the loss per bit from which on a text is rejected, none if too few texts were there to learn them."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    limits: tuple[float, float] | None = None

    def margins(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """What the binary classifier of each bit says of each text: the mean weight of its n-grams, scaled."""
        place, owner = grams(data, starts)
        texts = len(starts) - 1
        count = np.maximum(np.bincount(owner, minlength=texts), 1)
        sums = np.stack([np.bincount(owner, w[place], texts) for w in self.weights], axis=1)
        return sums / count[:, None] + self.bias

    def rejected(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether a text is in none of the languages: it has n-grams and none was seen in learning, more of them are unknown
        than labelled texts (and a few odd words) have, or its nearest code word is farther away than those of labelled
        texts and another one almost as near. Without limits nothing is."""
        texts = len(starts) - 1
        if self.limits is None:
            return np.zeros(texts, bool)
        share, most = self.limits
        place, owner = grams(data, starts)
        n = np.bincount(owner, minlength=texts)
        known = np.bincount(owner, (self.weights != 0).any(axis=0)[place], texts)
        expected = share * n
        unknown = n - known > expected + 3 * np.sqrt(BURST * expected) + BURST
        margins = self.margins(data, starts)
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None, :, :]).mean(axis=2).min(axis=1)
        return ((n > 0) & (known == 0)) | unknown | ((loss > most) & self.decode(margins)[2])

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest code word by loss, its score, and whether another one is almost as near.

        A bit's loss for a language is the logistic loss of its margin against the language's bit, so a bit that is
        unsure weighs little. The score is the soft minimum's share.
        """
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None, :, :]).sum(axis=2)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = np.argmin(loss, axis=1)
        ordered = np.sort(loss, axis=1)
        close = (ordered[:, 1] - ordered[:, 0] < 0.1 * self.codes.shape[1]) if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return best, share[np.arange(len(best)), best], close


def fit(texts: list[str], languages: list[str]) -> Model:
    held = [t.encode("utf-8", "replace") for t in texts]
    place, owner = grams(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]))
    cell, n = np.unique(owner.astype(np.int64) * 2 * PLACES + place, return_counts=True)
    return fit_counts(cell // (2 * PLACES), cell % (2 * PLACES), n, np.unique(texts, return_inverse=True)[1], languages)


def fit_counts(
    row: np.ndarray,
    place: np.ndarray,
    n: np.ndarray,
    names_of_texts: np.ndarray,
    languages: list[str],
    rounds: int = 40,
    rate: float = 4.0,
    decay: float = 1e-4,
) -> Model:
    """Logistic regression for each bit on the relative frequencies of n-grams (their square roots would need the whole
    text before any weight is looked up; means can be summed). Text ``row`` has the n-gram at ``place`` ``n`` times; equal
    texts have equal names."""
    names, texts = sorted(set(languages)), len(languages)
    count = np.maximum(np.bincount(row, n, texts), 1)
    used, column = np.unique(place, return_inverse=True)
    # relative frequency times the place's inverse mean frequency, so that rare and common n-grams learn alike
    value = n / count[row]
    spread = np.sqrt(np.bincount(column, value, len(used)) / max(texts, 1)) + 1e-3
    value = value / spread[column]
    codes = code_words(len(names))
    target = codes[np.searchsorted(names, languages)].astype(float)
    weight, bias = np.zeros((codes.shape[1], len(used))), np.zeros(codes.shape[1])
    step, step_bias = np.full_like(weight, 1e-8), np.full_like(bias, 1e-8)
    classes, sizes = np.unique(languages, return_counts=True)
    share = (1 / (len(classes) * sizes))[np.searchsorted(classes, languages)]  # each language counts alike
    for _ in range(rounds):
        for b in range(codes.shape[1]):
            margin = np.bincount(row, value * weight[b][column], texts) + bias[b]
            pull = -share * target[:, b] / (1 + np.exp(np.clip(target[:, b] * margin, -50, 50)))
            slope = np.bincount(column, value * pull[row], len(used)) + decay * weight[b]
            step[b] += slope**2
            weight[b] -= rate * slope / np.sqrt(step[b])
            step_bias[b] += pull.sum() ** 2
            bias[b] -= rate / 10 * pull.sum() / np.sqrt(step_bias[b])
    whole = np.zeros((codes.shape[1], 2 * PLACES), np.float32)
    whole[:, used] = weight / spread
    first = np.unique(names_of_texts, return_index=True)[1]
    limits = None
    if len(first) >= LEAST:
        distinct = np.isin(row, first)
        once = np.bincount(column[distinct], minlength=len(used)) == 1
        # each labelled text as if it had not been there to learn from
        lone = np.bincount(row[distinct], (n * once[column])[distinct], texts)[first] / count[first]
        margins = np.stack([np.bincount(row, value * w[column], texts) for w in weight], axis=1) + bias
        loss = np.logaddexp(0, -margins[:, None, :] * codes[None, :, :]).mean(axis=2).min(axis=1)
        # no nearer than a text that says nothing, whose loss is log 2
        limits = min(3 * float(np.quantile(lone, 0.99)), 0.25), max(float(loss.max()), float(np.log(2)))
    return Model(names, codes, whole, bias, limits)


_SAMPLED = pa.schema([("lang", pa.string()), ("order", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram counts of whole texts, once a task for each text and language."""
    seen = set()
    for batch in slices(batches):
        names = list(zip(batch.column("lang").to_pylist(), batch.column("order").to_pylist(), strict=True))
        new = [i for i, name in enumerate(names) if not (name in seen or seen.add(name))]
        if not new:
            continue
        place, owner = grams(*flat(batch.column("text").take(pa.array(new))))
        cell, n = np.unique(owner.astype(np.int64) * 2 * PLACES + place, return_counts=True)
        ends = np.searchsorted(cell, np.arange(1, len(new)) * 2 * PLACES)
        places = [x.astype(np.int32).tobytes() for x in np.split(cell % (2 * PLACES), ends)]
        counts = [x.astype(np.int64).tobytes() for x in np.split(n, ends)]
        yield table(_SAMPLED, lang=[names[i][0] for i in new], order=[names[i][1] for i in new], places=places, counts=counts)


def training_sample(docs: DataFrame, fold: int, folds: int, most: int, least: int) -> list[Row]:
    """The n-gram counts of labelled texts outside the held-out fold: of each language the texts of the smallest hashes,
    ``most`` in all languages together, but ``least`` of each where it has so many. Copies count once. Counts are of
    whole texts, made where these are; at most twice ``PLACES`` a text come to the driver."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(fold, folds))
    labelled = labelled.select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 31)).alias("order"))
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("order").alias("n")).collect()  # a row a language
    if not sizes:
        return []
    each = max(least, most // len(sizes))
    limits = [(r.lang, int(min(1.0, 1.5 * each / max(r.n, 1)) * (1 << 31))) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, upto long")
    near = labelled.join(F.broadcast(limits), "lang").where("order <= upto").select("lang", "order").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    drawn = stored(near.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "order"))
    texts = labelled.join(F.broadcast(drawn), ["lang", "order"]).select("lang", "order", "text")
    counts = texts.mapInArrow(_sampled, "lang string, order long, places binary, counts binary")
    return sorted(counts.dropDuplicates(["lang", "order"]).collect(), key=lambda r: (r.order, r.lang))


def held_out(fold: int, folds: int):
    """Null keys count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]
)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(pc.fill_null(texts, ""), r"\pL").to_numpy(zero_copy_only=False)


def predictor(model: Model):
    """What gives language, score and doubt for a column of whole texts."""

    def predict(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        letters = has_letter(texts)
        if not model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        best, score, close = model.decode(model.margins(*flat(texts)))
        names = [model.languages[i] if letter else UNKNOWN for i, letter in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0), close | ~letters

    return predict


def learned(docs: DataFrame, fold: int = 0, folds: int = 5, most: int = 2000, least: int = 50) -> Model:
    rows = training_sample(docs, fold, folds, most, least)
    if not rows:
        return Model([], code_words(1), np.zeros((0, 2 * PLACES), np.float32), np.zeros(0))
    places = [np.frombuffer(r.places, np.int32) for r in rows]
    counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p in places])
    return fit_counts(owner, np.concatenate(places), counts, np.array([r.order for r in rows]), [r.lang for r in rows])


def identify(
    docs: DataFrame,
    fold: int = 0,
    folds: int = 5,
    most: int = 2000,
    least: int = 50,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The language of each whole text, a row per row of ``docs``.

    Learned from at most ``most`` distinct texts (or ``least`` of each language, if these are more) of rows whose key's
    crc32 modulo ``folds`` is not ``fold``: whole texts, as many of each language, so that a rare one is learned as well. A
    null text or one without a letter is ``und`` with score 0; so is every text if there is nothing to learn from. ``ambiguous`` marks texts for
    which a second code word is almost as near. The model (two tables of ``PLACES`` weights per bit) has a fixed size
    and goes to the tasks with the function.
    """
    plain = texts_of(docs, key, text, F.col(lang).cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(learned(plain, fold, folds, most, least))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = predictor(model.value)
        for batch in slices(batches):
            names, score, close = predict(batch.column("text"))
            yield table(_FOUND, doc_id=batch.column("doc_id"), lang_pred=names, score=score, ambiguous=close)

    found = plain.select("doc_id", "text").mapInArrow(classify, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return found.select("doc_id", held_out(fold, folds).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text has a language: those without text or letters go, and those the model rejects (see
    ``Model.rejected``). A model that learned from nothing, or from fewer than ``LEAST`` distinct texts, rejects none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(place)
            yield batch.filter(pa.array(has_letter(texts) & ~shared.value.rejected(*flat(texts))))

    return docs.mapInArrow(keep, docs.schema)
