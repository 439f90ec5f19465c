"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and every
n-gram of 1 to 3 code points is hashed into a fixed number of buckets. Training
counts buckets per language over all training rows (added up in each task, then
by Spark); the log-probability matrix has at most buckets x languages entries,
is gathered once and broadcast. Scoring is array work on a slice of texts: the
matrix rows of all n-grams are gathered and added up text by text.

Cases: null text, or text without a letter, is ``und`` with score 0; texts are
read whole; languages tie in favour of the first by name; with no training rows
every text is ``und``; rows of null language are not learned from; repeated
rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import sliced

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
MAX_LANGUAGES = 512  # proves the bound of the broadcast matrix; more is an error
SMOOTHING = 0.5
UNKNOWN = "und"
_SLICE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter.
    Code points whose lower case is longer than one keep themselves."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _hashes(points: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point."""
    h = np.full(max(0, len(points) - order + 1), order, dtype=np.uint32)
    for j in range(order):
        h = (h ^ points[j : j + len(h)]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h & np.uint32(BUCKETS - 1)


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (buckets, n-grams per text). Each text has a space before
    and after it; n-grams do not cross texts. The first order counts spaces too."""
    raw = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = _letters()[raw]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    for order in ORDERS:
        # text i owns the n-grams that start at its leading space or in it
        starts = np.concatenate([[0], np.cumsum(lengths)])
        buckets = _hashes(points, order)
        if order > 2:  # starts in a text, but reaches into the next one
            keep = np.ones(len(buckets), dtype=bool)
            for back in range(1, order - 1):
                keep[np.maximum(starts[1:] - back, starts[:-1])[starts[1:] - back < len(keep)]] = False
            kept = np.concatenate([[0], np.cumsum(keep)])
            counts = np.diff(kept[np.minimum(starts, len(keep))])
            yield buckets[keep][: counts.sum()], counts
        else:
            counts = np.diff(np.minimum(starts, len(buckets)))
            yield buckets[: counts.sum()], counts


def has_letter(texts: list[str]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, t)) for t in texts), dtype=bool, count=len(texts))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task; bucket -1 counts documents."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for lo, texts in sliced(batch.column(1), _SLICE):
            own = langs[lo : lo + len(texts)]
            for lang in sorted(set(own.tolist())):
                mine = [t for t, x in zip(texts, own, strict=True) if x == lang]
                sums = total.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
                sums[BUCKETS] += len(mine)
                for buckets, _ in grams(mine):
                    sums[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
    for lang, sums in total.items():
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(np.where(used == BUCKETS, -1, used)), pa.array(sums[used])],
            names=["lang", "bucket", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log part of the training documents
    matrix: np.ndarray  # languages x buckets, log probabilities


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from every row with a language and a text."""
    rows = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most languages x (buckets + 1) rows
    table = counts.toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the model is bounded to {MAX_LANGUAGES}")
    row = np.searchsorted(np.array(names, dtype=object), np.array(table["lang"].to_pylist(), dtype=object)) if names else np.zeros(0, int)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    docs_of = np.zeros(len(names))
    docs_of[row[bucket < 0]] = n[bucket < 0]
    sums = np.full((len(names), BUCKETS), SMOOTHING)
    sums[row[bucket >= 0], bucket[bucket >= 0]] += n[bucket >= 0]
    return Model(names, np.log(docs_of / max(1.0, docs_of.sum())), np.log(sums / sums.sum(axis=1, keepdims=True)))


def scored(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(language, posterior probability) of each text."""
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    total = np.repeat(model.prior[:, None], len(texts), axis=1)
    for buckets, counts in grams(texts):
        ends = np.concatenate([[0], np.cumsum(counts)])
        for k in range(len(model.languages)):
            sums = np.concatenate([model.matrix[k].take(buckets), [0.0]])
            part = np.add.reduceat(sums, ends[:-1])
            total[k] += np.where(counts > 0, part, 0.0)
    best = total.argmax(axis=0)
    score = 1 / np.exp(total - total.max(axis=0)).sum(axis=0)
    letters = has_letter(texts)
    return [model.languages[b] if x else UNKNOWN for b, x in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in sliced(batch.column(1), _SLICE):
                langs, scores = scored(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array(langs, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside fold 1 of 3, predict all."""
    model = fit(docs.where(fold("doc_id", 3) != 1))
    return predicted(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
