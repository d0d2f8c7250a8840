"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters, words set off by one space) in falling order
of frequency. A language's profile comes from all its labelled documents, a document's from its whole text. The distance
of a document to a language is the sum, over the document's n-grams, of how far each is out of place in the language's
profile; an n-gram that the profile lacks counts as far as can be. The nearest language is predicted.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill.llm.common import release, rows_to_arrow, small_slices

TOP = 300
PIECE = 1 << 19  # characters of a text that are counted at a time
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(symbols: np.ndarray) -> np.ndarray:
    """N-grams as numbers: 21 bits a symbol, the last one lowest; a space alone, or two in a row, is none."""
    letter = symbols != 32
    two = (symbols[:-1] << 21) | symbols[1:]
    three = (two[:-1] << 21) | symbols[2:]
    return np.concatenate([symbols[letter], two, three[letter[1:-1]]])


def _add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    n = np.zeros(len(codes), np.int64)
    np.add.at(n, at, np.concatenate([a[1], b[1]]))
    return codes, n


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes, ascending, and their counts."""
    total = None
    tail = np.array([32], np.int64)  # symbols carried over, so that n-grams across pieces are counted once
    for at in range(0, len(text) or 1, PIECE):
        a = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        a = np.where(letters[a], a, 32)
        a = np.concatenate([tail, a, [32]] if at + PIECE >= len(text) else [tail, a])
        keep = a != 32
        keep[1:] |= a[:-1] != 32  # a space only behind a letter
        keep[0] = True
        a = a[keep]
        codes = _codes(a)
        if at:  # what lies inside the carried symbols was counted with the piece before
            old = _codes(tail)
            got, n = np.unique(codes, return_counts=True)
            gone, m = np.unique(old, return_counts=True)
            n[np.searchsorted(got, gone)] -= m
            here = got[n > 0], n[n > 0]
        else:
            here = np.unique(codes, return_counts=True)
        total = here if total is None else _add(total, here)
        tail = a[-2:]
    return total


def profile(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The `top` most frequent codes; of equal counts the smaller code comes first."""
    if len(codes) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:top]]


def held_out(key: str = "doc_id") -> Column:
    """Rows kept away from training: crc32 of the key's text, modulo 3, is 1."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, held = letter_table(), {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pydict()
            texts: dict[str, list[str]] = {}
            for lang, text in zip(part["lang"], part["text"]):
                texts.setdefault(lang, []).append(text)
            for lang, several in texts.items():
                here = gram_counts("\n".join(several), letters)
                held[lang] = _add(held[lang], here) if lang in held else here
        if sum(len(c) for c, _ in held.values()) > 2_000_000:  # memory: hand over what was counted so far
            yield from _told(held)
            held = {}
    yield from _told(held)


def _told(held: dict) -> Iterator[pa.RecordBatch]:
    for lang, (codes, n) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                                         ["lang", "code", "n"])


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> dict[str, np.ndarray]:
    """Profile of each label over all given rows with a text and a label: `top` numbers a label reach the driver."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(_counted, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "code")
    kept = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    found: dict[str, list[int]] = {}
    for r in kept.orderBy("lang", "rank").collect():
        found.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, np.int64) for k, v in found.items()}


class Ranker:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = TOP):
        self.names, self.top = sorted(profiles), top
        self.codes = np.unique(np.concatenate([*profiles.values(), np.array([], np.int64)]))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)  # the last row: in no profile
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[name]), k] = np.arange(len(profiles[name]))
        self.letters = letter_table()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names:
            return UNKNOWN, 0.0
        codes, counts = gram_counts(text, self.letters)
        mine = profile(codes, counts, self.top)
        if not len(mine):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, mine)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != mine)] = len(self.codes)
        ranks = self.ranks[at]
        far = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(mine))[:, None])).sum(axis=0)
        best = int(far.argmin())  # of equal distances the first name
        return self.names[best], 1.0 - float(far[best]) / (self.top * len(mine))


def predict_language(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", key: str = "doc_id",
                     top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score of every row, from the text alone.

    `und` with score 0 where the text is null or has no letter (or no profile was learned); else the score is 1 less the
    distance's share of the largest possible one. Rows that repeat a key are predicted each by itself.
    """
    def make():
        ranker = Ranker(profiles, top)
        return lambda doc_id, value: (doc_id, *ranker.predict(value))

    return rows_to_arrow(docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")),
                         "doc_id bigint, lang_pred string, score double", make)


def language_id(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", top: int = TOP) -> DataFrame:
    """Learn from the rows that are not held out, predict all: doc_id, held_out, lang_pred, score.

    An empty table gives no rows, a null key is never held out, extra columns are not read.
    """
    profiles = fit_profiles(docs.filter(~held_out(key)), text, lang, top)
    told = predict_language(docs, profiles, text, key, top)
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, profiles: dict[str, np.ndarray], min_score: float, text: str = "text",
                      top: int = TOP) -> DataFrame:
    """The rows of `docs` whose text is in one of the languages, that is, scores `min_score` or more.

    Null text, and text without letters, is in none. All columns stay as they are; an empty table gives no rows. Texts, of any
    length, are worked on whole, one after the other.
    """
    schema = docs.schema
    where = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, top)
        for whole in batches:
            for batch in small_slices(whole, where):  # what a task holds stays small when texts are long
                told = [ranker.predict(v) for v in batch.column(where).to_pylist()]
                yield batch.filter(pa.array([n != UNKNOWN and s >= min_score for n, s in told], pa.bool_()))
        whole = batch = told = ranker = None  # else they would be held still
        release()

    return docs.mapInArrow(run, schema)
