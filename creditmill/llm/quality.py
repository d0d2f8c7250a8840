"""Quality rules: compression bands on top of simple counts.

Text that zstandard shrinks far more than prose repeats itself; text that it hardly shrinks is noise or encoded data.
How far prose shrinks depends on its length, so each band of byte lengths has its own limits. The ratio is taken of the
whole document and of its fixed chunks: a document also fails when more than a given share of its chunks do.
"""

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import rows_to_arrow

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of compressed / plain bytes by plain length: (least length, lowest ratio, highest ratio).

    A text shorter than the first length is not judged by its ratio. `chunk` is the chunk size in bytes (a shorter
    last chunk is judged by its own length's limits) and `bad_share` the share of failing chunks that is too many.
    """

    limits: tuple[tuple[int, float, float], ...] = (
        (200, 0.30, 0.90), (512, 0.25, 0.80), (2048, 0.22, 0.72), (8192, 0.20, 0.65), (65536, 0.18, 0.62))
    chunk: int = 8192
    bad_share: float = 0.5
    level: int = 3

    def verdict(self, size: int, ratio: float) -> str:
        for least, low, high in reversed(self.limits):
            if size >= least:
                return "repetitive" if ratio < low else "incompressible" if ratio > high else "ok"
        return "ok"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    n = len(words)
    if n < 4:  # two windows at least
        return 0
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    a = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if len(number) < 1 << 21:
        code = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
    else:  # three numbers no longer fit in 63 bits: number the pairs first
        code = np.unique(a[:-2] * len(number) + a[1:-1], return_inverse=True)[1] * len(number) + a[2:]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:shift + n - 2] |= twice
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six ASCII spaces
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def ratios(raw: bytes, bands: Bands, compressor) -> tuple[float, int, int, str]:
    """Ratio of the whole, number of chunks, number of failing chunks, verdict."""
    if not raw:
        return 1.0, 0, 0, "ok"
    ratio = len(compressor.compress(raw)) / len(raw)
    whole = bands.verdict(len(raw), ratio)
    failed: dict[str, int] = defaultdict(int)
    chunks = range(0, len(raw), bands.chunk) if len(raw) > bands.chunk else ()
    for at in chunks:
        part = raw[at:at + bands.chunk]
        told = bands.verdict(len(part), len(compressor.compress(part)) / len(part))
        if told != "ok":
            failed[told] += 1
    bad = sum(failed.values())
    if whole == "ok" and chunks and bad > bands.bad_share * len(chunks):
        whole = "chunks_" + max(sorted(failed), key=failed.__getitem__)
    return ratio, len(chunks), bad, whole


RESULT = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, ratio double, n_chunks bigint, n_bad_chunks bigint, reason string")


def quality(docs: DataFrame, bands: Bands = Bands(), min_words: int = 50, max_repeat_percent: int = 50,
            text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: the counts, base_failed, kept, and the ratios with the reason of the verdict.

    Null and empty text count as no words and fail the base rules. Rows that repeat a key are judged each by itself, and
    equal texts get equal verdicts. An empty table gives no rows; other columns of `docs` are not read. A text is worked
    on whole, by itself, in the task that reads it: nothing is shuffled.
    """
    def make():
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)

        def row(doc_id, value):
            value = value or ""
            counts = base_counts(value)
            failed = counts[0] < min_words or 100 * counts[4] > max_repeat_percent * counts[0]
            ratio, chunks, bad, told = ratios(value.encode(), bands, compressor)
            kept = not failed and told == "ok"
            return (doc_id, *counts, failed, kept, ratio, chunks, bad, "base" if failed else told)

        return row

    return rows_to_arrow(docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")), RESULT, make)
