"""Near-duplicate lines by a deletion-neighbourhood join.

Lines are sequences of words, and two are near when one word inserted, deleted or replaced turns one into the other; `edits`
may allow more for longer lines. For one edit each line emits itself and all variants with one word deleted as hashed keys.
Two lines are within one edit exactly when

* they give the same variant by deleting at the same place (a replaced word), or
* a variant of one is the other (a word more), or both have the same words (white space differs).

So a key needs no pairs among its lines: of all lines with the same variant and place the earliest is near to every other.
The edit distance to that earliest line is verified on the words, and a line that has an earlier near line is dropped. Equal
lines are dropped first. Before any variant is made, lines without a partner are set aside losslessly: a single edit leaves
one half of a line untouched, so near lines share the hash of a half.

Lines whose bound is two edits or more also meet by pieces: k edits leave one of the k + 1 pieces of the shorter line
untouched, and it lies in the longer line at one of a few places that the edits before and after it allow. Every pair that
shares such a piece is verified, so a piece that very many lines share costs pairs.
"""

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import meet, release, rows_to_arrow, shard_join, shards_for, small_slices
from creditmill.llm.jaccard_join import WordHash
from creditmill.session import settle, shuffle_width

NEAR_WORDS = 8  # shorter lines are duplicates only when equal
EDITS = ((0, 1),)  # (words, edits): from so many words on, lines within so many edits are near
EDITS_BY_LENGTH = ((0, 1), (25, 2), (60, 3))
BROADCAST_ROWS = 500_000  # documents, lines or hashes of halves that are broadcast; more are joined by shuffling
_ODD, _TAG, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9  # odd multipliers
_INVERSE = pow(_ODD, -1, 1 << 64)
Edits = tuple[tuple[int, int], ...]
PLACE = ["no_id", "doc_id", "tid", "line"]  # the order of lines: null ids last


def _scrambled(x):
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of the multiplier, and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> "Powers":
        if n >= len(self.up):
            size = max(1024, 2 * n)
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self


class LineHash:
    """Hashes of a line's parts from prefix sums: sum of word hash times power of its place, modulo 2^64."""

    def __init__(self, words: list[bytes], hashes: WordHash, powers: Powers):
        self.n = n = len(words)
        self.powers = powers.upto(n)
        h = np.fromiter(map(hashes.of, words), np.uint64, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.powers.up[:n], out=self.sums[1:])

    def _part(self, i: int, j: int, tag: int) -> int:
        value = (int(self.sums[j]) - int(self.sums[i])) * int(self.powers.down[i])
        return (value + tag * _TAG) & 0xFFFFFFFFFFFFFFFF

    def whole(self) -> int:
        return int(_scrambled(np.array([self._part(0, self.n, 2 * self.n)], np.uint64)).view(np.int64)[0])

    def variants(self) -> np.ndarray:
        """Hash of the line without word i, for every i."""
        rest = (self.sums[-1] - self.sums[1:]) * np.uint64(_INVERSE)
        tag = np.uint64(2 * (self.n - 1) * _TAG & 0xFFFFFFFFFFFFFFFF)
        return _scrambled(self.sums[:-1] + rest + tag).view(np.int64)


def halves(lines: list[list[bytes]], hashes: WordHash, powers: Powers) -> np.ndarray:
    """For each line the hashes of its two halves, and of those it has as the longer partner of a line with a word less."""
    n = np.array([len(x) for x in lines])
    end = np.cumsum(n)
    start, total = end - n, int(end[-1])
    up, down = powers.upto(total).up, powers.down
    h = np.fromiter(map(hashes.of, chain.from_iterable(lines)), np.uint64, total)
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(h * up[:total], out=sums[1:])
    out = []
    for m in (n, n - 1):
        for a, b, side in ((start, start + m // 2, 0), (end - (m - m // 2), end, 1)):
            out.append((sums[b] - sums[a]) * down[a] + (2 * m + side).astype(np.uint64) * np.uint64(_TAG))
    return _scrambled(np.stack(out, axis=1)).view(np.int64)


def bound(n: int, edits: Edits = EDITS) -> int:
    """Edits within which a line of n words, the shorter of two, is near to the other."""
    return next((k for words, k in sorted(edits, reverse=True) if n >= words), 0)


def pieces(n: int, k: int) -> list[tuple[int, int]]:
    """Start and end of the k + 1 pieces of a line of n words."""
    ends = [n * i // (k + 1) for i in range(k + 2)]
    return list(zip(ends, ends[1:]))


def places(n: int, edits: Edits) -> np.ndarray:
    """(start, end, tag) of the pieces that a line of n words has as the shorter of two, and of those it may hold as the
    longer; the tag tells the shorter line's length and which piece it is."""
    out = set()
    for m in range(max(0, n - max(k for _, k in edits)), n + 1):
        k, more = bound(m, edits), n - m
        if k < 2 or more > k:
            continue
        for i, (a, b) in enumerate(pieces(m, k)):
            # the first piece whose edits before it are as many as the pieces before it: at most k - i follow
            for shift in range(max(-i, more - (k - i)), min(i, more + k - i) + 1):
                if a + shift >= 0 and b + shift <= n:
                    out.add((a + shift, b + shift, (m << 8) + i))
    return np.array(sorted(out), np.int64).reshape(-1, 3)


def piece_keys(words: list[bytes], edits: Edits, hashes: WordHash, powers: Powers, held: dict) -> tuple[list[int], list[bool]]:
    """Hashes of `places` in a line, and which of them are its own pieces."""
    n = len(words)
    if n not in held:
        at = places(n, edits)
        k = bound(n, edits)
        own = {(a, b, (n << 8) + i) for i, (a, b) in enumerate(pieces(n, k))} if k > 1 else set()
        told = at, np.array([tuple(x) in own for x in at.tolist()], bool)
        if len(held) >= 4096:
            held.clear()
        held[n] = told
    at, own = held[n]
    if not len(at):
        return [], []
    line = LineHash(words, hashes, powers)
    a, b = at[:, 0], at[:, 1]
    tag = (at[:, 2].astype(np.uint64) + np.uint64(1 << 48)) * np.uint64(_TAG)
    keys = _scrambled((line.sums[b] - line.sums[a]) * powers.down[a] + tag).view(np.int64)
    return keys.tolist(), own.tolist()


def near(a: list[bytes], b: list[bytes], k: int = 1) -> bool:
    """Whether at most k words inserted, deleted or replaced turn a into b."""
    if len(a) > len(b):
        a, b = b, a
    more = len(b) - len(a)
    if more > k:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if k == 1:
        return a[i + (not more):] == b[i + 1:]
    a, b = a[i:], b[i:]
    j = next((j for j, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(a))
    a, b = a[:len(a) - j], b[:len(b) - j]
    # a row holds the distances for the places of b from i - k to i + k
    row = [max(0, d - k) if d >= k else k + 1 for d in range(2 * k + 1)]
    for i in range(1, len(a) + 1):
        last, row = row, [k + 1] * (2 * k + 1)
        for d in range(2 * k + 1):
            j = i + d - k
            if 0 <= j <= len(b):
                best = last[d + 1] + 1 if d < 2 * k else k + 1
                if j:
                    best = min(best, last[d] + (a[i - 1] != b[j - 1]), row[d - 1] + 1 if d else k + 1)
                row[d] = best
        if min(row) > k:
            return False
    return row[len(b) - len(a) + k] <= k


def _lines(docs: DataFrame, near_words: int, edits: Edits) -> DataFrame:
    """Every line that has a word: place, digest, and the hashes of its halves and pieces if it is long enough."""
    out = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("line", pa.int32()), ("key", pa.binary()),
                     ("halves", pa.list_(pa.int64()))])
    many = max(k for _, k in edits) > 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes, powers = WordHash(), Powers()
        held = {}
        for batch in batches:
            for part in small_slices(batch, 2):
                of, line, key, long, words = [], [], [], [], []
                for d, text in enumerate(part.column(2).cast(pa.binary()).to_pylist()):
                    for k, whole in enumerate((text or b"").split(b"\n")):
                        w = whole.split()
                        if w:
                            if len(w) >= near_words:
                                long.append(len(of))
                                words.append(w)
                            of.append(d)
                            line.append(k)
                            key.append(xxhash.xxh3_128_digest(whole))
                if not of:
                    continue
                # the hashes of all long lines of the slice at once; other lines have a null
                told = halves(words, hashes, powers) if long else np.empty((0, 4), np.int64)
                sizes, absent = np.zeros(len(of), np.int32), np.ones(len(of), bool)
                absent[long] = False
                if many:
                    rows = [[*h, *piece_keys(w, edits, hashes, powers, held)[0]] for h, w in zip(told.tolist(), words)]
                    sizes[long] = [len(r) for r in rows]
                    values = pa.array(chain.from_iterable(rows), pa.int64())
                else:
                    sizes[long] = told.shape[1]
                    values = pa.array(told.ravel())
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                columns = [*(part.column(c).take(pa.array(of)) for c in (0, 1)), pa.array(line, pa.int32()), pa.array(key, pa.binary()),
                           pa.ListArray.from_arrays(ends, values, mask=pa.array(absent))]
                yield pa.RecordBatch.from_arrays(columns, schema=out)
        release()

    return (docs.select("doc_id", "tid", "text").mapInArrow(run, "doc_id bigint, tid bigint, line int, key binary, halves array<bigint>")
            .withColumn("no_id", F.col("doc_id").isNull()))


def _with_numbers(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that `wanted` (doc_id, tid, ...) names, one row each, with its other columns."""
    few = wanted.withColumnRenamed("doc_id", "_d").withColumnRenamed("tid", "_t")
    if wanted.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    return docs.join(few, docs["doc_id"].eqNullSafe(F.col("_d")) & (docs["tid"] == F.col("_t"))).drop("_d", "_t")


def _numbered(docs: DataFrame, first: DataFrame) -> DataFrame:
    """Text and number of the lines that share a half or piece with another line; numbers rise in the order of the lines.

    `first` holds each distinct line once, by a number `row`.
    """
    entries = first.filter("halves is not null").select("row", F.explode(F.array_distinct("halves")).alias("half"))
    shared = settle(entries.groupBy("half").agg(F.min("row").alias("low"), F.max("row").alias("high"))
                    .filter("low <> high").select("half"))
    rows = meet(entries, shared, ["half"], BROADCAST_ROWS).select("row").distinct()
    lines = first.join(rows, "row", "left_semi").select(*PLACE)
    by_doc = settle(lines.groupBy("doc_id", "tid").agg(F.sort_array(F.collect_list("line")).alias("lines")))
    split = F.split("text", "\n", -1)
    # bound by the outer lambda, the text is split once and not once a line
    held = F.transform(F.array(split), lambda s: F.transform(
        "lines", lambda i: F.struct(i.alias("line"), F.element_at(s, i + 1).alias("words"))))[0]
    texts = (_with_numbers(docs, by_doc).dropDuplicates(["doc_id", "tid"]).select("doc_id", "tid", F.explode(held).alias("l"))
             .select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid", "l.line", "l.words"))
    return settle(texts.repartitionByRange(shuffle_width(docs.sparkSession), *PLACE).sortWithinPartitions(*PLACE)
                  .withColumn("no", F.monotonically_increasing_id()))


def _near_pairs(lines: DataFrame) -> DataFrame:
    """(no, earlier): a line and the earliest line of each of its keys, not yet verified."""
    def make():
        hashes, powers = WordHash(), Powers()

        def row(no, text):
            told = LineHash(text.encode().split(), hashes, powers)
            return no, told.whole(), told.variants()

        return row

    hashed = rows_to_arrow(lines.select("no", "words"), "no bigint, whole bigint, variants array<bigint>", make)
    keys = settle(hashed.select("no", F.posexplode("variants").alias("at", "variant"))
                  .union(hashed.select("no", F.lit(-1), "whole")))
    cut, whole = keys.filter("at >= 0"), keys.filter("at < 0").drop("at")
    first = F.min("no").alias("earlier")
    # most keys are one line's alone: those that several lines share are few, and only they are met
    same = settle(cut.groupBy("variant", "at").agg(first, F.max("no").alias("last")).filter("earlier < last").drop("last"))
    replaced = meet(cut, same, ["variant", "at"], BROADCAST_ROWS).select("no", "earlier")
    words = settle(whole.groupBy("variant").agg(first))
    spaced = meet(whole, words, ["variant"], BROADCAST_ROWS).select("no", "earlier")
    met = settle(meet(cut, words, ["variant"], BROADCAST_ROWS).select("no", "earlier"))  # a line, and one with a word less
    shorter = met.groupBy("earlier").agg(F.min("no").alias("no")).select(F.col("earlier").alias("no"), F.col("no").alias("earlier"))
    return replaced.union(spaced).union(met).union(shorter).filter("earlier < no").distinct()


def _piece_pairs(lines: DataFrame, edits: Edits) -> DataFrame:
    """(no, earlier): lines of which the longer holds a piece of the shorter where the bound allows, not yet verified."""
    def make():
        hashes, powers = WordHash(), Powers()
        held = {}

        def row(no, text):
            return no, *piece_keys(text.encode().split(), edits, hashes, powers, held)

        return row

    told = rows_to_arrow(lines.select("no", "words"), "no bigint, keys array<bigint>, own array<boolean>", make)
    keys = settle(told.select("no", F.explode(F.arrays_zip("keys", "own")).alias("p")).select("no", "p.keys", "p.own").distinct())
    shared = settle(keys.groupBy("keys").agg(F.min("no").alias("low"), F.max("no").alias("high"), F.count("*").alias("n"))
                    .filter("low <> high").select("keys", shards_for("n", 1000).alias("shards")))
    met = settle(meet(keys, shared, ["keys"], BROADCAST_ROWS))
    part = F.pmod(F.xxhash64("no"), F.col("shards")).cast("int")
    held = met.select("keys", F.col("no").alias("long"), part.alias("_part"))
    own = met.filter("own").select("keys", F.col("no").alias("short"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("_part"))
    return (held.join(own, ["keys", "_part"]).filter("long <> short")
            .select(F.greatest("long", "short").alias("no"), F.least("long", "short").alias("earlier")).distinct())


def _verified(pairs: DataFrame, lines: DataFrame, edits: Edits) -> DataFrame:
    """Numbers of the lines that are within the edit bound of an earlier one."""
    pairs = settle(pairs)
    times = pairs.groupBy("earlier").agg(shards_for(F.count("*"), 1000).alias("shards"))
    early = lines.select(F.col("no").alias("earlier"), F.col("words").alias("other")).join(times, "earlier")
    both = shard_join(pairs.join(times, "earlier"), early, ["earlier"], F.col("no"), "shards").join(lines.select("no", "words"), "no")

    def row(no, text, other):
        a, b = text.encode().split(), other.encode().split()
        return no, near(a, b, bound(min(len(a), len(b)), edits))

    told = rows_to_arrow(both.select("no", "words", "other"), "no bigint, near boolean", lambda: row)
    return told.filter("near").select("no").distinct()


def dropped_lines(docs: DataFrame, near_words: int = NEAR_WORDS, edits: Edits = EDITS) -> DataFrame:
    """(doc_id, tid, lines, n_exact, n_near) of documents that lose lines; `docs` has doc_id, tid and text."""
    lines = settle(_lines(docs, near_words, edits))
    place = F.struct(*PLACE)
    # rows that repeat a document's id and text are one document
    first = settle(lines.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"))
                   .select("key", "first", "n", "halves", F.monotonically_increasing_id().alias("row")))
    again = meet(lines.drop("halves"), first.filter("n > 1").select("key", "first"), ["key"], BROADCAST_ROWS).filter(place != F.col("first"))
    numbered = _numbered(docs, first.select("first.*", "halves", "row"))
    pairs = _near_pairs(numbered)
    if max(k for _, k in edits) > 1:
        pairs = pairs.union(_piece_pairs(numbered, edits)).distinct()
    gone = _verified(pairs, numbered, edits).join(numbered.drop("words"), "no")
    told = (again.select("doc_id", "tid", "line", F.lit(0).alias("near"))
            .union(gone.select("doc_id", "tid", "line", F.lit(1))).distinct())
    return settle(told.groupBy("doc_id", "tid").agg(F.sort_array(F.collect_list("line")).alias("lines"),
                                                    F.sum(1 - F.col("near")).alias("n_exact"), F.sum("near").alias("n_near")))


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS, text: str = "text", key: str = "doc_id",
                edits: Edits = EDITS) -> DataFrame:
    """`docs` with each line kept only where it, or a line near to it, comes first; adds n_lines, n_exact and n_near.

    Lines are parted by \\n and ordered by key (null last), then by a hash of the text, then by line number. A line goes when
    an equal line comes before it, in the same document or an earlier one, or, if it has `near_words` words or more, when a
    line near to it does: `edits` tells by the words of the shorter of two lines within how many inserted, deleted or
    replaced words they are near (EDITS one at any length, EDITS_BY_LENGTH more for longer lines; bounds must not fall with
    the length). That the earlier line itself may be dropped doesn't matter. Lines without a word always
    stay. Null text stays null. Rows that repeat both key and text are one document and get the same result. Columns named
    like an added one are replaced; an empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("_doc"), F.col(key).cast("bigint").alias("doc_id"),
                       F.col(text).cast("string").alias("text")).withColumn("tid", F.xxhash64("text"))
    plan = dropped_lines(rows.drop("_doc"), near_words, edits)
    few = plan.withColumnRenamed("doc_id", "_d").withColumnRenamed("tid", "_t")
    if plan.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    told = rows.join(few, rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["tid"] == F.col("_t")), "left")
    # bound by the outer lambda, a text is split once and only where lines go; line feeds tell the number of lines
    split = F.split("text", "\n", -1)
    clean = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.transform(F.array(split), lambda s: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(s) - 1), F.col("lines")), lambda i: F.element_at(s, i + 1)), "\n"))[0])
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    added = [F.coalesce(feeds + 1, F.lit(0)).cast("bigint").alias("n_lines"),
             F.coalesce("n_exact", F.lit(0)).cast("bigint").alias("n_exact"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near")]
    named = [c for c in docs.columns if c not in ("n_lines", "n_exact", "n_near")]
    return told.select(*[clean.alias(text) if c == text else F.col("_doc")[c].alias(c) for c in named], *added)
