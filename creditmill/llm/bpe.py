"""Byte-pair encoding by dynamic programming over prefixes.

Merging pairs in rank order has one result for each prefix of a word, so the last token of every prefix is unique. A
token that ends at a prefix's end is that last token exactly when it is compatible with the last token of what lies
before it: encoding the two together must not merge anything across their border. An automaton over the vocabulary
lists, for each position, the tokens that end there; the compatible one is stored, and following the stored tokens back
from the end gives the ids. No merge loop runs over the text.

Files are those of the `tokenizers` library (word-level BPE with an end-of-word suffix, byte alphabet).
"""

import hashlib
import json
import re
import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import per_worker, rows_to_arrow

WORDS_HELD = 600_000  # encoded words, and as many chunks, that an encoder remembers (up to some 150 MB each)
TASK_WORDS_HELD = 150_000  # where they are let go with the task
PAIRS_HELD = 400_000  # tested token pairs that it remembers (some 40 MB)
END = 0x400  # added to the character of a word's last byte
INF = 1 << 60
# Text of these characters is normalised, split and lower-cased by Python as the library does it; all other text goes
# through the library's own normaliser and splitter. Separators 0x1c-0x1f are white space only to Python.
PLAIN = re.compile("[\x00-\x1b\x20-\x7f\u00a1-\u00ff\u2010-\u2027]*")
_LETTER, _NUMBER = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PLAIN_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
SPACE = re.compile("[\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(0x100 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens as strings over single characters: a byte's character, shifted by END for the last of a word."""

    def __init__(self, path: str):
        from ahocorasick import Automaton

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (ids | self.special).items()}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, token
        self.parts: dict[int, tuple[int, int]] = {}
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, both = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = rank, both
            if both not in self.parts:
                self.parts[both], made[both] = (a, b), rank
        self.rank = made
        self.bytes_of = byte_alphabet()
        self.spines: dict[int, tuple[list, list]] = {}
        self.fits: dict[int, bool] = {}
        self.length: dict[int, int] = {}
        self.automaton = Automaton()
        for name, token in ids.items():
            atoms = self._atoms(name)
            if len(atoms) == 1 or token in self.parts:  # others can't come out of merges
                self.automaton.add_word(atoms, (token, len(atoms)))
                self.length[token] = len(atoms)
        self.automaton.make_automaton()

    def _atoms(self, name: str) -> str:
        if self.suffix and name.endswith(self.suffix) and len(name) > len(self.suffix):
            return self.ended(name[:-len(self.suffix)])
        return name

    def ended(self, word: str) -> str:
        return word[:-1] + chr(ord(word[-1]) + END) if self.suffix else word

    def spine(self, token: int) -> tuple[list, list]:
        """Pieces at the token's right and at its left edge, smallest first, each with the rank that merges it away."""
        found = self.spines.get(token)
        if found is None:
            edges = []
            for side in (1, 0):
                piece, until, pieces = token, INF, []
                while True:
                    pieces.append((piece, until))
                    if piece not in self.parts:
                        break
                    piece, until = self.parts[piece][side], self.rank[piece]
                edges.append(pieces[::-1])
            found = self.spines[token] = edges[0], edges[1]
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are what merging their joint text gives; remembered by pair."""
        if len(self.fits) >= PAIRS_HELD:
            self.fits.clear()
        known = self.fits[left << 32 | right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Replays the merges at both sides of the border in rank order: it is crossed when the two pieces that face
        each other would merge before either is merged away. Of equal ranks the merge further left goes first."""
        a, b = self.spine(left)[0], self.spine(right)[1]
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            rank = self.merged.get((x, y), (INF, 0))[0]
            if rank < x_until and rank <= y_until and rank < INF:
                return False
            if x_until == y_until == INF:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def encode_word(self, atoms: str) -> list[int]:
        """Ids of one word, by its prefixes."""
        n = len(atoms)
        last = [-1] * (n + 1)  # -1: no encoding ends here
        fits, done = self.fits.get, 0
        for end, (token, length) in self.automaton.iter(atoms):
            end += 1
            if end == done:
                continue
            if end > length:
                before = last[end - length]
                if before < 0:
                    continue
                fit = fits(before << 32 | token)
                if fit is None:
                    fit = self.compatible(before, token)
                if not fit:
                    continue
            last[end] = token
            done = end
        out = []
        while n:
            token = last[n]
            out.append(token)
            n -= self.length[token]
        out.reverse()
        return out


class Encoder:
    """Whole texts to ids and back, word by word; words seen before are looked up."""

    def __init__(self, path: str, by_library: bool = False, most_held: int = WORDS_HELD):
        """`by_library`: the library's own model encodes each new word, in place of the dynamic program."""
        from tokenizers import Tokenizer

        self.vocabulary, self.most_held = Vocabulary(path), most_held
        library = Tokenizer.from_file(path)
        self.model = library.model if by_library else None
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        alphabet = self.vocabulary.bytes_of
        self.to_alphabet = {b: alphabet[b] for b in range(256)}
        self.held: dict[str, bytes] = {}  # chunks
        self.words: dict[str, tuple[int, ...]] = {}
        specials = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.names = {i: t.encode() for i, t in self.vocabulary.names.items()}

    def forget(self) -> None:
        """Let go of what was remembered; the tables of the vocabulary stay."""
        self.held, self.words = {}, {}
        self.vocabulary.fits.clear()

    def _word(self, piece: str, shown: str) -> tuple[int, ...]:
        if len(self.words) >= self.most_held:
            self.words.clear()
        if self.model:
            ids = tuple([t.id for t in self.model.tokenize(shown)])
        else:
            ids = tuple(self.vocabulary.encode_word(self.vocabulary.ended(shown)))
        self.words[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk without white space or special tokens."""
        ids: list[int] = []
        if PLAIN.fullmatch(chunk):
            for piece in PLAIN_WORD.findall(chunk.lower()):
                ids += self.words.get(piece) or self._word(piece, piece if piece.isascii() and piece.isprintable() else
                                                           piece.encode().decode("latin-1").translate(self.to_alphabet))
        else:
            for shown, _ in self.split(self.normalise(chunk)):
                ids += self._word("\n" + shown, shown)  # a plain word holds no line end
        return ids

    def _packed(self, chunk: str) -> bytes:
        ids: list[int] = []
        for k, part in enumerate(self.special.split(chunk) if self.special and "<" in chunk else [chunk]):
            ids += [self.vocabulary.special[part]] if k % 2 else self._chunk(part) if part else []
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.held) >= self.most_held:
            self.held.clear()
        self.held[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. White space always parts words, so chunks are independent."""
        held = self.held.get
        return b"".join([held(c) or self._packed(c) for c in chunks_of(text)])

    def decode(self, ids: bytes) -> bytes:
        """Text in UTF-8: the tokens, parted by one space (the file names no decoder)."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def chunks_of(text: str) -> list[str]:
    """The text cut at white space (as Unicode has it; the separators 0x1c-0x1f, which str.split takes, are none)."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") or PLAIN.fullmatch(text):
        return text.split()
    return [c for c in SPACE.split(text) if c]


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, from its whole text, encoded and decoded again.

    `with_ids` adds the ids themselves as an array. Null and empty text have no ids and decode to empty text. A text is
    worked on by itself in the task that reads it, so rows that repeat a key, ties, empty tables and extra columns (which are
    not read) need no rule. `tokenizer` is the file's path on every executor.
    """
    def make() -> Callable[..., tuple]:
        encoder = per_worker(("bpe", tokenizer), lambda: Encoder(tokenizer, most_held=TASK_WORDS_HELD))

        def row(doc_id, value):
            ids = encoder.encode(value or "")
            told = (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest())
            return (*told, np.frombuffer(ids, "<i4")) if with_ids else told

        row.close = encoder.forget
        return row

    return rows_to_arrow(docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")),
                         "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids,
                         make)
