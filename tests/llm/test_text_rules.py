"""Quality rules and language identification."""

import os
import random
import re

import numpy as np
import pytest

from creditmill.llm import language_id, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def test_base_counts():
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "é", "中", " ", "  ", "\n", "\t", "\x0b", " ", "\x1c", "#", "|", "a b c "])
                       for _ in range(rng.randint(0, 60)))
        assert quality.base_counts(text) == brute_counts(text), repr(text)


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "is", "qu", "o"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_bands(documents):
    rng = random.Random(9)
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60_000))
    blocks = " ".join(noise[i:i + 70] for i in range(0, 60_000, 70))
    # every window is new, but whole stretches differ in one word only
    template = [f"w{k}" for k in range(40)]
    repeated = " ".join(" ".join(w if k % 3 else f"{w}x{r}" for k, w in enumerate(template)) for r in range(300))
    mixed = prose(rng, 3000) + " " + blocks
    rows = [(1, prose(rng, 400)), (2, blocks), (3, repeated), (4, mixed), (5, None), (6, ""), (7, "few words"), (8, "a b c " * 40),
            (None, prose(rng, 400)), (9, prose(rng, 60_000))]
    got = {r.doc_id: r for r in quality.quality(documents(rows)).collect()}
    assert {i: r.reason for i, r in got.items()} == {
        1: "ok", 2: "incompressible", 3: "repetitive", 4: "chunks_incompressible", 5: "base", 6: "base", 7: "base", 8: "base",
        None: "ok", 9: "ok"} or got[4].reason == "incompressible"
    assert all(r.kept == (r.reason == "ok") and r.base_failed == (r.reason == "base") for r in got.values())
    assert quality.quality(documents([])).collect() == []


def brute_grams(text):
    text = "".join(c if c.isalpha() else " " for c in text.lower())
    counts = {}
    joined = " " + "".join(w + " " for w in text.split(" ") if w)
    for n in (1, 2, 3):
        for i in range(len(joined) - n + 1):
            gram = joined[i:i + n]
            if gram != " " and " " not in gram[1:-1]:  # none across words
                counts[gram] = counts.get(gram, 0) + 1
    return counts


def as_text(code):
    code, out = int(code), ""
    while code:
        out, code = chr(code & 0x1FFFFF) + out, code >> 21
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 19])
def test_gram_counts(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    letters = language_id.letter_table()
    rng = random.Random(piece)
    for _ in range(150):
        text = "".join(rng.choice(["a", "B", "c", " ", "  ", "1", "ß", "中", ".", "\n"]) for _ in range(rng.randint(0, 30)))
        codes, counts = language_id.gram_counts(text, letters)
        assert {as_text(c): n for c, n in zip(codes, counts)} == brute_grams(text), repr(text)


def test_out_of_place_distance():
    rng, letters = random.Random(0), language_id.letter_table()
    texts = {"x": prose(rng, 50), "y": "lorem ipsum dolor sit amet " * 5}
    profiles = {k: language_id.profile(*language_id.gram_counts(t, letters), 40) for k, t in texts.items()}
    ranker = language_id.Ranker(profiles, 40)

    def ranked(text):
        return sorted(brute_grams(text).items(), key=lambda g: (-g[1], [ord(c) for c in g[0].rjust(3, "\0")]))[:40]

    for text in ("there is one", "ipsum", "zzz qqq", prose(rng, 30)):
        far = {}
        for name, known in texts.items():
            places = {g: i for i, (g, _) in enumerate(ranked(known))}
            far[name] = sum(abs(i - places[g]) if g in places else 40 for i, (g, _) in enumerate(ranked(text)))
        best = min(sorted(far), key=far.get)
        name, score = ranker.predict(text)
        assert name == best and score == pytest.approx(1 - far[best] / (40 * len(ranked(text))))


def test_language_rows(documents):
    rows = [(i, "the cat and the dog of it " * 3, "en", "s") for i in range(0, 40)]
    rows += [(i, "der hund und die katze von ihm " * 3, "de", "s") for i in range(40, 80)]
    rows += [(90, None, "en", "s"), (91, "", "en", "s"), (92, "12 34 !?", "de", "s"), (93, "and the dog", None, None), (None, "und die", None, None),
             (94, "中文", "de", "s"), (0, "und die katze", None, None)]
    got = [tuple(r) for r in language_id.language_id(documents(rows)).collect()]
    import zlib
    assert sorted((r[0] or -1, r[1]) for r in got) == sorted((i or -1, i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    told = {(r[0], r[2]) for r in got}
    assert {(i, "en") for i in range(40)} | {(i, "de") for i in range(40, 80)} <= told
    assert {(90, "und"), (91, "und"), (92, "und"), (93, "en"), (None, "de"), (0, "de")} <= told
    assert all(0 <= r[3] <= 1 for r in got)
    assert language_id.language_id(documents([])).collect() == []
    assert {r.lang_pred for r in language_id.language_id(documents([(1, "no labels here")])).collect()} == {"und"}


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    told = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(told) > 30 and np.mean([r.lang == r.lang_pred for r in told]) >= 0.95
    # the labels of held-out rows play no part
    other = docs.selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(cast(cast(doc_id AS string) AS binary)), 3) = 1 THEN 'zz' ELSE lang END lang")
    again = {r.doc_id: r.lang_pred for r in language_id.language_id(other).collect()}
    assert all(again[r.doc_id] == r.lang_pred for r in told)
