"""Spelling variants, the Merkle manifest and the BPE round trip against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import bpe, merkle, spelling
from panelspark.llm.queries import MANIFEST, QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, n int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and long texts, ties, repeated rows and columns that clash with results."""
    long = " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(20_000)) + "z" * 70_000
    rows = [
        (1, None, None, None, None, None, None),
        (2, "", "en", "a", 0, "x", 1),
        (None, "No identity here here here, but text.", "en", None, 3, "x", 1),
        (None, "No identity here here here, but text.", "en", None, 3, "x", 1),
        (3, long, "en", "a", len(long), "x", 1),
        (3, long, "en", "a", len(long), "x", 1),
        (3, long + "!", "en", "a", len(long), "x", 1),
        (4, "ÀÉÎ÷×ß straße STRASSE 日本 <|endoftext|> ünïted", "fr", "é", -1, "x", 1),
        (5, "<|endoftext|>\n\n  \t<|endoftext|>", "de", "Z", 1, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 11 -------------------------------------------------------------------------------


def brute_words(rows):
    import re

    counts = Counter()
    for key, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    found = []
    forms = {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(around) if around else (0, None)
        form = best[1] if around and -best[0] >= 2 * n else None
        forms[w] = form
        found.append([w, form, None, n, len(around), -best[0] if form else None])
    for row in found:
        at = row[0]
        while forms[at]:
            at = forms[at]
        row[2] = at
    return sorted(map(tuple, found), key=str)


def result(df):
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 64])
def test_variants_equal_brute_force(spark, filter_bytes):
    """64 bytes make many passes, with lengths cut into several shards."""
    rng = random.Random(11)
    words = {}
    for _ in range(60):
        base = "".join(rng.choices("abcé÷z", k=rng.randint(5, 9)))
        words[base] = rng.choice([3, 8, 50, 400])
        for _ in range(4):
            at = rng.randrange(len(base))
            base = rng.choice([base[:at] + base[at + 1 :], base[:at] + rng.choice("abz") + base[at:],
                               base[:at] + rng.choice("abz") + base[at + 1 :]])
            if len(base) >= 5:
                words[base] = rng.choice([3, 4, 9, 30, 60, 400])
    long = "q" * 70
    words |= {long: 9, long + "q": 20, long + "qr": 90, "r" + long + "qr": 90, "s" * 3000: 4,
              "s" * 2999: 8, "s" * 1500 + "t" + "s" * 1500: 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.group_variants(df, filter_bytes=filter_bytes)) == brute_variants(words)


def test_vocabulary_of_odd_rows(spark, odd, none):
    words = spelling.vocabulary(odd)
    want = brute_words([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert {r["word"]: r["n"] for r in words.collect()} == want
    assert result(spelling.group_variants(words)) == brute_variants(want)
    assert spelling.group_variants(spelling.vocabulary(none)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    words = brute_words([tuple(r) for r in docs])
    got = {r["word"]: r for r in QUERIES["op11_spelling_variants"](spark, SMALL).collect()}
    assert {w: r["n"] for w, r in got.items()} == words
    for w in random.Random(2).sample(sorted(words), 40):
        around = [v for v in words if near(w, v)]
        assert got[w]["n_near"] == len(around)


def test_edits_are_whole_and_come_once():
    letters = np.array([ord(c) for c in "abé"], np.uint64)
    for word in ["aabba", "bbbbb", "abéab", "aaaaaa"]:
        points = spelling.code_points([word], len(word))
        found = [h for _, hs, _ in spelling.edits(points, letters) for h in hs.tolist()]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abé" if c > word[i]}
        hashed = [int(spelling.hashes(spelling.code_points([w], len(w)))[0]) for w in want]
        assert sorted(found) == sorted(hashed)


def test_only_positives_are_shuffled(spark):
    """Filters let through next to nothing of words without neighbours."""
    rng = random.Random(4)
    words = {"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)): 5 for _ in range(3000)}
    df = spelling.stage(spark.createDataFrame(list(words.items()), "word string, n long"))
    shards = spelling.Shards({12: len(words)})
    keyed = spelling.stage(spelling._with_key(df))
    filters = spelling._filters(keyed, shards, 0, "length(word)", {12})
    letters = spelling._letters(df)
    passed = spelling._probe(keyed, shards, 0, filters, letters).count()
    assert passed < 0.03 * len(words) * 12 * 13


# ---- 12 -------------------------------------------------------------------------------


def brute_manifest(rows):
    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            one = levels[-1]
            levels.append([sha("".join(one[i : i + 16])) for i in range(0, len(one), 16)])
        return levels

    def path(levels, i):
        return [(i // 16**m % 16, levels[m][i // 16 ** (m + 1) * 16 : i // 16 ** (m + 1) * 16 + 16])
                for m in range(len(levels) - 1)]

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf([r[c] for c in MANIFEST]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    found = []
    for s, g in enumerate(names):
        for i, (key, digest, r) in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, s)
            proof = "".join("".join(run[:p] + run[p + 1 :]) for p, run in steps)
            copy = digest
            if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 and r["text"] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                copy = leaf([r["doc_id"], r["source"], r["lang"], r["n_chars"], low])
            for p, run in steps:
                copy = sha("".join([*run[:p], copy, *run[p + 1 :]]))
            found.append((key, digest, trees[g][-1][0], top[-1][0], sha(proof), copy,
                          copy == top[-1][0]))
    return sorted(found, key=str)


def audited(df):
    lowered = (
        "CASE WHEN coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false) THEN"
        " translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    )
    proved = merkle.audit(df, MANIFEST, "source", "doc_id", {"text": lowered})
    siblings = "array_join(transform(proof, p -> lower(hex(p.siblings))), '')"
    shown = proved.selectExpr("doc_id", "leaf", "subroot", "root", f"sha2({siblings}, 256) AS p",
                              "folded_root", "verified")
    return sorted((tuple(r) for r in shown.collect()), key=str)


def test_manifest_of_odd_rows(odd, none):
    assert audited(odd) == brute_manifest(odd.collect())
    assert audited(none) == []


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_in_many_rounds(spark, monkeypatch, levels):
    """Small blocks make several rounds of builders, with ragged blocks and many groups."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rng = random.Random(levels)
    sizes = [1, 2, 15, 16, 17, 255, 256, 257, 600] + [1] * 40
    rows = [(rng.choice([i, i, 7]), f"Text {i} {g}", "en", None if g == 3 else f"s{g}", i)
            for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert audited(df) == brute_manifest(df.collect())


def test_positions_are_those_of_the_append_log():
    for leaves in [1, 2, 15, 16, 17, 33, 256, 257, 272, 300, 1000, 4096]:
        digests = [hashlib.sha256(str(i).encode()).digest() for i in range(leaves)]
        levels = merkle.height(leaves)
        log = merkle.append_log(digests, levels)
        row, seen = digests, []
        for level in range(levels + 1):
            at = merkle.positions(level, leaves, levels)
            assert [log[32 * p : 32 * p + 32] for p in at.tolist()] == row
            seen += at.tolist()
            row = [hashlib.sha256("".join(x.hex() for x in row[i : i + 16]).encode()).digest()
                   for i in range(0, len(row), 16)]
        assert sorted(seen) == list(range(len(log) // 32))


# ---- 13 -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found.no_truncation()
    found.no_padding()
    return found


ATOMS = ["the", "a", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "é", "ß", "中文字", "123", "!",
         "<|endoftext|>", "<|endof", "...", "—", "\x1c", "\x85", " ", "᠎", "​",
         "　", "🙂", "Hello", "\r\n", " \n ", "́", "﻿", "٣", "\xa0"]


def test_units_and_joins_equal_the_library(library, monkeypatch):
    tokenizer = bpe.ByteTokenizer(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(rng.choices(ATOMS, k=rng.randint(0, 40)))
        ids, _ = tokenizer.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert tokenizer.decode(ids) == text
    monkeypatch.setattr(bpe, "LEAF", 16)
    for _ in range(400):
        kind = rng.choice(["ab", "abcdefgh", "the", "中文字é", "=-", "0123456789", " ", "e"])
        text = "".join(rng.choices(kind, k=rng.randint(20, 400)))
        if rng.random() < 0.3:
            text += rng.choice(ATOMS) + text
        want = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.long_unit(text).tolist() == want


@pytest.mark.parametrize("part", [100, 333, bpe.PART])
def test_long_texts_are_encoded_whole(spark, library, odd, none, part):
    rng = random.Random(1)
    texts = ["a" * 3000, "ab " * 900 + "x" * 2000 + "<|endoftext|>" + "9" * 700 + "!?" * 500,
             "中文" * 800 + " " * 900 + "q", "<|endoftext|>" * 300, "'s" * 400, "e" * 100,
             "".join(rng.choices("thein", k=4000)), "".join(rng.choices(ATOMS, k=2000))]
    rows = list(enumerate(texts)) + [tuple(r) for r in odd.select("doc_id", "text").collect()]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "doc_id long, text string, ids int, DECODED string")
    path = tokenizer_path("byte_bpe_50k.json")
    got = [tuple(r) for r in bpe.encode(df, path, part=part).collect()]
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encode(none, path, part=part).count() == 0


def test_other_tokenizers_are_refused(spark, odd):
    with pytest.raises(ValueError, match="byte-level"):
        bpe.encode(odd, tokenizer_path("word_bpe_49k.json"))


def test_round_trip_query(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[key] = (len(ids), sha(",".join(map(str, ids))), sha(decoded))
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_bpe_round_trip"](spark, SMALL).collect()}
    assert got == want
