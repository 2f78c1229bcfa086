"""Resampling, infill and repeated passages against plain models and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listinglake.llm import infill, repeats, resampling
from listinglake.llm.words import chunks


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- importance resampling --------------------------------------------------------------------


def plain_features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain_resampling(rows, targets):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % 10000

    kept = [plain_features(text) for _, text in rows]
    s = Counter(bucket(f) for _, found in kept for f in found)
    t = Counter(bucket(f) for text in targets for f in plain_features(text)[1])
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    scored = []
    for (doc_id, _), (words, found) in zip(rows, kept, strict=True):
        total = 0
        for f in found:
            b = bucket(f)
            total += math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
        weight = total // len(found) if found else 0
        key = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        noise = math.floor(-1000 * math.log(-math.log((int(key[:8], 16) + 0.5) / 4294967296)))
        scored.append([doc_id, len(found), weight, weight + noise, len(words)])
    able = [x for x in scored if x[4] >= 20]
    able.sort(key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1]))
    drawn = 25 * len(able) // 100
    ranked = [(*x[:4], k + 1 if k < drawn else None) for k, x in enumerate(able)]
    return sorted(ranked + [(*x[:4], None) for x in scored if x[4] < 20], key=repr)


def test_resampling_equals_a_plain_model(spark, documents, odd):
    random.seed(3)
    words = ["River", "stone", "çedille", "ß", "x" * 70, "Y" * 65 + "é", "a", "7", "don't", "日本"]
    texts = [" ".join(random.choices(words, k=random.randrange(1, 90))) for _ in range(120)]
    rows = [*odd, *((100 + k, text) for k, text in enumerate(texts)), (100, texts[0])]
    targets = ["stone river stone", None, "日本 a 7 " * 40, ""]
    benchmark = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id int, text string")
    found = resampling.resample(documents(rows, extra=True), benchmark)
    assert rows_of(found.drop("n_words")) == plain_resampling(rows, targets)


def test_resampling_of_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert resampling.resample(documents([]), none).count() == 0
    rows = [(k, "one two three " * 10) for k in range(8)]
    found = resampling.resample(documents(rows), none)
    assert rows_of(found.drop("n_words")) == plain_resampling(rows, [])


def test_bit_planes_sum_exactly():
    random.seed(5)
    gains = np.array([random.randrange(-20000, 20000) for _ in range(997)] + [0, -1, 1], dtype=np.int64)
    row = np.array(sorted(random.randrange(600) for _ in range(9000)), dtype=np.int64)
    bucket = np.array([min(random.randrange(1000), random.randrange(1000)) for _ in row], dtype=np.int64)
    bucket[row == 7] = 3
    wanted = np.zeros(600, dtype=np.int64)
    np.add.at(wanted, row, gains[bucket])
    assert (resampling.gain_sums(row, bucket, 600, *resampling.gain_planes(gains), 1000) == wanted).all()


def test_words_that_touch_a_row_end():
    texts = pa.array(["ab", "cd e", "", None, "é", " f"])
    (chunk,) = chunks(texts)
    row, bucket, words = resampling.features(chunk)
    assert words.tolist() == [1, 2, 0, 0, 1, 1]
    wanted = [(0, "ab"), (1, "cd"), (1, "e"), (1, "cd e"), (4, "é"), (5, "f")]
    assert sorted(zip(row.tolist(), bucket.tolist(), strict=True)) == sorted(
        (k, zlib.crc32(f.encode()) % 10000) for k, f in wanted
    )


# --- fill-in-middle ---------------------------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    key = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    if not text or h[2] % 100 >= 50 or re.search("<[PSM]>", text):
        return (doc_id, n, "plain", None, None, text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_equals_a_plain_model_and_comes_back(documents, odd):
    random.seed(4)
    parts = ["a", " ", "\n", "é", "日", " ", " ", "<", "P", ">", "<S", "😀", "\x1c", "\t"]
    texts = ["".join(random.choices(parts, k=random.randrange(60))) for _ in range(300)]
    rows = [*odd, *((50 + k, t) for k, t in enumerate([*texts, "x <M> y", "<P>", "<P<P><S"]))]
    made = infill.fill_in_middle(documents(rows, extra=True))
    assert rows_of(made) == sorted((plain_infill(*row) for row in rows), key=repr)
    assert {row.form for row in made.collect()} == {"plain", "psm", "spm"}
    back = made.select("doc_id", infill.restored(F.col("form"), F.col("output")).alias("text"))
    assert rows_of(back) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_long_texts_are_matched_in_stretches():
    random.seed(6)
    for _ in range(200):
        text = "".join(random.choices("ab \n\t", k=random.randrange(80)))
        ends = [found.end() for found in TOKEN.finditer(text)]
        for together in (1, 3, 10, 1000):
            assert infill.token_ends(text, together).tolist() == ends
    assert len(infill.token_ends("ab " * 3_000_000)) == 3_000_001


def test_marks_that_overlap_are_refused(documents):
    with pytest.raises(ValueError):
        infill.fill_in_middle(documents([(1, "a b")]), marks=("<a", "a<", "b"))


def test_infill_of_an_empty_table(documents):
    assert infill.fill_in_middle(documents([])).count() == 0


# --- repeated passages ------------------------------------------------------------------------


def plain_repeats(rows):
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), words_ in zip(rows, split, strict=True):
        for k in range(len(words_) - 49):
            key = tuple(words_[k : k + 50])
            if doc_id is not None and doc_id < first.get(key, doc_id + 1):
                first[key] = doc_id
    found = []
    for (doc_id, _), words_ in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(words_) - 49):
            if doc_id is not None and first[tuple(words_[k : k + 50])] < doc_id:
                gone.update(range(k, k + 50))
        kept = [word for k, word in enumerate(words_) if k not in gone]
        found.append((doc_id, len(words_), len(gone), " ".join(kept)))
    return sorted(found, key=repr)


def found_repeats(frame):
    return rows_of(repeats.remove_repeats(frame).drop("spans"))


def test_repeats_equal_a_plain_model(documents, odd):
    random.seed(9)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "W3", "w3."]
    passages = [random.choices(vocabulary, k=random.randrange(45, 160)) for _ in range(6)]
    passages.append(["tick", "tock"] * 60)

    def text():
        words_ = []
        for _ in range(random.randrange(1, 9)):
            passage = random.choice(passages)
            low = random.randrange(len(passage) // 2)
            words_ += passage[low : low + random.randrange(20, 120)]
            if random.random() < 0.6:
                words_ += random.choices(vocabulary, k=random.randrange(6))
        return random.choice([" ", "\n ", "\t"]).join(words_)

    rows = [(random.randrange(60), text()) for _ in range(80)]
    rows += [(None, rows[0][1]), (70, rows[1][1]), (70, rows[1][1]), (71, rows[1][1].upper())]
    rows += [*odd, (80, "word " * 700), (0, "word " * 51), (81, "tick tock " * 900)]
    random.shuffle(rows)
    wanted = plain_repeats(rows)
    assert sum(row[2] > 0 for row in wanted) > 50
    assert found_repeats(documents(rows, extra=True)) == wanted


def test_repeats_that_the_first_holder_lacks(documents):
    """Documents share the seed of a window with a first one, but the window with each other only."""
    random.seed(10)
    seed = [f"s{k}" for k in range(40)]

    def fresh(n):
        return [f"x{random.randrange(10**9)}" for _ in range(n)]

    left, right = fresh(30), fresh(30)
    rows = [
        (1, fresh(30) + seed + fresh(30)),
        (2, left + seed + fresh(30)),
        (3, fresh(9) + left + seed + fresh(5)),
        (4, fresh(700) + seed + right + fresh(3)),
        (5, seed + right),
        (6, fresh(10) + left + seed + right),
    ]
    rows = [(k, " ".join(words_)) for k, words_ in rows]
    found = found_repeats(documents(rows))
    assert found == plain_repeats(rows)
    assert [row[2] for row in found] == [0, 0, 70, 0, 70, 100]


def test_a_long_text_in_blocks(documents):
    random.seed(11)
    whole = [f"v{random.randrange(3000)}" for _ in range(5000)]
    cut = whole[:]
    for at in (511, 512, 513, 1023, 2000, 2049, 2098, 4999):
        cut[at] = "changed"
    rows = [(1, " ".join(whole)), (2, " ".join(cut)), (3, " ".join(whole[1000:] + whole[:1000]))]
    assert found_repeats(documents(rows)) == plain_repeats(rows)


def test_repeats_with_lookups_beyond_the_broadcast_limit(documents, monkeypatch):
    """Every join shuffles and salts hot keys."""
    monkeypatch.setattr(repeats, "SMALL", 0)
    monkeypatch.setattr(repeats, "_HOT", 20)
    random.seed(12)
    passage = [f"p{k}" for k in range(70)]
    rows = [
        (k, " ".join([f"a{k}{i}" for i in range(20)] + passage + [f"b{k}{i}" for i in range(k % 7)]))
        for k in range(90)
    ]
    rows += [(3, rows[5][1])] * 40
    assert found_repeats(documents(rows)) == plain_repeats(rows)


def test_factors_are_greedy_longest_matches():
    random.seed(13)
    for _ in range(100):
        block = [random.choice([b"a", b"b", b"c"]) for _ in range(60)]
        text = [random.choice([b"a", b"b", b"c", b"d"]) for _ in range(80)]
        held = {tuple(block[i:j]) for i in range(60) for j in range(i + 1, 61)}
        ends, at = [], 0
        while at < len(text):
            size = 1
            while at + size < len(text) and tuple(text[at : at + size + 1]) in held:
                size += 1
            if tuple(text[at : at + 1]) not in held:
                size = 1
            at += size
            ends.append(at)
        assert repeats.Block(block).factors(text) == ends


def test_repeats_of_an_empty_table(documents):
    assert found_repeats(documents([])) == []
    assert found_repeats(documents([(1, None), (2, "")])) == [(1, 0, 0, ""), (2, 0, 0, "")]
