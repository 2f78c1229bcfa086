"""Operators on documents, against brute force, planted cases and odd inputs."""

import collections
import hashlib
import random
import re

import pytest

from listinglake.llm import decontam, licences, mixing, neardup, pii, quality, secret_scan
from listinglake.llm import token_counts
from listinglake.llm.components import components

SHORT = "doc_id bigint, text string"


def base_of(patterns, text):
    """Leftmost matches per kind, failing ones dropped: the contract, spelled out."""
    found = []
    for kind, (pattern, flags, passes) in enumerate(patterns):
        for match in re.finditer(pattern, text or "", flags):
            if passes(match):
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def sha(found, kinds):
    listed = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
    return hashlib.sha256(listed.encode()).hexdigest()


def digits(match):
    return re.sub("[^0-9]", "", match.group())


SECRETS = (
    (
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.I | re.A,
        lambda m: len(m.group(2)) >= 8,
    ),
    (r"AKIA[A-Z0-9]+", 0, lambda m: len(m.group()) >= 16),
    (r"[0-9a-f]+", 0, lambda m: len(m.group()) >= 32),
)
PERSONAL = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, lambda m: True),
    (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        0,
        lambda m: all(int(x) <= 255 for x in m.group().split(".")),
    ),
    (
        r"[0-9]([\x20-]?[0-9])+",
        0,
        lambda m: 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m)),
    ),
    (r"\+[0-9][\x20().0-9-]+[0-9]", 0, lambda m: 9 <= len(digits(m)) <= 15),
)


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


# --- quality -----------------------------------------------------------------------------


def labelled(count=300):
    random.seed(4)
    vocabulary = [f"w{k}" for k in range(40)]
    rows, labels = [], []
    for number in range(count):
        found = [random.choice(vocabulary) for _ in range(40)]
        good = number % 3 > 0
        rows.append((number, " ".join(found if good else [w.upper() + "!!" for w in found])))
        labels.append((number, int(good), 0))
    return rows, labels


def test_quality_learns_and_holds_out(spark, documents):
    rows, labels = labelled()
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = quality.classify(documents(rows, extra=True), frame).collect()
    assert len(found) == len(rows)
    import zlib

    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [row for row in found if row.held_out]
    assert held and all(row.predicted == int(row.doc_id % 3 > 0) for row in held)


def test_quality_repeats_show_in_unseen_words(spark, documents):
    rows, _ = labelled(200)
    rows = [
        (i, t if i % 2 else " ".join(f"q{i}" for _ in range(40)))
        for i, t in ((i, t.replace("!!", "").lower()) for i, t in rows)
    ]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id int, quality int, toxic int")
    weights = quality.train(documents(rows), labels)
    import pyarrow as pa

    scores = quality.text_scores(pa.array(["new new new new new new", "w3 w8 w1 w30 w2 w5"]), weights)
    assert scores[0] < 0.3 < scores[1]


def test_quality_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame(
        [(5, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    assert quality.classify(documents(odd), labels).count() == len(odd)
    none = labels.where("false")
    assert {r.score for r in quality.classify(documents(odd), none).collect()} == {0.5}
    assert quality.classify(documents([]), labels).count() == 0
    kept = quality.keep_good(documents(odd, extra=True), none)
    assert kept.count() == len(odd) and kept.columns == documents([], extra=True).columns


# --- components and near duplicates ---------------------------------------------------------


def test_components_of_chains_stars_and_noise(spark):
    edges = [(k, k + 1) for k in range(1, 200)] + [(500, k) for k in range(501, 560)]
    edges += [(3, 3), (None, 4), (7, None), (2, 1), (2, 1)]
    random.seed(1)
    random.shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[k] for k in range(1, 201)} == {1}
    assert {found[k] for k in range(500, 560)} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not found:
        return set()
    if len(found) < size:
        return {tuple(found)}
    return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)}


def brute_components(rows, size, similarity):
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in ids}


def variants(seed, count=120):
    """Near copies of a few texts: words replaced, dropped or added, at the threshold."""
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    originals = [[random.choice(vocabulary) for _ in range(n)] for n in (4, 12, 60, 150, 151)]
    rows = []
    for number in range(count):
        found = list(random.choice(originals))
        for _ in range(random.choice([0, 0, 1, 2, 4, 7])):
            at = random.randrange(len(found))
            found[at : at + 1] = random.choice([[], [random.choice(vocabulary[:5])], [found[at], "x"]])
        rows.append((number * 3 + 1, random.choice([str, str.upper])(" ".join(found))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(documents, seed):
    rows = variants(seed)
    sets, expected = brute_components(rows, 3, 85)
    found = by_id(neardup.near_duplicates(documents(rows, extra=True), 3, 85))
    for number, _ in rows:
        assert found[number].n_shingles == len(sets[number])
        assert found[number].component_id == expected[number], number
        assert found[number].kept == (number == expected[number])


def test_near_duplicates_odd_rows(documents, odd):
    rows = neardup.near_duplicates(documents(odd)).collect()
    assert len(rows) == len(odd)
    for row in rows:
        assert row.component_id == row.doc_id and row.kept
    assert {r.n_shingles for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert neardup.near_duplicates(documents([])).count() == 0
    kept = neardup.keep_first(documents(odd, extra=True))
    # The repeated row goes, all others stay as they are.
    assert kept.count() == len(odd) - 1
    assert kept.columns == documents([], extra=True).columns


def test_copies_are_linked_without_pairs(documents):
    rows = [(k, "a b c d e f g h i j") for k in range(9, 400)]
    found = neardup.near_duplicates(documents(rows)).collect()
    assert {r.component_id for r in found} == {9} and sum(r.kept for r in found) == 1


# --- decontamination ------------------------------------------------------------------------


ITEM = (
    "If Maria buys 12 apples for 3.50 dollars each and then sells 5 apples, how many apples"
    " and dollars does Maria have left when the day is over and all the shops have closed"
)


def judged(documents, spark, texts, items):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return by_id(decontam.judge(documents(list(enumerate(texts)), extra=True), benchmark))


def test_templates_catch_verbatim_shouted_and_reparameterised(spark, documents):
    anew = ITEM.replace("Maria", "John Smith").replace("12", "340").replace("3.50", "7").replace("5 ", "81 ")
    mixed = ITEM.replace("Maria have", "Peter have").replace("Maria buys", "John buys")
    clean = " ".join(f"other{k} words{k}" for k in range(60))
    texts = [
        f"{clean}. {ITEM} {clean}",
        "!! ".join(ITEM.replace("Maria", "she").upper().split()),
        f"{clean} {anew}",
        clean,
        " ".join(reversed(ITEM.split())),
        ITEM[:60],
        mixed,
    ]
    items = [ITEM, None, "", "too short", ITEM.replace("Maria", "she")]
    found = judged(documents, spark, texts, items)
    assert [found[k].contaminated for k in range(6)] == [True, True, True, False, False, False]
    assert not found[0].reparameterised and found[2].reparameterised
    # One name of the item stands for two here, which the check of slots sees.
    assert "0" not in found[6]["items"].split(",")


def test_short_items_and_odd_rows(spark, documents, odd):
    found = judged(documents, spark, ["alpha beta gamma delta", "x alpha beta gamma delta y"], ["alpha beta gamma delta"])
    assert found[0].contaminated and found[1].contaminated
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    rows = decontam.judge(documents(odd), benchmark).collect()
    assert len(rows) == len(odd) and not any(r.contaminated for r in rows)
    assert decontam.judge(documents([]), benchmark).count() == 0
    assert decontam.keep_clean(documents(odd), benchmark.where("false")).count() == len(odd)
    twice = documents([(1, ITEM), (1, ITEM), (1, "clean"), (None, ITEM)])
    verdicts = collections.Counter(r.contaminated for r in decontam.judge(twice, benchmark).collect())
    assert verdicts == {True: 3, False: 1}
    assert decontam.keep_clean(twice, benchmark).count() == 1


# --- secrets and personal data --------------------------------------------------------------


def test_secret_base_equals_the_contract(spark):
    random.seed(2)
    parts = ["token", "secret", "api_key", "PASSWD", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH1234"]
    parts += ["0123456789abcdef" * 2, "abcdefgh", "é", "😀", ".", "-", "\n", "ſecret=abcdefgh"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(600)]
    rows = list(enumerate([*texts, None, "", "token=" + "a" * 50_000]))
    found = by_id(secret_scan.find_secrets(spark.createDataFrame(rows, SHORT)))
    for number, text in rows:
        expected = base_of(SECRETS, text)
        assert found[number].base_sha256 == sha(expected, secret_scan.KINDS), text
        counts = [sum(k == kind for _, k, _ in expected) for kind in range(3)]
        assert [found[number][f"n_{n}"] for n in secret_scan.KINDS[:3]] == counts


def test_random_tokens_are_found_and_words_are_not(spark):
    random.seed(1)
    letters = secret_scan.ALPHABETS["base64"]
    rows = []
    for number in range(200):
        key = "".join(random.choice(letters) for _ in range(64))
        name = "".join(random.choice(["Config", "manager2", "Helper", "users", "Path/"]) for _ in range(9))
        rows.append((number, f"see {key} in {name} and {'ab12' * 12}"))
    found = secret_scan.find_secrets(spark.createDataFrame(rows, SHORT)).collect()
    assert sum(r.n_random for r in found) >= 190
    for row in found:
        assert all(s in ("random:4:68",) for s in row.spans.split(",") if s.startswith("random"))


def test_secret_odd_rows(documents, odd):
    rows = secret_scan.find_secrets(documents(odd, extra=True)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(odd) and {r.base_sha256 for r in rows} == {empty}
    assert secret_scan.find_secrets(documents([])).count() == 0


def test_personal_base_equals_the_contract():
    random.seed(3)
    for _ in range(5_000):
        text = "".join(random.choice("ab1.9@ +-()4_2\n") for _ in range(random.randint(0, 40)))
        assert pii.base_spans(text) == base_of(PERSONAL, text), text
    assert pii.base_spans("9" * 100_000) == []
    assert pii.base_spans("a" * 50_000 + "@") == []


def test_skip_chain_carries_labels_to_repeats():
    text = "Write to jane.doe77@mail.example.com today. Later jane.doe77 replied about 12 things."
    (base, more), (none, nothing) = pii.search([text, "It cost 12.5 in 2024, jane said."], pii.prior())
    assert [text[a:b] for a, _, b in base] == ["jane.doe77@mail.example.com"]
    assert [(text[a:b], pii.KINDS[k]) for a, k, b in more] == [("jane.doe77", "email")]
    assert none == nothing == []
    assert pii.redacted(text, base + more).count("[EMAIL]") == 2


def test_large_groups_need_no_pairs():
    text = "a +1 (743) 555-3824 b " + "0005553824 " * 20_000
    assert len(pii.candidates(text)) == 20_003
    pii.search([text], pii.prior())


def test_personal_rows(documents, odd):
    texts = [(k, f"call +1 (743) 555-{3000 + k} or 10.0.0.{k} now") for k in range(50)]
    rows = by_id(pii.find_personal(documents(texts, extra=True)))
    for number, text in texts:
        assert rows[number].base_sha256 == sha(base_of(PERSONAL, text), pii.KINDS)
        assert rows[number].n_phone == 1 and rows[number].n_ip == 1
    clean = pii.redact(documents(texts + odd, extra=True))
    assert clean.columns == documents([], extra=True).columns
    assert clean.where("text like '%[PHONE]%' and text like '%[IP]%'").count() == 50
    assert clean.where("n_chars != char_length(text)").count() == 0
    assert pii.find_personal(documents(odd)).count() == len(odd)
    assert pii.find_personal(documents([])).count() == 0


# --- token counts, licences, mixing ---------------------------------------------------------


def test_counts_equal_the_tokenizer():
    import sentencepiece
    from tokenizers import Tokenizer, models

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.VOCABULARY)
    pieces = [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]
    exact = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    random.seed(1)
    texts = ["".join(random.choice(" ▁abtheion\n日🦊é.,  ") for _ in range(random.randint(0, 70))) for _ in range(3_000)]
    texts += [None, "", " ", "  ", "a" * 3_000, "the " * 500]
    expected = [len(exact.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in texts]
    counter = token_counts.Counter(token_counts.read_vocabulary())
    assert counter.counts(texts) == expected
    counter.by_word = False
    assert counter.counts(texts) == expected


def test_token_rows(documents, odd):
    rows = token_counts.count_tokens(documents(odd, extra=True)).collect()
    assert len(rows) == len(odd) and all(r.n_tokens == 0 for r in rows if r.doc_id in (1, 2))
    assert token_counts.count_tokens(documents([])).count() == 0


def test_licences_are_named_and_prose_is_not(documents, odd):
    random.seed(5)
    prose = [" ".join(random.choice(["the", "of", "license", "work", "under", "rain", "tree"]) for _ in range(30)) for _ in range(60)]
    texts = [(k, t) for k, t in enumerate(prose)]
    notices = {100: "mit", 101: "gpl", 102: "reserved", 103: "cc-by-nc", 104: "apache"}
    for number, family in notices.items():
        texts.append((number, f"{prose[0]}\n{licences.TEMPLATES[family][0]}.\n{prose[1]}"))
    frame = documents(texts + odd, extra=True)
    rows = licences.scan(frame, licences.train(frame)).collect()
    assert len(rows) == len(texts) + len(odd)
    for row in rows:
        assert row.families == notices.get(row.doc_id, ""), row
        if row.doc_id in notices:
            family, start, end = row.spans.split(":")
            text = dict(texts)[row.doc_id]
            assert text[int(start) : int(end)] == licences.TEMPLATES[family][0] + "."
    empty = documents([])
    assert licences.scan(empty, licences.train(empty)).count() == 0


def test_raking_meets_given_targets(spark, documents):
    rows = [(k, "word " * (1 + k % 7) + ("a@b" if k % 4 else "")) for k in range(400)]
    frame = documents(rows, extra=True)
    shares = [("source", "s0", 0.7), ("source", "s1", 0.3), ("lang", "en", 1.0)]
    shares += [("topic", "contact", 0.4), ("topic", "prose", 0.6)]
    targets = spark.createDataFrame(shares, "dimension string, value string, share double")
    found = mixing.mix(frame, targets)
    cells = found.select(*mixing.DIMENSIONS, "weight").distinct().collect()
    for dimension, value, share in shares:
        assert sum(c.weight for c in cells if c[dimension] == value) == pytest.approx(share, abs=1e-4)
    kept = found.agg({"kept": "count"}).first()
    assert kept is not None
    whole = found.selectExpr("sum(tokens * chance) / sum(tokens)").first()[0]
    assert whole == pytest.approx(mixing.BUDGET, abs=0.02)
    sampled = mixing.sampled(frame, targets)
    assert sampled.count() == found.where("kept").count()


def test_mixing_odd_rows(documents, odd):
    frame = documents(odd).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    rows = mixing.mix(frame).collect()
    assert len(rows) == len(odd) and {r.lang for r in rows} == {"unknown"}
    assert {r.tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    blank = mixing.mix(documents([(1, ""), (2, None)])).collect()
    assert [r.kept for r in blank] == [False, False]
    assert mixing.mix(documents([])).count() == 0
