"""Results that a cut or a shortcut would lose, case by case."""

import random

from listinglake.llm import decontam, licences, neardup, secret_scan

SHORT = "doc_id bigint, text string"


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


# --- secrets --------------------------------------------------------------------------------


def test_values_behind_an_equals_sign_are_tokens(spark):
    random.seed(8)
    letters = secret_scan.ALPHABETS["base64"][:62]
    forms = (
        ("AWS_SECRET_ACCESS_KEY=", ""),
        ("export AUTH=", "\n"),
        ("see https://host.example/path?user=7&sig=", "&v=1"),
        ("DEPLOYMENT_SIGNATURE_2024_VALUE=", "=="),
        ("plain ", " "),
    )
    rows, wanted = [], {}
    for number in range(200):
        before, after = forms[number % len(forms)]
        key = "".join(random.choice(letters) for _ in range(64))
        rows.append((number, f"{before}{key}{after}"))
        padding = 2 if after == "==" else 0
        wanted[number] = f"random:{len(before)}:{len(before) + 64 + padding}"
    found = by_id(secret_scan.find_secrets(spark.createDataFrame(rows, SHORT)))
    for at, (before, _) in enumerate(forms):
        mine = [n for n in wanted if n % len(forms) == at]
        hits = sum(wanted[n] in found[n].spans.split(",") for n in mine)
        assert hits >= 0.9 * len(mine), (before, hits)
        assert all(found[n].spans in ("", wanted[n]) for n in mine)


# --- decontamination ------------------------------------------------------------------------


def judged(documents, spark, texts, items):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return by_id(decontam.judge(documents(list(enumerate(texts))), benchmark))


def test_a_repeated_phrase_counts_once(spark, documents):
    item = "which of the following words is closest to stone river cloud window garden bottle candle"
    phrase = " ".join(item.split()[:8])
    quiz = ". ".join(f"{phrase} answer{k} other{k} more{k}" for k in range(6))
    parts = f"{item[:item.index(' cloud')]} and then the words {item[item.index('is closest'):]}"
    found = judged(documents, spark, [quiz, f"{quiz} {item}", parts], [item])
    assert [found[k].contaminated for k in range(3)] == [False, True, True]
    assert found[1].coverage == 1.0


def test_verbatim_copies_of_numbers_and_in_any_case(spark, documents):
    story = (
        "Natalia sold clips to 48 of her friends in April, and then she sold half as many"
        " clips in May."
    )
    figures = "1998 12.5 7 300 1999 13.5 8 310 2000 14.5 9 320"
    items = [story, "Compute 3 + 4 + 5 + 6", figures, "Ann Bob Carl Dora Emil Fritz Gerd"]
    clean = "nothing of the kind is said in these words about rivers"
    texts = [*(f"{clean}. {text} {clean}" for text in items)]
    texts += [f"{clean} {text.lower()} {clean}" for text in items]
    texts += [f"{clean} {text.upper()} {clean}" for text in items]
    texts += [clean, "Compute 3 + 4 + 7 + 9", "2001 12.5 6 301 1999 13.4 8 315 2000 14.6 9 325"]
    found = judged(documents, spark, texts, items)
    for number in range(12):
        assert found[number]["items"] == str(number % 4), number
        assert found[number].coverage == 1.0 and not found[number].reparameterised
    assert not any(found[number].contaminated for number in (12, 13, 14))


def test_short_items_are_reported_but_condemn_nothing(documents, spark):
    texts = [
        "People often ask what is the capital of a firm and how it is raised over the years",
        "Some think what is 7, 8 and so on matters little to those who count",
        "They asked: What is the capital of the smallest island state in the world? Nobody knew.",
    ]
    items = ["What is the capital", "What is 3 + 4", "What is the capital of the smallest island state in the world?"]
    found = judged(documents, spark, texts, items)
    assert [found[k].contaminated for k in range(3)] == [False, False, True]
    assert (found[0]["items"], found[2]["items"]) == ("0", "0,2")
    assert not found[1].reparameterised
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    kept = decontam.keep_clean(documents(list(enumerate(texts))), benchmark)
    assert sorted(row.doc_id for row in kept.collect()) == [0, 1]


# --- near duplicates ------------------------------------------------------------------------


def test_rows_of_one_id_replace_each_other_only_within_a_group(documents):
    first, second, third = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, first), (9, first), (9, second), (9, third), (9, third.upper()), (9, third)]
    rows += [(9, f"{third} more"), (3, second + " x"), (4, ""), (4, ""), (4, None)]
    rows += [(None, first), (None, first)]
    found = neardup.keep_first(documents(rows, extra=True))
    assert found.columns == documents([], extra=True).columns
    kept = sorted((row.doc_id or 0, row.text or "") for row in found.collect())
    wanted = [(5, first), (3, second + " x"), (9, third.upper()), (4, ""), (4, "")]
    assert kept == sorted([*wanted, (0, first), (0, first)])


# --- licences -------------------------------------------------------------------------------


def test_notices_broken_over_lines_are_named(documents):
    random.seed(6)
    word = ["the", "of", "license", "work", "under", "rain", "tree"]
    prose = [" ".join(random.choice(word) for _ in range(30)) for _ in range(60)]
    header = (
        "This program is free software: you can redistribute it and/or modify",
        "it under the terms of the GNU General Public License as published by",
    )
    notices = {
        100: ("gpl", "\n    ".join(header)),
        101: ("gpl", "\n# ".join(header)),
        102: ("mit", "Permission is hereby granted, free of charge,\n * to any person obtaining a\n * copy of this software"),
        103: ("apache", "you may not use this file\n// except in compliance with\n// the License"),
        104: ("bsd", "Redistribution and use in source\nand binary forms, with or\nwithout modification,\nare permitted"),
    }
    rows = list(enumerate(prose))
    rows += [(k, f"{prose[0]}\n\n{text}\n\n{prose[1]}") for k, (_, text) in notices.items()]
    rows.append((200, "\n\n".join(header)))
    frame = documents(rows)
    for row in licences.scan(frame, licences.train(frame)).collect():
        family, text = notices.get(row.doc_id, ("", ""))
        assert row.families == family, row
        if family:
            start = len(prose[0]) + 2
            assert row.spans == f"{family}:{start}:{start + len(text)}", row
