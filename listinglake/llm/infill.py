"""Fill-in-middle by repeated-capture matching.

A text is cut into tokens, each white space with the word behind it or white space at the end.
One fullmatch of ``(token)*`` keeps every repetition of its group, so ``match.ends(1)`` holds
all token ends: its length is the number of tokens, and two of its entries are the cuts. No
loop goes over tokens. Captures of one match cost memory beyond their ends, so a text of more
than ``TOGETHER`` characters is matched in stretches, each ending at a token's end; the ends
are the same. Quantifiers are possessive: the match never has to go back.

Cuts and form come from a keyed hash of the id, so a rerun task gives the same output. The
tokens of a text are put as prefix-suffix-middle or suffix-prefix-middle behind marks; texts
that hold a mark stay plain, so that :func:`restored` finds the exact text in every output.

One map over whole texts, no shuffle. Null and empty texts are plain, with 0 tokens and an
empty output. A null id hashes as the empty string. Repeated rows give equal rows. Extra
columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table

MARKS = ("<P>", "<S>", "<M>")
#: Seed of the hash, percent of texts that are transformed, percent of those suffix first.
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
#: Characters matched at once.
TOGETHER = 1 << 20
_SPACE = r"\x20\x09-\x0D"
_TOKENS = regex.compile(rf"([{_SPACE}]*+[^{_SPACE}]++|[{_SPACE}]++)*+")
_TOKEN_END = regex.compile(rf"(?<=[^{_SPACE}])(?=[{_SPACE}])")


def token_ends(text: str, together: int = TOGETHER) -> np.ndarray:
    """End of every token of ``text``, in code points."""
    found, start = [], 0
    while start < len(text):
        cut = _TOKEN_END.search(text, start + together) if len(text) - start > together else None
        stop = cut.start() if cut else len(text)
        found.append(np.array(_TOKENS.fullmatch(text, start, stop).ends(1), dtype=np.int64))
        start = stop
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    documents: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` counts tokens, ``form`` is plain, psm or spm, ``output`` the whole new text.
    """
    first, second, third = marks
    borders = any(a[:k] == b[-k:] for a in marks for b in marks for k in range(1, min(len(a), len(b))))
    if borders or any(a in b for a, b in itertools.permutations(marks, 2)):
        raise ValueError("marks must not overlap one another")
    kind = documents.schema["doc_id"].dataType.simpleString()
    draws = _draws(F.col("doc_id"), seed)
    rows = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), *[d.alias(f"h{k}") for k, d in enumerate(draws)]
    )

    def one(text, h0, h1, h2, h3):
        ends = token_ends(text)
        n = len(ends)
        if not text or h2 % 100 >= rate or any(mark in text for mark in marks):
            return n, "plain", None, None, text
        low, high = sorted((h0 % (n + 1), h1 % (n + 1)))
        at, to = (int(ends[k - 1]) if k else 0 for k in (low, high))
        prefix, middle, suffix = text[:at], text[at:to], text[to:]
        if h3 % 100 < suffix_first:
            return n, "spm", at, to - at, f"{second}{suffix}{first}{prefix}{third}{middle}"
        return n, "psm", at, to - at, f"{first}{prefix}{second}{suffix}{third}{middle}"

    def run(batches):
        for batch in batches:
            inputs = [batch.column(k).to_pylist() for k in range(1, 6)]
            columns = list(zip(*map(one, *inputs), strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )


def restored(form: Column, output: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text behind an output of :func:`fill_in_middle`, from form and output alone."""
    first, second, third = (F.lit(mark) for mark in marks)

    def part(text: Column, mark: Column, number: int) -> Column:
        return F.split_part(text, mark, F.lit(number))

    middle = part(output, third, 2)
    rest = part(output, third, 1)
    psm = F.concat(part(part(rest, second, 1), first, 2), middle, part(rest, second, 2))
    spm = F.concat(part(rest, first, 2), middle, part(part(rest, first, 1), second, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


@query(
    "op12_infill",
    r"""
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''),
          '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
        sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
      FROM documents
    ), drawn AS (
      SELECT *, CAST(len(tokens) AS BIGINT) AS n,
        CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1,
        CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3,
        CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
      FROM cut
    ), formed AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
            OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
          WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM drawn
    ), parts AS (
      SELECT *, array_to_string(tokens[1:low], '') AS p, array_to_string(tokens[low + 1:high], '') AS m,
        array_to_string(tokens[high + 1:], '') AS s
      FROM formed
    )
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
