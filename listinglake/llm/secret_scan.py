"""Secret scans: three exact patterns, and a randomness test battery on further tokens.

Base spans are the leftmost non-overlapping matches of three patterns, short ones dropped.

The battery looks at every run of ``TOKEN`` characters; ``=`` ends a run, so the value of
``NAME=value`` is a token by itself, and only padding at the very end belongs to it. Its encoding is inferred from its
characters (hex, base32, base64; plain words and plain numbers have none). Three tests ask
whether its symbols could be uniform draws from that alphabet: chi-squared over the
alphabet, runs above and below the alphabet's middle, and serial correlation of
neighbouring symbols. A token that any of them rejects is dropped. The same three values,
combined by Stouffer's sum, give a p-value against text, whose letters are uneven, turn
seldom and follow their neighbours: each of these grows with length, so a short token cannot
reach a small p-value. Benjamini-Hochberg control at ``RATE`` then runs over all tokens of
one stratum (encoding and length class), so that many short tokens do not loosen the bound
for long ones, nor the reverse.

Native: DataFrame expressions only. One map reads the texts and leaves spans and p-values;
these are counted into ``BINS`` bins a stratum, so control needs one small aggregate and at
most strata rows on the driver; a second map over the stored values picks spans. No shuffle
of texts or of tokens. A bin counts with its upper edge, which can only drop tokens that
exact control would keep.

Null and empty texts give no spans and the hash of an empty list. Null ids and repeated rows
are scanned each. Tokens that overlap a base span are left to it. Ties in start go by kind
in the order assign, access, hex, random. Without tokens nothing is added. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.session import store

#: Fixed patterns of the base, in the order of their kinds.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 8

#: An equals sign parts a name from its value, or pads the end of a token.
TOKEN = r"[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
#: Alphabet of each encoding, in the order of its values.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: A test rejects uniformity beyond this many standard deviations.
REJECT = 3.3
#: Text against uniform symbols: chi-squared gained for each symbol, ...
UNEVENNESS = {"hex": 1.0, "base32": 1.1, "base64": 2.8}
#: ... share of neighbours on different sides of the alphabet's middle, ...
TURNS = 0.3
#: ... and their correlation.
FOLLOWS = 0.25
RATE = 0.05
BINS = 200
#: p-values below 10 ** -LOWEST share the last bin.
LOWEST = 20
#: Upper bounds of the length classes, beyond which there is one more.
LENGTHS = (23, 31, 47, 71, 127, 511)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, value) in code points, of the leftmost matches of ``pattern``.

    What ``split`` leaves between the matches gives their places. ``value`` is ``group`` of
    the match; matches whose value is shorter than ``least`` are dropped.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.char_length(gap))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state: Column, at: Column) -> Column:
        start = state["end"] + at["gap"]
        end = start + F.coalesce(F.char_length(at["whole"]), F.lit(0))
        item = F.struct(start.alias("start"), end.alias("end"), at["value"].alias("value"))
        passes = at["whole"].isNotNull() & (F.char_length(at["value"]) >= least)
        return F.struct(
            end.alias("end"),
            F.when(passes, F.concat(state["found"], F.array(item)))
            .otherwise(state["found"])
            .alias("found"),
        )

    walked = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("end"), nothing.alias("found")),
        step,
        lambda state: state["found"],
    )
    return F.when(text.rlike(pattern), walked).otherwise(nothing)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) sorted; ``kind`` counts through ``KINDS``."""

    def of(kind: int, found: Column) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
        )

    return F.array_sort(
        F.concat(
            of(0, spans(text, ASSIGN, 2, ASSIGN_LEAST)),
            of(1, spans(text, ACCESS)),
            of(2, spans(text, HEX)),
        )
    )


def encoding(token: Column) -> Column:
    """The densest alphabet that holds the token, null for plain words and numbers."""
    digit, lower, upper = (token.rlike(x) for x in ("[0-9]", "[a-z]", "[A-Z]"))
    mixed = digit.cast("int") + lower.cast("int") + upper.cast("int") >= 2
    return (
        F.when(~mixed, F.lit(None))
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(token.rlike("^[A-Z2-7]+=*$"), "base32")
        .when(token.rlike("^[A-Za-z0-9+/_-]+=*$"), "base64")
    )


def _lower_tail(z: Column) -> Column:
    """Share of a normal distribution below ``z``, by the usual five-term series."""
    t = 1.0 / (1.0 + 0.2316419 * F.abs(z))
    # Fixed values of the series.
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    series = F.lit(0.0)
    for term in reversed(terms):
        series = (series + term) * t
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * series
    return F.when(z < 0, tail).otherwise(1.0 - tail)


def p_value(token: Column, kind: str) -> Column:
    """Against text, of a token in encoding ``kind``; 1 when a test rejects uniformity."""
    alphabet = ALPHABETS[kind]
    size, middle, uneven = len(alphabet), len(alphabet) / 2, UNEVENNESS[kind]
    plain = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    plain = F.lower(plain) if kind == "hex" else plain
    symbols = F.filter(F.split(plain, ""), lambda c: c != "")
    start = F.struct(
        *(F.lit(0.0).alias(x) for x in ("n", "high", "turns", "sum", "squares", "cross")),
        F.lit(-1.0).alias("last"),
    )

    def step(state: Column, symbol: Column) -> Column:
        value = (F.position(symbol, F.lit(alphabet)) - 1).cast("double")
        later = state["last"] >= 0
        turned = later & ((state["last"] >= middle) != (value >= middle))
        return F.struct(
            (state["n"] + 1).alias("n"),
            (state["high"] + (value >= middle).cast("double")).alias("high"),
            (state["turns"] + turned.cast("double")).alias("turns"),
            (state["sum"] + value).alias("sum"),
            (state["squares"] + value * value).alias("squares"),
            (state["cross"] + F.when(later, state["last"] * value).otherwise(0.0)).alias("cross"),
            value.alias("last"),
        )

    repeats = F.aggregate(
        F.array_distinct(symbols),
        F.lit(0.0),
        lambda total, c: total
        + F.pow((F.char_length(plain) - F.char_length(F.replace(plain, c, F.lit("")))).cast("double"), F.lit(2.0)),
    )

    def judged(s: Column) -> Column:
        n = s["n"]
        chi = size / n * repeats - n
        chi_z = (chi - (size - 1)) / F.sqrt(2.0 * (size - 1) * (n - 1) / n)
        low = n - s["high"]
        runs_mean = 2 * s["high"] * low / n
        runs_var = runs_mean * (runs_mean - 1) / (n - 1)
        runs_z = F.when(runs_var > 0, (s["turns"] - runs_mean) / F.sqrt(runs_var)).otherwise(99.0)
        mean = s["sum"] / n
        spread = s["squares"] - n * mean * mean
        serial = F.when(spread > 0, (s["cross"] - n * mean * mean) / spread).otherwise(1.0)
        serial_z = serial * F.sqrt(n)
        odd = F.greatest(F.abs(chi_z), F.abs(runs_z), F.abs(serial_z)) > REJECT
        text_chi = (chi - (size - 1) - (n - 1) * uneven) / F.sqrt(
            2.0 * (size - 1) + 4 * (n - 1) * uneven * (1 + uneven)
        )
        text_runs = (TURNS * (n - 1) - s["turns"]) / F.sqrt(TURNS * (1 - TURNS) * (n - 1))
        text_serial = (serial - FOLLOWS) * F.sqrt(n)
        combined = (text_chi + text_runs + text_serial) / 3**0.5
        return F.when(odd, 1.0).otherwise(_lower_tail(combined))

    return F.aggregate(symbols, start, step, judged)


def tokens(text: Column, base: Column) -> Column:
    """Array of (start, end, stratum, p) of tokens of some encoding, clear of base spans."""
    found = F.filter(
        spans(text, TOKEN),
        lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])),
    )

    def tested(s: Column) -> Column:
        return _let(
            F.struct(s.alias("at"), encoding(s["value"]).alias("kind")),
            lambda x: F.struct(
                x["at"]["start"].alias("start"),
                x["at"]["end"].alias("end"),
                F.concat_ws("-", x["kind"], length_class(x["at"]["end"] - x["at"]["start"])).alias(
                    "stratum"
                ),
                F.when(x["kind"].isNull(), F.lit(None))
                .when(x["kind"] == "hex", p_value(x["at"]["value"], "hex"))
                .when(x["kind"] == "base32", p_value(x["at"]["value"], "base32"))
                .otherwise(p_value(x["at"]["value"], "base64"))
                .alias("p"),
            ),
        )

    return F.filter(F.transform(found, tested), lambda t: t["p"].isNotNull())


def length_class(size: Column) -> Column:
    found = F.when(size <= LENGTHS[0], F.lit(f"{LENGTHS[0]:04d}"))
    for bound in LENGTHS[1:]:
        found = found.when(size <= bound, f"{bound:04d}")
    return found.otherwise("more")


def _bin(p: Column) -> Column:
    depth = -F.log10(F.greatest(p, F.lit(10.0**-LOWEST)))
    return F.least(F.floor(depth * (BINS / LOWEST)), F.lit(BINS - 1)).cast("int")


def accepted_bins(scanned: DataFrame) -> dict[str, int]:
    """The first accepted bin of each stratum that accepts any; at most one row a stratum."""
    counted = (
        scanned.select(F.explode("tokens").alias("token"))
        .groupBy(F.col("token.stratum").alias("stratum"), _bin(F.col("token.p")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("tokens"))
    )
    stratum = Window.partitionBy("stratum")
    edge = F.pow(F.lit(10.0), -F.col("bin") * (LOWEST / BINS))
    controlled = counted.select(
        "stratum",
        "bin",
        F.sum("tokens").over(stratum).alias("all"),
        F.sum("tokens").over(stratum.orderBy(F.desc("bin"))).alias("here"),
    ).where(edge <= RATE * F.col("here") / F.col("all"))
    return dict(controlled.groupBy("stratum").agg(F.min("bin")).collect())


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, base, tokens) of every row, stored: spans and p-values, no texts."""
    text = F.coalesce("text", F.lit(""))
    return store(
        documents.select("doc_id", text.alias("text"), base_spans(text).alias("base")).select(
            "doc_id", "base", tokens(F.col("text"), F.col("base")).alias("tokens")
        ),
        "secret-scan",
    )


def find_secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row."""
    scanned = scan(documents)
    accepted = accepted_bins(scanned)
    random = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if accepted:
        first = F.create_map(*[F.lit(x) for item in accepted.items() for x in item])
        passing = F.filter("tokens", lambda t: _bin(t["p"]) >= first[t["stratum"]])
        random = F.transform(
            passing,
            lambda t: F.struct(
                t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")
            ),
        )

    def listed(found: Column) -> Column:
        name = F.array(*[F.lit(kind) for kind in KINDS])
        return F.array_join(
            F.transform(
                found,
                lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"]),
            ),
            ",",
        )

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.size(random).cast("bigint").alias("n_random"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", random))).alias("spans"),
    )


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
