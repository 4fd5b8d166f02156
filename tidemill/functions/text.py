"""Text cleaning and lexicon sentiment, all inside the JVM and row-local."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import _col

# Placeholder bodies, label bounds, normaliser of the compound score.
REMOVED = ["[removed]", "[deleted]"]
LABEL_BOUND = 0.05
COMPOUND_ALPHA = 15.0

_URL = r"http[^\s\p{Z}]+"
_UNREADABLE = r"[^\p{L}\p{N}_\s\p{Z}.,!?-]"
_BLANKS = r"[\s\p{Z}]+"
_NOT_A_TOKEN = r"[^\p{L}\p{N}']+"


def clean(text: Column | str) -> Column:
    """Readable text: no placeholders, URLs or symbols, single blanks."""
    text = _col(text)
    out = F.regexp_replace(text, _URL, "")
    out = F.regexp_replace(out, _UNREADABLE, " ")
    out = F.trim(F.regexp_replace(out, _BLANKS, " "))
    return F.when(text.isNull() | text.isin(REMOVED), "").otherwise(out)


def excerpt(text: Column | str, chars: int) -> Column:
    return F.substring(_col(text), 1, chars)


def joined_text(*parts: Column | str) -> Column:
    """Parts joined by a blank; missing parts are empty, not the word None."""
    return F.trim(F.concat_ws(" ", *[F.coalesce(_col(p), F.lit("")) for p in parts]))


def tokens(text: Column | str) -> Column:
    """Lower-case words of the whole text."""
    return F.filter(F.split(F.lower(_col(text)), _NOT_A_TOKEN), lambda t: t != "")


def label(score: Column) -> Column:
    return (
        F.when(score >= LABEL_BOUND, "positive").when(score <= -LABEL_BOUND, "negative").otherwise("neutral")
    )


def compound(valence: Column) -> Column:
    """Summed valence squeezed into (-1, 1): s / sqrt(s*s + alpha)."""
    return valence / F.sqrt(valence * valence + F.lit(COMPOUND_ALPHA))


DIGITS = 16  # behind the point of a weight; a double near 1 has no more


def _weight(value: float) -> Decimal:
    """The decimal that a weight's shortest text names."""
    return round(Decimal(repr(float(value))), DIGITS).normalize()


def _hash_of(token: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(token), F.lit(buckets)).cast("int")


def _weights(lexicon: Mapping[str, tuple[float, float]]) -> tuple[Column, int, str, int]:
    """The lexicon as a constant array of small maps, found by a word's hash; the number of maps;
    the type of the weights; and the digits by which they are shifted to be whole.

    A map alone is searched from its first entry on.
    """
    weights = {w: (_weight(v), _weight(p)) for w, (v, p) in lexicon.items()}
    every = [x for pair in weights.values() for x in pair]
    digits = max([0, *(-x.as_tuple().exponent for x in every)])
    # As whole numbers where the longest text cannot exceed them.
    small = max((abs(x) for x in every), default=0) * 10**digits < 1 << 31
    kind = "bigint" if small else f"decimal(38,{digits})"
    buckets = 1 << max(4, len(weights).bit_length())
    maps: list[dict] = [{} for _ in range(buckets)]
    for word, pair in weights.items():
        v, p = (int(x.scaleb(digits)) if small else format(x, "f") for x in pair)
        maps[zlib.crc32(word.encode()) % buckets][word] = {"v": v, "p": p}
    table = F.from_json(F.lit(json.dumps(maps)), f"array<map<string,struct<v:{kind},p:{kind}>>>")
    return table, buckets, kind, digits if small else 0


def with_sentiment(
    df: DataFrame, lexicon: Mapping[str, tuple[float, float]], title: str = "title", body: str = "body"
) -> DataFrame:
    """Add the two scores, their mean and a label, from title and body together.

    ``lexicon`` maps a word to (valence, polarity).  Row-local: no shuffle, and usable on a
    stream.  Known words are picked out of the token array by a hashed set; each is looked up
    once.  Weights are added as the decimals they are written as.

    All scores come from one pass over the words, and are unfolded by a
    generator: a later filter on score or label does not score the text again.
    """
    table, buckets, kind, digits = _weights(lexicon)
    words = F.split(F.lower(joined_text(title, body)), _NOT_A_TOKEN)
    found = F.filter(F.transform(words, lambda t: table[_hash_of(t, buckets)][t]), lambda w: w.isNotNull())
    zero = F.lit(0).cast(kind)
    scores = F.aggregate(
        found,
        F.struct(zero.alias("v"), zero.alias("p"), F.lit(0).alias("n")),
        lambda sums, w: F.struct(
            (sums["v"] + w["v"]).cast(kind).alias("v"), (sums["p"] + w["p"]).cast(kind).alias("p"),
            (sums["n"] + F.lit(1)).alias("n"),
        ),
        lambda sums: _scores(*(sums[x].cast("double") / F.lit(10.0**digits) for x in ("v", "p")), sums["n"]),
    )
    return df.select("*", F.inline(F.array(scores)))


def with_sentiment_table(
    df: DataFrame, lexicon: DataFrame, key: str, title: str = "title", body: str = "body", salts: int = 64
) -> DataFrame:
    """The same scores from a lexicon table (word, valence, polarity).

    ``key`` must be unique.  Tokens are counted per row, then joined on (word, salt), so
    a frequent word is spread over ``salts`` tasks.  There is no hint: whether the lexicon
    is small enough to be sent whole, the optimizer decides by its bytes.
    """
    words = df.select(key, F.explode(tokens(joined_text(title, body))).alias("word"))
    # As decimals; times a count of ten digits they still fit.
    weight = f"decimal(27,{DIGITS})"
    units = lexicon.select("word", F.col("valence").cast(weight).alias("v"), F.col("polarity").cast(weight).alias("p"))
    salted = units.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    counts = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    matched = spread.join(salted, ["word", "salt"])
    sums = matched.groupBy(key).agg(
        F.sum(F.col("n").cast("decimal(10,0)") * F.col("v")).cast("double").alias("valence_sum"),
        F.sum(F.col("n").cast("decimal(10,0)") * F.col("p")).cast("double").alias("polarity_sum"),
        F.sum("n").alias("known_count"),
    )
    scored = df.join(sums, key, "left").fillna(0, ["valence_sum", "polarity_sum", "known_count"])
    scores = _scores(F.col("valence_sum"), F.col("polarity_sum"), F.col("known_count"))
    return scored.select(*df.columns, F.inline(F.array(scores)))


def _scores(valence: Column, polarity: Column, known: Column) -> Column:
    """Struct of the four sentiment fields from the sums of the known words' weights."""
    first = compound(valence)
    second = F.coalesce(F.try_divide(polarity, known.cast("double")), F.lit(0.0))
    both = (first + second) / F.lit(2.0)
    return F.struct(
        F.round(first, 4).alias("compound_score"),
        F.round(second, 4).alias("polarity_score"),
        F.round(both, 4).alias("sentiment_score"),
        label(both).alias("sentiment_label"),
    )


def with_external_sentiment(
    df: DataFrame, scorer: Callable[[Column], Column], title: str = "title", body: str = "body"
) -> DataFrame:
    """Scores from a caller's scorer, text column to score column: column functions, or a
    vectorised scorer as ``pandas_udf(scorer, "double")``.  Blank text is neutral."""
    text = joined_text(title, body)
    raw = F.when(text == "", F.lit(0.0)).otherwise(scorer(text).cast("double"))
    scored = df.select("*", F.explode(F.array(raw)).alias("raw_score"))
    return scored.withColumns(
        {"sentiment_score": F.round("raw_score", 4), "sentiment_label": label(F.col("raw_score"))}
    ).drop("raw_score")
