"""Text columns: trimming, splitting, tokens, labels and sentinels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as general-purpose text tools see it (ideographic space
# and the four information separators included), and the engine marks.
SPACE = r"(?U)[\s\x1c-\x1f]"
ENGINE_MARKS = {"google": "G翻訳", "deepl": "Deepl翻訳"}
WORD_PATTERN = r"\p{L}+"
SCRIPT_PATTERN = (
    r"[\p{IsHan}々]+|[\p{IsKatakana}ー]+|\p{IsHiragana}+"
    r"|[\p{L}\p{M}&&[^\p{IsHan}\p{IsKatakana}\p{IsHiragana}ー々]]+"
)


def rstrip(c: Column) -> Column:
    """Drop trailing white space of any script."""
    return F.regexp_replace(c, SPACE + "+$", "")


def strip(c: Column) -> Column:
    """Drop leading and trailing white space of any script."""
    return F.regexp_replace(rstrip(c), "^" + SPACE + "+", "")


def trim_nonempty(items: Column) -> Column:
    """Trim every item of an array and drop the empty ones."""
    return F.filter(F.transform(items, strip), lambda s: s != "")


def lines(c: Column, at: str = r"\r\n|\n|\r") -> Column:
    """Array of the lines of a text; a closing line break adds no empty line."""
    return F.split(F.regexp_replace(c, f"({at})\\z", ""), at)


def is_content_line(line: Column, marker: str) -> Column:
    """True for lines that are not empty and do not carry the annotation marker."""
    return ~line.contains(marker) & (line != "")


def strip_trailing_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[0-9]+$", "")


def headline_summary(c: Column) -> Column:
    """Struct of the first word (headline) and the second (summary; the first where it is alone).

    Only the head of the text is split, so long card texts cost nothing extra.
    """
    head = F.split(F.regexp_replace(c, "^" + SPACE + "+", ""), SPACE + "+", 3)
    first = F.nullif(F.get(head, F.lit(0)), F.lit(""))
    second = F.nullif(F.get(head, F.lit(1)), F.lit(""))
    return F.struct(
        first.alias("headline"),
        strip_trailing_digits(F.coalesce(second, first)).alias("summary"),
    )


def without_commas(c: Column) -> Column:
    return F.translate(c, ",", " ")


def heading(rank: Column, word: Column) -> Column:
    return F.concat(rank.cast("string"), F.lit(" : "), word)


def or_blank(c: Column) -> Column:
    """A missing field is published as one blank."""
    return F.coalesce(c, F.lit(" "))


def or_zero_text(c: Column) -> Column:
    """A missing date or author is exported as `0`; inside the tables it stays NULL."""
    return F.coalesce(c.cast("string"), F.lit("0"))


def post_type(text: Column) -> Column:
    return (
        F.when(text.startswith("RT"), F.lit("Retweet"))
        .when(text.startswith("@"), F.lit("Reply"))
        .otherwise(F.lit("Tweet"))
    )


def tokens(c: Column) -> Column:
    """Lower-case letter runs of a text."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), F.lit(0))


def script_tokens(c: Column) -> Column:
    """Runs of one script each: the built-in splitter for text written without blanks."""
    return F.regexp_extract_all(F.lower(c), F.lit(SCRIPT_PATTERN), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Array of the n-grams of a token array, each joined by blanks."""
    if n == 1:
        return words
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    # Single items are read in constant time; a slice would copy the whole array for each n-gram.
    grams = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def token_repeat(word: Column, rank: Column, top: int = 21) -> Column:
    """The word repeated `top - rank` times: the token bag one ranked cell stands for."""
    return F.array_repeat(word, F.greatest(F.lit(top) - rank, F.lit(0)).cast("int"))


def tag_rank(tag: Column, position: Column) -> Column:
    """Rank of a tag at a zero-based position; date tags (with `@`) always rank 99."""
    return F.when(tag.contains("@"), F.lit(99)).otherwise(position + 1)


def engine_name(c: Column) -> Column:
    """Engine setting to one of the known engines, else `none`."""
    return F.when(c.isin(*ENGINE_MARKS), c).otherwise(F.lit("none"))


def translated_suffix(engine: Column, translated: Column) -> Column:
    """The text put behind a word once translated; a blank where no engine is active."""
    out = F.lit(" ")
    for name, mark in ENGINE_MARKS.items():
        out = F.when(engine == name, F.concat(F.lit(f"\n [{mark}] "), translated)).otherwise(out)
    return out
