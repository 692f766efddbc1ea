"""Token tables over a corpus: n-grams, shares, document weights, stopwords.

Tokens are counted first and filtered afterwards: after the map-side combine there is one row per
distinct token, so neither very common tokens nor very long documents load a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsdesk.functions import arrays as ar
from newsdesk.functions import text as tx
from newsdesk.operators.joins import join_unique
from newsdesk.operators.ranking import cap_per_group, topk

# Sizes of the charts these tables feed, the word classes that carry content; and
# the longest stopword list that is put into an expression.
TOP_NGRAMS = 400
CLOUD_WORDS = 100
CLOUD_SIZE = 100
STOP_LITERALS = 1000
CONTENT_CLASSES = ("名詞", "形容詞", "動詞")


def lines_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row per line of every document, trailing white space removed."""
    long = docs.select(doc, F.posexplode(tx.lines(F.col(text))).alias("line_no", "stream"))
    return long.withColumn("stream", tx.rstrip(F.col("stream")))


def content_lines(docs: DataFrame, doc: str, text: str, marker: str) -> DataFrame:
    """Lines that are neither empty nor marked.

    Emptiness is judged on the raw line, so a line of blanks stays (as an empty string).
    """
    long = docs.select(doc, F.posexplode(tx.lines(F.col(text))).alias("line_no", "stream"))
    kept = long.filter(tx.is_content_line(F.col("stream"), marker))
    return kept.withColumn("stream", tx.rstrip(F.col("stream")))


def split_tokens(docs: DataFrame, text: str, out: str = "words") -> DataFrame:
    return docs.withColumn(out, tx.tokens(F.col(text)))


def apply_tokenizer(make: Callable[[], Callable[[str], list[str]]]) -> Callable[[Column], Column]:
    """Column function from a tokenizer factory; the tokenizer is made once per worker task."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = make()
        for batch in batches:
            yield batch.map(lambda text: None if text is None else list(tokenizer(text)))

    return tokenize


def pos_filter(tagged: DataFrame, word_class: str = "pos", keep: Iterable[str] = CONTENT_CLASSES) -> DataFrame:
    """Tokens of the content word classes."""
    return tagged.filter(F.col(word_class).isin(*keep))


def anti_join_stopwords(counts: DataFrame, stopwords: DataFrame, token: str = "token") -> DataFrame:
    """Token rows without the stopwords (one column)."""
    return counts.join(stopwords.toDF(token), token, "left_anti")


def token_counts(docs: DataFrame, words: str = "words", group: Iterable[str] = ()) -> DataFrame:
    group = list(group)
    tokens = ar.item_rows(docs, words, *group, item="token")
    return tokens.groupBy(*group, "token").agg(F.count("*").alias("n"))


def without_stopwords(
    docs: DataFrame, doc: str, words: str, stopwords: DataFrame, literals: int = STOP_LITERALS
) -> DataFrame:
    """(doc, words) with the stopwords taken out and the order kept.

    A list of at most `literals` words is put into the expression and nothing moves; a longer
    one is joined to the tokens, which then go back into order per document.
    """
    listed = [r[0] for r in stopwords.toDF("token").distinct().limit(literals + 1).collect()]
    if len(listed) <= literals:
        return docs.select(doc, F.filter(words, lambda t: ~t.isin(listed)).alias(words))
    long = ar.item_rows(docs, words, doc, item="token", pos="pos")
    kept = join_unique(long, stopwords.toDF("token").distinct(), "token", "left_anti", narrow=True)
    ordered = kept.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("t"))
    # A document left without words stays, as an empty list.
    both = docs.select(doc, F.col(words).isNotNull().alias("_given")).join(ordered, doc, "left")
    empty = F.when(F.col("_given"), F.array().cast("array<string>"))
    return both.select(doc, F.coalesce("t.token", empty).alias(words))


def ngram_count(
    docs: DataFrame, words: str = "words", n: int = 1, stopwords: DataFrame | None = None, doc: str | None = None
) -> DataFrame:
    """Counts of token n-grams; stopwords are taken out before n-grams are formed.

    `doc` (a unique document id) is needed only for n > 1 together with stopwords.
    """
    if n == 1:
        counts = token_counts(docs, words)
        return counts if stopwords is None else anti_join_stopwords(counts, stopwords)
    if stopwords is not None:
        if doc is None:
            raise ValueError("n-grams behind stopwords need a document id")
        docs = without_stopwords(docs, doc, words, stopwords)
    return token_counts(docs.select(tx.ngrams(F.col(words), n).alias("words")))


def top_ngrams(counts: DataFrame, k: int = TOP_NGRAMS) -> DataFrame:
    return topk(counts, k)


def treemap_share(counts: DataFrame, k: int = TOP_NGRAMS) -> DataFrame:
    """The `k` most frequent n-grams with their share of the area (the window spans `k` rows)."""
    best = topk(counts, k)
    return best.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def wordcloud_weight(
    docs: DataFrame,
    words: str = "words",
    group: Iterable[str] = (),
    stopwords: DataFrame | None = None,
    max_words: int = CLOUD_WORDS,
    max_size: int = CLOUD_SIZE,
) -> DataFrame:
    """The most frequent tokens of every group with a size relative to the group's top token."""
    group = list(group)
    counts = token_counts(docs, words, group)
    if stopwords is not None:
        counts = anti_join_stopwords(counts, stopwords)
    best = cap_per_group(counts, group, [F.desc("n"), "token"], max_words, rank="rank")
    largest = F.max("n").over(W.partitionBy(*group))
    return best.withColumn("size", F.col("n") / largest * max_size)


def frequency_stopwords(counts: DataFrame, top_n: int = 0, min_freq: int = 0) -> DataFrame:
    """Tokens among the `top_n` most frequent or seen at most `min_freq` times."""
    rare = counts.filter(F.col("n") <= min_freq)
    return topk(counts, top_n).unionByName(rare).select("token").distinct()
