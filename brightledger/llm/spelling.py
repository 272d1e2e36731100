"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

Two words are near if they differ by exactly one inserted, deleted or replaced character. They are found by blocked Gram matrices: a word is the vector of its
letter counts; the squared distance of two vectors is |a|^2 + |b|^2 - 2ab, and all distances of two blocks of words are one matrix
product (each vector has its square and a one as two more elements). One edit changes at most two counts by one, so near words have a squared distance of two at most; pairs that have it are compared letter by letter.

Words of one length form a group, as an edit changes the length by one at most. It also changes the number of letters of one fixed half of the
characters by one at most, so groups are split by that number as well, and a group meets itself and three neighbours. A group is cut into blocks of about ``BLOCK`` words by a hash; a pair
of blocks is one row of a Spark table and one matrix product, so work is dealt evenly however many words a group has. Only near pairs leave a block.

The form of a word is its near word with the largest count (ties: the first in order of code points), if that count is ``ratio`` times its own at least.
The root follows forms to the end; counts grow by the ratio with each step, so there are no circles, and pointer doubling needs few rounds.

Defined cases: a null word is passed over; an empty table gives an empty result; a null text has no words. Words must be distinct: ``vocabulary`` makes them so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, text_or_empty

LETTERS = r"[A-Za-zÀ-ÿ]+"
BLOCK, BLOCK_CHARS = 2048, 1 << 20
RATIO = 5
#: Shorter words have no variants.
LENGTH = 6
#: Characters meet in so many counts; that two share one only lowers a distance.
DIMENSIONS = 32
#: Pairs compared letter by letter at a time.
_COMPARED = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A fixed half of the letters.
_HALF = "[a-iA-I\\u00E0-\\u00EF]"

NEAR = "word string, other string, other_n bigint"
_NEAR_TYPES = pa.schema([("word", pa.string()), ("other", pa.string()), ("other_n", pa.int64())])


def occurrences(docs: DataFrame, least_length: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run) for each maximal run of letters of every whole text that has the least length, A-Z lower-cased."""
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(LETTERS), F.lit(0))
    long = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("run")).where(F.length("run") >= least_length)
    return long.withColumn("run", F.translate("run", _UPPER, _LOWER))


def misspelt(runs: DataFrame, every: int = 199) -> DataFrame:
    """The runs, of which about one in ``every`` has lost a character: h = crc32 of ``doc_id:run``; if ``every`` divides h, the character h % length is left out."""
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("run", F.when(h % every == 0, less).otherwise(F.col("run")))


def vocabulary(runs: DataFrame, least_length: int = LENGTH, least_count: int = 5) -> DataFrame:
    """(word, n): the distinct runs that are long and frequent enough. Counted on the map side first."""
    return runs.where(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _codes(block: pa.StringArray) -> np.ndarray:
    """The code points of words of one length, a row for each."""
    return np.frombuffer("".join(block.to_pylist()).encode("utf-32-le"), np.uint32).reshape(len(block), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each character (modulo DIMENSIONS) stands in each word."""
    n = len(codes)
    flat = codes % DIMENSIONS + DIMENSIONS * np.arange(n, dtype=np.int64)[:, None]
    return np.bincount(flat.reshape(-1), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced character or, if b is one longer, one inserted one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= a.shape[1]


def near_pairs(a: pa.StringArray, b: pa.StringArray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b of words that are near; words within an array have one length, those of b the same or one more. No b: a with itself, each pair once."""
    x = _codes(a)
    y = x if b is None else _codes(b)
    u = letter_counts(x)
    v = u if b is None else letter_counts(y)
    one = lambda m: np.ones((len(m), 1), np.float32)
    square = lambda m: (m * m).sum(1, keepdims=True)
    left, right = np.hstack([-2 * u, square(u), one(u)]), np.hstack([v, one(v), square(v)]).T
    # Some hundred rows of the product at a time.
    step = max(1, (1 << 18) // len(y))
    for low in range(0, len(x), step):
        distance = left[low : low + step] @ right
        i, j = np.divmod(np.flatnonzero(distance < 2.5), len(y))
        i += low
        if b is None:
            i, j = i[i < j], j[i < j]
        size = max(1, _COMPARED * 8 // y.shape[1])
        for k in range(0, len(i), size):
            hit = one_edit(x[i[k : k + size]], y[j[k : k + size]])
            if hit.any():
                yield i[k : k + size][hit], j[k : k + size][hit]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks to their near words, each pair in both directions."""
    for batch in batches:
        for k in range(batch.num_rows):
            first, second = (batch.column(c)[k].values for c in ("a", "b"))
            other = first if second is None else second
            word, n, word_b, m = first.field("word"), first.field("n"), other.field("word"), other.field("n")
            for i, j in near_pairs(word, None if second is None else word_b):
                a, b = word.take(pa.array(i)), word_b.take(pa.array(j))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([a, b]).cast(pa.string()), pa.concat_arrays([b, a]).cast(pa.string()),
                        pa.concat_arrays([m.take(pa.array(j)), n.take(pa.array(i))]),
                    ],
                    schema=_NEAR_TYPES,
                )


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, other, other_n) for each ordered pair of near words of a table (word, n) of distinct words."""
    half = F.length("word") - F.length(F.regexp_replace("word", _HALF, ""))
    grouped = words.where("word is not null").select("word", "n", F.length("word").alias("len"), half.alias("half"))
    # Each group with its number of blocks, from its number of words and of characters.
    rows = F.count(F.lit(1))
    sizes = settle(
        grouped.groupBy("len", "half").agg(
            F.greatest(F.ceil(rows / block), F.ceil(rows * F.col("len") / BLOCK_CHARS), F.lit(1)).cast("int").alias("blocks")
        ),
        "groups",
    )
    blocks = settle(
        grouped.join(sizes, ["len", "half"])
        .withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
        .groupBy("len", "half", "block")
        .agg(F.collect_list(F.struct("word", "n")).alias("words")),
        "blocks",
    )
    # Which blocks meet: those of a group among themselves, and all of them those of three neighbouring groups. Rows of numbers only.
    steps = [(0, 0), (0, 1), (1, 0), (1, 1)]
    to = F.explode(F.array(*[F.struct(F.lit(d).alias("l"), F.lit(h).alias("h")) for d, h in steps])).alias("to")
    asked = blocks.select("len", "half", "block", to).select(
        F.col("len").alias("len_a"), F.col("half").alias("half_a"), F.col("block").alias("block_a"),
        (F.col("len") + F.col("to.l")).alias("len"), (F.col("half") + F.col("to.h")).alias("half"),
    )
    own = (F.col("len") == F.col("len_a")) & (F.col("half") == F.col("half_a"))
    met = (
        asked.join(sizes, ["len", "half"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .where(~own | (F.col("block") >= F.col("block_a")))
        .withColumn("itself", own & (F.col("block") == F.col("block_a")))
    )
    first = blocks.select(F.col("len").alias("len_a"), F.col("half").alias("half_a"), F.col("block").alias("block_a"), F.col("words").alias("a"))
    pairs = met.join(first, ["len_a", "half_a", "block_a"]).join(blocks.withColumnRenamed("words", "b"), ["len", "half", "block"])
    # A pair of blocks is some hundred milliseconds of work, so rows are dealt one by one.
    dealt = pairs.select("a", F.when(~F.col("itself"), F.col("b")).alias("b")).repartition(F.xxhash64(F.col("a")[0]["word"], F.col("b")[0]["word"]))
    return dealt.mapInArrow(_compare, NEAR)


def group(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """One row per word of a table (word, n): word, n, n_near, form, form_n, root."""
    words = settle(words, "vocabulary")
    near = near_words(words, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    formed = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # A chain has at most log(largest count) / log(ratio) steps; each round doubles the steps that a pointer covers.
    largest = formed.agg(F.max("form_n")).first()[0] or 0
    longest = math.ceil(math.log(max(largest, 1), max(2, ratio))) + 1 if largest else 0
    to = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, longest - 1).bit_length()):
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = settle(to.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return formed.join(to, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
