"""Sentiment, summaries, answers and classes for text tables, from statistics of the tables themselves.

The scores stand in for a hosted language model and are not comparable with one. Whole texts
are read. Weights are whole millionths, so sums do not depend on the order of rows.
Tokens are lower-case runs of letters; sentences end at . ! ? or a line break.

A table of word statistics meets the texts in two parts. The most frequent words, as many as the session's broadcast threshold
holds for certain, are looked up where the texts are read and summed to one row a text (or sentence) there; only the other words are shuffled.
Texts are known by their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import as_col, ratio, round_half_up
from ..functions.strings import preview
from .layout import broadcast_bytes, dealt, portioned, stored

TOKEN_BREAK = r"[^\p{L}]+"
SENTENCE_BREAK = r"[.!?\n]+"
MICRO = 1_000_000
GAIN = 4.0
#: A broadcast word has at most so many characters. Its row takes at most so many bytes besides the word, as key and as value, and eight for each value.
HOT_LENGTH, HOT_ROW = 64, 128


def token_array(text: Column | str) -> Column:
    return F.array_remove(F.split(F.lower(as_col(text)), TOKEN_BREAK), "")


def _micro(x: Column) -> Column:
    return F.floor(x * F.lit(float(MICRO)) + F.lit(0.5)).cast("bigint")


def token_weights(docs: DataFrame, labels: DataFrame, positive: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log-odds of each token between positive and other labelled texts, with add-one smoothing, and how often it stands in them."""
    marks = labels.select(id, positive.alias("_p"))
    counts = (
        dealt(docs.select(id, text), id).join(marks, id)
        .select("_p", F.explode(token_array(text)).alias("token"))
        .groupBy("token")
        .agg(F.count_if("_p").alias("p"), F.count_if(~F.col("_p")).alias("q"))
    )
    counts = stored(counts, "token-counts")
    total = counts.select(
        F.struct(F.sum("p").alias("p"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("v"))
    ).scalar()
    share = lambda side: F.ln((F.col(side) + 1).cast("double") / (F.col(f"_t.{side}") + F.col("_t.v")).cast("double"))
    return counts.withColumn("_t", total).select("token", _micro(share("p") - share("q")).alias("weight"), (F.col("p") + F.col("q")).alias("n"))


def _split_words(words: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The most frequent words of a table (token, n, ...), as many as may be broadcast, and the others."""
    room = broadcast_bytes(words) if "n" in words.columns else 0
    if room < HOT_ROW:
        return None, words
    # The least count that no more bytes of words reach than there is room for. One row for each count.
    short = F.length("token") <= HOT_LENGTH
    upto = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0)
    taken = 2 * F.octet_length("token") + HOT_ROW + 8 * (len(words.columns) - 2)
    counts = words.where(short).groupBy("n").agg(F.sum(taken).alias("_k")).withColumn("_k", F.sum("_k").over(upto))
    least = F.coalesce(counts.where(F.col("_k") <= room).agg(F.min("n")).scalar(), F.lit((1 << 63) - 1))
    hot = short & (F.col("n") >= least)
    return words.where(hot), words.where(~hot)


def word_sums(rows: DataFrame, keys: Sequence[str], words: DataFrame, values: Sequence[str], times: str | None = None) -> DataFrame:
    """Per keys: the number of tokens, how many of them are in ``words``, and for each value the sum of it, ``times`` a column of the row.

    ``rows`` has the keys and one token a row (or NULL, for keys without any). Rows of frequent words become one row for their keys before anything is
    moved. The others meet their words by a join of two plain exchanges, which Spark can split at a hot word, or by a broadcast if they are few. ``words`` is read
    several times and should be cheap to read; with a column n, its counts, the frequent ones are known.
    """
    hot, rest = _split_words(words)
    factor = F.lit(1).cast("bigint") if times is None else F.col(times)
    if hot is None:
        found, own = F.lit(False), {v: F.lit(None).cast("bigint") for v in values}
    else:
        table = hot.select(F.col("token").alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values])
        rows = rows.join(F.broadcast(table), F.col("token") == F.col("_hot"), "left")
        found, own = F.col("_hot").isNotNull(), {v: F.col(f"_hot_{v}") for v in values}
    one = rows.groupBy(*keys, F.when(~found, F.col("token")).alias("_rare")).agg(
        F.count("token").alias("_tokens"), F.count_if(found).alias("_known"), F.sum(factor).alias("_times"),
        *[F.sum(F.when(found, factor * own[v])).alias(f"_own_{v}") for v in values],
    )
    # No token has a blank, so rows without a rare word match nothing, and they don't all go to the task of NULL.
    nothing = F.concat(F.lit(" "), F.pmod(F.xxhash64(*keys), F.lit(1 << 16)).cast("string"))
    met = one.withColumn("token", F.coalesce("_rare", nothing)).join(rest, "token", "left")
    value = lambda v: F.coalesce(f"_own_{v}", F.lit(0)) + F.coalesce(F.col("_times") * F.col(v), F.lit(0))
    known = F.col("_known") + F.when(F.col(values[0]).isNotNull(), F.col("_tokens")).otherwise(0)
    return met.groupBy(*keys).agg(
        F.sum("_tokens").alias("tokens"), F.sum(known).alias("known"), *[F.sum(value(v)).alias(v) for v in values]
    )


def _tokens(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, token); a text without tokens gives one row with a NULL token."""
    return portioned(docs.select(id, text), id).select(id, F.explode_outer(token_array(text)).alias("token"))


def sentiment(docs: DataFrame, weights: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, sentiment) from -1 to +1: tanh of the mean weight of the known tokens, 0 where none is known."""
    sums = word_sums(_tokens(docs, id, text), [id], weights, ["weight"])
    score = F.tanh(ratio("weight", "known") / F.lit(float(MICRO)) * F.lit(GAIN))
    return sums.select(id, F.coalesce(score, F.lit(0.0)).alias("sentiment"))


def mean_sentiment(scored: DataFrame, group: str) -> DataFrame:
    """Texts and mean score per group."""
    m = F.sum(_micro(F.col("sentiment")))
    return scored.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_reviews"),
        round_half_up(ratio(m, F.count(F.lit(1))) / F.lit(float(MICRO)), 3).alias("avg_sentiment"),
    )


def sentiment_label(score: Column | str, limit: float = 0.3) -> Column:
    s = as_col(score)
    return F.when(s > limit, F.lit("POSITIVE")).when(s < -limit, F.lit("NEGATIVE")).otherwise(F.lit("NEUTRAL"))


def labelled_preview(docs: DataFrame, scored: DataFrame, id: str = "doc_id", text: str = "text", width: int = 50) -> DataFrame:
    """Start of the text, rounded score and label."""
    return docs.join(scored, id).select(
        id, preview(text, width).alias("preview"),
        round_half_up("sentiment", 3).alias("sentiment_score"),
        sentiment_label("sentiment").alias("sentiment_label"),
    )


def summarize(rows: DataFrame, group: str, order: str | None, text: str, k: int = 2) -> DataFrame:
    """The k sentences of each group with the highest mean tf-idf, in their original order; NULL for a group without words.

    ``rows`` holds one text per (group, order); with ``order=None`` one text per group. NULL is a group, and a place in the order, of its own. The texts of a
    group are never gathered: sentences are scored as rows, pruned to k per task before the final
    ranking, and only the chosen ones are read back.
    """
    # In a struct, NULL equals NULL.
    texts = rows.select(
        F.struct(F.col(group).alias("v")).alias("_g"), F.struct((F.lit(0) if order is None else F.col(order)).alias("v")).alias("_o"), F.col(text).alias("_t")
    )
    keys = ["_g"] if order is None else ["_g", "_o"]  # a constant is no key
    base = portioned(texts, *keys)
    sentences = base.select("_g", "_o", F.posexplode(F.split("_t", SENTENCE_BREAK)).alias("_pos", "_s"))
    tokens = sentences.select("_g", "_o", "_pos", F.explode(token_array("_s")).alias("token"))
    # One row per (text, word) with the sentences it stands in: never longer than the text itself.
    places = tokens.groupBy("_g", "_o", "token").agg(F.collect_list("_pos").alias("_p"))
    if order is None:
        tf = places.withColumn("_tf", F.size("_p").cast("bigint"))
        df = dealt(texts, "_g").select(F.explode(F.array_distinct(token_array("_t"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    else:
        per_group = stored(tokens.groupBy("_g", "token").agg(F.count(F.lit(1)).alias("_tf")), "term-counts")
        tf = places.join(per_group, ["_g", "token"])
        df = per_group.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    total = texts.select(F.count_distinct("_g")).scalar()
    idf = df.withColumn("_n", total).select(
        "token", _micro(F.ln((F.col("_n") + 1).cast("double") / (F.col("n") + 1).cast("double")) + F.lit(1.0)).alias("idf"), "n"
    )
    words = tf.select("_g", "_o", "token", "_tf", F.explode("_p").alias("_pos"))
    scores = word_sums(words, ["_g", "_o", "_pos"], stored(idf, "idf"), ["idf"], "_tf").select("_g", "_o", "_pos", ratio("idf", "tokens").alias("_score"))
    w = W.partitionBy("_g").orderBy(F.desc("_score"), "_o", "_pos")
    chosen = scores.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).select("_g", "_o", "_pos")
    # At most k rows a group. Stored, so that the joins above are planned by themselves.
    chosen = stored(chosen, "chosen")
    back = base.join(chosen.drop("_o") if order is None else chosen, keys).select(
        "_g", "_o", "_pos", F.trim(F.element_at(F.split("_t", SENTENCE_BREAK), F.col("_pos") + 1)).alias("_s")
    )
    parts = F.array_sort(F.collect_list(F.struct("_o", "_pos", "_s")))
    found = back.groupBy("_g").agg(F.concat_ws(". ", F.transform(parts, lambda p: p["_s"])).alias("summary"))
    return texts.select("_g").distinct().join(found, "_g", "left").select(F.col("_g.v").alias(group), "summary")


def extract_answers(
    docs: DataFrame, questions: DataFrame, id: str = "doc_id", text: str = "text", question_id: str = "question_id",
    question: str = "question", corpus: DataFrame | None = None, unanswered: bool = True,
) -> DataFrame:
    """Per text and question, the sentence that shares the most informative words with the question; the earliest wins a tie.

    Words are weighed by the texts of ``corpus`` (by default the same texts) that hold them, counted for the words of the
    questions only. The questions are an inverted index, from word to questions; sentences meet it by their words, so a text is
    scored only for questions that share a word with it that not every text holds. By default the other pairs follow, with a NULL answer and score 0;
    without ``unanswered`` the work and the result follow the pairs that share a word.
    """
    corpus = docs if corpus is None else corpus
    asked = questions.select(F.col(question_id).alias("_q"), F.explode(F.array_distinct(token_array(question))).alias("token"))
    asked = stored(asked.distinct(), "asked")  # so that Spark knows how many words there are
    texts = dealt(corpus.select(id, text), id)
    held = texts.select(F.explode(F.array_distinct(token_array(text))).alias("token")).join(asked.select("token").distinct(), "token", "left_semi")
    df = held.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    total = corpus.select(F.count(F.lit(1))).scalar()
    weight = _micro(F.ln((F.col("_n") + 1).cast("double") / (F.col("_df") + 1).cast("double")))
    index = stored(asked.join(df, "token").withColumn("_n", total).select("token", "_q", weight.alias("_w")).where("_w > 0"), "question-index")

    # In a struct, NULL equals NULL.
    own = dealt(docs.select(F.struct(F.col(id).alias("v")).alias("_id"), F.col(text).alias("_t")), "_id")
    sentences = own.select("_id", F.posexplode(F.split("_t", SENTENCE_BREAK)).alias("_pos", "_s"))
    words = sentences.select("_id", "_pos", F.explode(F.array_distinct(token_array("_s"))).alias("token"))
    scored = words.join(index, "token").groupBy("_id", "_q", "_pos").agg(F.sum("_w").alias("_score"))
    best = scored.groupBy("_id", "_q").agg(F.max(F.struct(F.col("_score").alias("score"), (-F.col("_pos")).alias("back"))).alias("_b"))
    # A list for each text of what was found in it, to read each text back once.
    by_text = best.groupBy("_id").agg(F.collect_list(F.struct("_q", "_b")).alias("_found"))
    answers = own.join(by_text, "_id").select("_id", F.split("_t", SENTENCE_BREAK).alias("_s"), F.inline("_found")).select(
        "_id", "_q", F.trim(F.element_at("_s", 1 - F.col("_b.back"))).alias("answer"), F.col("_b.score").alias("score")
    )
    if unanswered:
        # Ids only: the list of questions beside each text.
        every = questions.select(F.collect_set(question_id)).scalar()
        pairs = docs.select(F.struct(F.col(id).alias("v")).alias("_id"), F.explode(every).alias("_q"))
        answers = pairs.join(answers, ["_id", "_q"], "left").withColumn("score", F.coalesce("score", F.lit(0)))
    return answers.select(F.col("_id.v").alias(id), F.col("_q").alias(question_id), "answer", "score")


def extract_answer(docs: DataFrame, question: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``extract_answers`` for one question: id, answer, score."""
    asked = docs.sparkSession.range(1).select(F.lit(0).alias("question_id"), F.lit(question).alias("question"))
    return extract_answers(docs, asked, id, text).drop("question_id")


def fit_text_classes(
    docs: DataFrame, labels: DataFrame, class_of: Column, classes: Sequence[str], id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Multinomial naive Bayes as two frames: weight per (token, class), and one row of class priors."""
    marks = labels.select(id, class_of.alias("_c"))
    counts = (
        dealt(docs.select(id, text), id).join(marks, id)
        .select("_c", F.explode(token_array(text)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_c") == c).alias(f"c{i}") for i, c in enumerate(classes)])
    )
    counts = stored(counts, "class-counts")
    total = counts.select(
        F.struct(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(classes))])
    ).scalar()
    weights = counts.withColumn("_t", total).select(
        "token",
        *[
            _micro(F.ln((F.col(f"c{i}") + 1).cast("double") / (F.col(f"_t.c{i}") + F.col("_t.v")).cast("double"))).alias(f"w{i}")
            for i in range(len(classes))
        ],
        "n",
    )
    n = F.count(F.lit(1))
    priors = marks.agg(
        *[
            _micro(F.ln((F.count_if(F.col("_c") == c) + 1).cast("double") / (n + len(classes)).cast("double"))).alias(f"p{i}")
            for i, c in enumerate(classes)
        ]
    )
    return weights, priors


def classify_text(
    docs: DataFrame, model: tuple[DataFrame, DataFrame], classes: Sequence[str], id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The most likely of the given classes per text; words never seen in training are skipped, and the first class wins a tie."""
    weights, priors = model
    names = [f"w{i}" for i in range(len(classes))]
    sums = word_sums(_tokens(docs, id, text), [id], weights, names).select(id, *[F.col(w).alias(f"s{i}") for i, w in enumerate(names)])
    prior = priors.select(F.struct(*priors.columns)).scalar()
    scored = sums.withColumn("_p", prior).select(
        id, *[(F.col(f"s{i}") + F.col(f"_p.p{i}")).alias(f"s{i}") for i in range(len(classes))]
    )
    best = F.greatest(*[F.col(f"s{i}") for i in range(len(classes))])
    label = None
    for i, c in enumerate(classes):
        hit = F.col(f"s{i}") == best
        label = F.when(hit, F.lit(c)) if label is None else label.when(hit, F.lit(c))
    return scored.select(id, label.alias("classification"))
