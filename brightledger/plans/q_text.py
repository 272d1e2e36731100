"""Text queries over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import round_half_up
from ..operators import text as X
from ..operators.layout import stored
from .registry import query
from .relations import sql_r

TOK = r"regexp_split_to_array(lower({t}), '[^\p{{L}}]+')"
SENT = r"regexp_split_to_array({t}, '[.!?\n]+')"
MICRO = "CAST(floor(({x}) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"

POSITIVE_SQL = "quality = 1 AND toxic = 0"

# Weights and scores of every document, as common table expressions ending in ``scored``.
SCORED = f"""
  marks AS (SELECT doc_id, {POSITIVE_SQL} AS pos FROM labels),
  words AS (SELECT doc_id, UNNEST({TOK.format(t='text')}) AS token FROM documents),
  tok AS (SELECT doc_id, token, COUNT(*) AS n FROM words WHERE token <> '' GROUP BY 1, 2),
  counts AS (SELECT token, SUM(CASE WHEN pos THEN n ELSE 0 END) AS p, SUM(CASE WHEN NOT pos THEN n ELSE 0 END) AS q
    FROM tok JOIN marks USING (doc_id) GROUP BY 1),
  totals AS (SELECT SUM(p) AS tp, SUM(q) AS tq, COUNT(*) AS v FROM counts),
  weights AS (SELECT token, {MICRO.format(x="ln(CAST(p + 1 AS DOUBLE) / CAST(tp + v AS DOUBLE)) - ln(CAST(q + 1 AS DOUBLE) / CAST(tq + v AS DOUBLE))")} AS weight
    FROM counts CROSS JOIN totals),
  sums AS (SELECT doc_id, SUM(n * weight) AS s, SUM(n) AS n FROM tok JOIN weights USING (token) GROUP BY 1),
  scored AS (SELECT doc_id, source, text, COALESCE(tanh(CAST(s AS DOUBLE) / CAST(n AS DOUBLE) / CAST(1000000 AS DOUBLE) * CAST(4 AS DOUBLE)), 0) AS sentiment
    FROM documents LEFT JOIN sums USING (doc_id))
"""


def scored(t):
    positive = (F.col("quality") == 1) & (F.col("toxic") == 0)
    docs = t.documents
    return X.sentiment(docs, X.token_weights(docs, t.labels, positive))


query("text_sentiment", f"WITH {SCORED} SELECT doc_id, {sql_r('sentiment', 3)} AS sentiment FROM scored")(
    lambda t: scored(t).select("doc_id", round_half_up("sentiment", 3).alias("sentiment"))
)

query(
    "text_sentiment_avg",
    f"""WITH {SCORED} SELECT source, COUNT(*) AS num_reviews,
          {sql_r(f"CAST(SUM({MICRO.format(x='sentiment')}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) / CAST(1000000 AS DOUBLE)", 3)} AS avg_sentiment
        FROM scored GROUP BY 1""",
)(lambda t: X.mean_sentiment(scored(t).join(t.documents.select("doc_id", "source"), "doc_id"), "source"))

query(
    "text_sentiment_label",
    f"""WITH {SCORED} SELECT doc_id, left(text, 50) || '...' AS preview, {sql_r('sentiment', 3)} AS sentiment_score,
          CASE WHEN sentiment > 0.3 THEN 'POSITIVE' WHEN sentiment < -0.3 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment_label FROM scored""",
)(lambda t: X.labelled_preview(t.documents, scored(t)))


def summary_sql(rows: str, k: int) -> str:
    """The tf-idf summary over ``rows(g, o, t)``."""
    return f"""WITH r AS ({rows}),
      s AS (SELECT g, o, UNNEST(a) AS sentence, UNNEST(generate_series(0, len(a) - 1)) AS pos FROM (SELECT g, o, {SENT.format(t='t')} AS a FROM r)),
      w AS (SELECT * FROM (SELECT g, o, pos, UNNEST({TOK.format(t='sentence')}) AS token FROM s) WHERE token <> ''),
      tf AS (SELECT g, token, COUNT(*) AS tf FROM w GROUP BY 1, 2),
      df AS (SELECT token, COUNT(*) AS df FROM tf GROUP BY 1), total AS (SELECT COUNT(DISTINCT g) AS n FROM r),
      idf AS (SELECT token, {MICRO.format(x="ln(CAST(n + 1 AS DOUBLE) / CAST(df + 1 AS DOUBLE)) + CAST(1 AS DOUBLE)")} AS idf FROM df CROSS JOIN total),
      scores AS (SELECT w.g, w.o, w.pos, CAST(SUM(tf * idf) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS score
        FROM w JOIN tf ON tf.g = w.g AND tf.token = w.token JOIN idf ON idf.token = w.token GROUP BY 1, 2, 3),
      best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY g ORDER BY score DESC, o, pos) <= {k})
      SELECT best.g, string_agg(trim(sentence), '. ' ORDER BY best.o, best.pos) AS summary
      FROM best JOIN s ON s.g = best.g AND s.o = best.o AND s.pos = best.pos GROUP BY 1"""


query(
    "text_summarize",
    f"SELECT doc_id, summary FROM documents LEFT JOIN ({summary_sql('SELECT doc_id AS g, 0 AS o, text AS t FROM documents', 2)}) ON g = doc_id",
)(lambda t: X.summarize(t.documents, "doc_id", None, "text", 2))

query(
    "text_summarize_group",
    f"SELECT conv_id, summary FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN ({summary_sql('SELECT conv_id AS g, turn AS o, text AS t FROM conversations', 3)}) ON g = conv_id",
)(lambda t: X.summarize(t.conversations, "conv_id", "turn", "text", 3))

QUESTIONS = {1: "What was that with the order, and how is it?", 2: "Quand est-ce que la commande, un et des?"}


def _answers_sql(number: int, question: str) -> str:
    words = sorted(set("".join(c if c.isalpha() else " " for c in question.lower()).split()))
    idf = ", ".join(
        MICRO.format(x=f"ln(CAST(COUNT(*) + 1 AS DOUBLE) / CAST(COUNT(CASE WHEN list_contains(tk, '{w}') THEN 1 END) + 1 AS DOUBLE))") + f" AS q{i}"
        for i, w in enumerate(words)
    )
    score = " + ".join(f"CASE WHEN list_contains(tk, '{w}') THEN q{i} ELSE 0 END" for i, w in enumerate(words))
    return f"""SELECT doc_id, {number} AS question_id, CASE WHEN score > 0 THEN answer END AS answer, score FROM (
        SELECT t.doc_id, pos, trim(sentence) AS answer, CAST({score} AS BIGINT) AS score
        FROM t CROSS JOIN (SELECT {idf} FROM (SELECT {TOK.format(t='text')} AS tk FROM documents)))
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1"""


def _answers(t):
    """Two questions, asked of the texts with a negative score; the word weights come from all texts."""
    questions = t.spark.createDataFrame(list(QUESTIONS.items()), "question_id int, question string")
    negative = t.documents.join(stored(scored(t).where("sentiment < 0").select("doc_id"), "negative"), "doc_id", "left_semi")
    return X.extract_answers(negative, questions, corpus=t.documents)


query(
    "text_extract_answer",
    f"""WITH {SCORED}, s AS (SELECT doc_id, UNNEST(a) AS sentence, UNNEST(generate_series(0, len(a) - 1)) AS pos
        FROM (SELECT doc_id, {SENT.format(t='text')} AS a FROM scored WHERE sentiment < 0)),
      t AS (SELECT *, {TOK.format(t='sentence')} AS tk FROM s)
      """
    + " UNION ALL ".join(f"SELECT * FROM ({_answers_sql(n, q)})" for n, q in QUESTIONS.items()),
)(_answers)

CLASSES = ["Positive", "Negative", "Mixed"]
CLASS_SQL = "CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' ELSE 'Mixed' END"


def _classified(t):
    of = F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, "Positive").otherwise("Mixed")
    docs = t.documents
    return X.classify_text(docs, X.fit_text_classes(docs, t.labels, of, CLASSES), CLASSES)


_C = ", ".join(f"SUM(CASE WHEN c = '{c}' THEN n ELSE 0 END) AS c{i}" for i, c in enumerate(CLASSES))
_T = ", ".join(f"SUM(c{i}) AS t{i}" for i in range(3))
_W = ", ".join(MICRO.format(x=f"ln(CAST(c{i} + 1 AS DOUBLE) / CAST(t{i} + v AS DOUBLE))") + f" AS w{i}" for i in range(3))
_P = ", ".join(
    MICRO.format(x=f"ln(CAST(COUNT(CASE WHEN c = '{c}' THEN 1 END) + 1 AS DOUBLE) / CAST(COUNT(*) + 3 AS DOUBLE))") + f" AS p{i}"
    for i, c in enumerate(CLASSES)
)
_S = ", ".join(f"COALESCE(SUM(n * w{i}), 0) AS s{i}" for i in range(3))

query(
    "text_classify",
    f"""WITH words AS (SELECT doc_id, UNNEST({TOK.format(t='text')}) AS token FROM documents),
      tok AS (SELECT doc_id, token, COUNT(*) AS n FROM words WHERE token <> '' GROUP BY 1, 2),
      marks AS (SELECT doc_id, {CLASS_SQL} AS c FROM labels),
      counts AS (SELECT token, {_C} FROM tok JOIN marks USING (doc_id) GROUP BY 1),
      totals AS (SELECT COUNT(*) AS v, {_T} FROM counts), weights AS (SELECT token, {_W} FROM counts CROSS JOIN totals),
      priors AS (SELECT {_P} FROM marks),
      sums AS (SELECT doc_id, {_S} FROM documents LEFT JOIN tok USING (doc_id) LEFT JOIN weights USING (token) GROUP BY 1),
      final AS (SELECT doc_id, s0 + p0 AS a, s1 + p1 AS b, s2 + p2 AS c FROM sums CROSS JOIN priors)
      SELECT doc_id, CASE WHEN a >= b AND a >= c THEN 'Positive' WHEN b >= c THEN 'Negative' ELSE 'Mixed' END AS classification FROM final""",
)(_classified)
