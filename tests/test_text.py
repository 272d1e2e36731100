"""Text operators against plain Python on small tables."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brightledger.operators import text as X

DOCS = [
    (1, "River walk at dawn. Mist on river stones! Calm river", 1),
    (2, "Rain all week; gate was locked.\nLocked out twice", 0),
    (3, "Calm path for families. Stones are smooth", 1),
    (4, "", 0),
    (5, "Æble på bænk, 17 ænder?! Locked was the gate", None),
    (6, "1234 5678", None),
    (7, None, None),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t, _ in DOCS], "doc_id int, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, q) for i, _, q in DOCS if q is not None], "doc_id int, good int")


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def micro(x):
    return math.floor(x * 1e6 + 0.5)


def weights():
    p, q = Counter(), Counter()
    for _, text, good in DOCS:
        if good is not None:
            (p if good else q).update(words(text))
    vocabulary = set(p) | set(q)
    odds = lambda c, w: math.log((c[w] + 1) / (sum(c.values()) + len(vocabulary)))
    return {w: micro(odds(p, w) - odds(q, w)) for w in vocabulary}


def test_tokens(docs):
    got = {r.doc_id: r.t for r in docs.select("doc_id", X.token_array("text").alias("t")).collect()}
    assert got == {i: words(t) if t is not None else None for i, t, _ in DOCS}


def test_sentiment(docs, labels):
    w = X.token_weights(docs, labels, F.col("good") == 1)
    assert {r.token: r.weight for r in w.collect()} == weights()
    got = {r.doc_id: r.sentiment for r in X.sentiment(docs, w).collect()}
    for i, text, _ in DOCS:
        known = [weights()[t] for t in words(text) if t in weights()]
        want = math.tanh(sum(known) / len(known) / 1e6 * X.GAIN) if known else 0.0
        assert got[i] == pytest.approx(want, abs=1e-12)
    assert got[1] > 0 > got[2] and got[4] == 0.0


def best_sentences(rows, k):
    tf = defaultdict(Counter)
    for g, _, text in rows:
        tf[g].update(words(text))
    df = Counter(w for c in tf.values() for w in c)
    n = len({g for g, _, _ in rows})
    idf = {w: micro(math.log((n + 1) / (d + 1)) + 1.0) for w, d in df.items()}
    out = dict.fromkeys(tf)  # NULL for a group without words
    for g in tf:
        scored = []
        for gg, o, text in rows:
            if gg == g:
                for pos, s in enumerate(re.split(r"[.!?\n]+", text or "")):
                    if words(s):
                        scored.append((-sum(tf[g][w] * idf[w] for w in words(s)) / len(words(s)), o, pos, s.strip(" ")))
        if scored:
            out[g] = ". ".join(s for *_, s in sorted(sorted(scored)[:k], key=lambda r: r[1:3]))
    return out


def test_summaries_per_text(docs):
    got = {r.doc_id: r.summary for r in X.summarize(docs, "doc_id", None, "text", 2).collect()}
    assert got == best_sentences([(i, 0, t) for i, t, _ in DOCS], 2)


def test_summaries_per_group(spark):
    rows = [("a", 2, DOCS[0][1]), ("a", 1, DOCS[1][1]), ("b", 1, DOCS[2][1]), ("a", 3, DOCS[4][1]), (None, 1, "No one's words. Here"), ("c", 1, "77")]
    df = spark.createDataFrame(rows, "g string, o int, t string")
    assert {r.g: r.summary for r in X.summarize(df, "g", "o", "t", 3).collect()} == best_sentences(rows, 3)


def test_answers(docs):
    got = {r.doc_id: (r.answer, r.score) for r in X.extract_answer(docs, "Who locked the gate, and was it locked?").collect()}
    assert got[2][0] == "Rain all week; gate was locked" and got[5][0] == "Locked was the gate"
    assert all(got[i] == (None, 0) for i in (1, 3, 4, 6))
    assert got[7][0] is None


def test_classes(docs, labels):
    classes = ["good", "bad"]
    model = X.fit_text_classes(docs, labels, F.when(F.col("good") == 1, "good").otherwise("bad"), classes)
    got = {r.doc_id: r.classification for r in X.classify_text(docs, model, classes).collect()}
    assert got[1] == got[3] == "good" and got[2] == got[5] == "bad"
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}


def test_hot_group_and_hot_word(spark):
    """One group holds most rows and one word stands in every sentence; the result is that of the plain scorer."""
    rows = [("hot" if i % 3 else f"g{i}", i, f"the common word{i % 50}. the the common tail{i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o int, t string").repartition(9)
    assert {r.g: r.summary for r in X.summarize(df, "g", "o", "t", 2).collect()} == best_sentences(rows, 2)


@pytest.mark.parametrize("job", ["sentiment", "classes", "summary", "summary per group"])
def test_the_rows_of_a_hot_word_are_split(spark, job, monkeypatch):
    """A word stands in every text; with statistics too large to broadcast, its rows go to several tasks."""
    rows = [(i, f"g{i % 3}", f"the end{i % 9}. the more" + f" word{i}" * (i % 20 == 0), i % 2) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id int, g string, text string, good int").repartition(8)
    labels = df.select("doc_id", "good")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB", "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in conf}

    def run():
        if job == "sentiment":
            return X.sentiment(df, X.token_weights(df, labels, F.col("good") == 1))
        if job == "classes":
            return X.classify_text(df, X.fit_text_classes(df, labels, F.when(F.col("good") == 1, "a").otherwise("b"), ["a", "b"]), ["a", "b"])
        return X.summarize(df, "doc_id", None, "text") if job == "summary" else X.summarize(df, "g", "doc_id", "text")

    plans = []

    def watched(frame, label):
        rows = frame.collect()
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return spark.createDataFrame(rows, frame.schema)

    want = sorted(map(str, run().collect()))
    monkeypatch.setattr(X, "stored", watched)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = run()
        got = sorted(map(str, out.collect()))
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert got == want
    assert any("skew=true" in p for p in plans)


def test_a_frequent_word_is_looked_up_where_it_is_read(spark, monkeypatch):
    """Words that fit the broadcast threshold are summed before anything is moved; only the others reach the join."""
    text = [(i, f"the end{i % 9}. the more word{i % 40} word{i % 40}a" + " longword" * (i % 3)) for i in range(400)]
    df = spark.createDataFrame(text, "doc_id int, text string").repartition(4)
    counts = Counter(w for _, t in text for w in words(t))
    table = spark.createDataFrame([(w, n, len(w) * 7 - 20) for w, n in counts.items()], "token string, n long, weight long")
    tokens = X._tokens(df, "doc_id", "text")
    want = sorted(map(tuple, X.word_sums(tokens, ["doc_id"], table.drop("n"), ["weight"]).collect()))
    for rows in (0, 1, 3, len(counts) + 5):
        monkeypatch.setattr(X, "broadcast_bytes", lambda df, rows=rows: rows * X.HOT_ROW)
        hot, rest = X._split_words(table)
        held = set() if hot is None else {r.token for r in hot.collect()}
        assert len(held) <= rows and held | {r.token for r in rest.collect()} == set(counts) and rest.count() + len(held) == len(counts)
        assert min((counts[w] for w in held), default=10**9) > max((counts[w] for w in set(counts) - held), default=0)
        out = X.word_sums(tokens, ["doc_id"], table, ["weight"])
        assert sorted(map(tuple, out.collect())) == want
    assert [(t, k) for _, t, k, _ in want] == [(len(words(t)), len(words(t))) for _, t in sorted(text)]


def test_ten_thousand_questions(spark):
    """An inverted index: no texts beside questions, and only pairs that share a word are made."""
    texts = [(i, f"alpha{chr(97 + i % 26)} beta. Gamma{chr(97 + i % 7)} delta\nbeta beta omega") for i in range(60)]
    asked = [(q, f"what is gamma{chr(97 + q % 20)} or psi{q}?") for q in range(10_000)]
    docs, questions = spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(asked, "question_id int, question string")
    out = X.extract_answers(docs, questions, unanswered=False)
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = {(r.doc_id, r.question_id): r.answer for r in out.collect()}
    assert got == {(i, q): f"Gamma{chr(97 + i % 7)} delta" for i, _ in texts for q, _ in asked if i % 7 == q % 20}
    few = questions.where("question_id < 30")
    every = X.extract_answers(docs, few).collect()
    assert len(every) == 60 * 30 and {(r.doc_id, r.question_id) for r in every if r.answer} == {k for k in got if k[1] < 30}
    assert all((r.answer is None) == (r.score == 0) for r in every)


def test_large_tables_of_texts_are_dealt_into_portions(spark, tmp_path, monkeypatch):
    """The words of a task stay within a bound: a large table is dealt into portions by its size, which AQE doesn't merge."""
    from brightledger.operators import layout

    texts = [(i, f"alpha{i % 13} beta. gamma delta{i % 7}\nbeta omega") for i in range(4000)]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    df.write.parquet(f"{tmp_path}/texts")
    df = spark.read.parquet(f"{tmp_path}/texts")
    want = sorted(map(str, X.summarize(df, "doc_id", None, "text").collect()))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    monkeypatch.setattr(layout, "PORTION", size // 40)
    assert X._tokens(df, "doc_id", "text").rdd.getNumPartitions() >= 40
    assert sorted(map(str, X.summarize(df, "doc_id", None, "text").collect())) == want


def test_short_words_take_little_of_the_broadcast_room(spark, monkeypatch):
    """Room is counted by the bytes of the words, so short ones are not left to the shuffle."""
    table = spark.createDataFrame([(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", 1000 - i, i) for i in range(600)], "token string, n long, idf long")
    monkeypatch.setattr(X, "broadcast_bytes", lambda df: 100 * 512)
    hot, rest = X._split_words(table)
    assert hot.count() > 300 and hot.count() + rest.count() == 600
