"""Licence spans, periodic runs and spelling variants: small frames, odd rows, and whole tables against plain loops."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightledger.llm import catalog, licenses, periodic_runs, spelling

from .conftest import ROWS

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


# --- licences -------------------------------------------------------------------------------


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def phrase_places(text):
    w = license_words(text)
    return len(w), sorted((i, label) for label, phrase in licenses.PHRASES for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p)


def check_base(row, text):
    n, places = phrase_places(text)
    assert (row.n_words, row.n_base) == (n, len(places))
    assert (row.first_word, row.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
    assert row.base_labels == ",".join(sorted({x for _, x in places})) and {x for _, x in places} <= set(row.labels.split(","))
    assert 0 <= row.score <= 1


def test_license_places_equal_a_plain_loop(spark, texts):
    got = {r.doc_id: r for r in catalog.QUERIES["op11_license_scan"](spark, SF).collect()}
    assert len(got) == len(texts) and any(r.n_base for r in got.values())
    for doc_id, text in texts:
        check_base(got[doc_id], text)


def test_quoted_licenses(spark):
    """Whole, shifted, changed and half licence texts; votes on neighbouring diagonals are one span."""
    mit = dict(licenses.TEXTS)["mit"]
    w = mit.split()
    shifted = w[:40] + ["one", "more"] + w[40:70] + w[72:]
    rng = random.Random(3)
    changed = [x if rng.random() > 0.05 else "other" for x in w]
    rows = [(1, "start " + mit + " end"), (2, " ".join(shifted)), (3, " ".join(changed)), (4, " ".join(w[: len(w) // 4])), (5, " ".join(w[::-1])), (6, mit + " and " + mit), (7, "MIT License, mit-license mit a license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(docs, licenses.templates(spark))
    spans = {r.doc_id: [s for s in r.spans if s.label == "mit"] for r in found.collect()}
    n = len(license_words(mit))
    assert [(s.start, s.length, s.share, s.enough) for s in spans[1]] == [(1, n, 1.0, True)]
    assert len(spans[2]) == 1 and spans[2][0].enough and spans[2][0].start == 0 and spans[2][0].length == n
    assert len([s for s in spans[3] if s.enough]) == 1
    assert not any(s.enough for s in spans[4] + spans[5])
    assert [(s.start, s.share) for s in spans[6] if s.enough] == [(0, 1.0), (n + 1, 1.0)]
    assert [(s.start, s.length, s.base) for s in spans[7]] == [(0, 2, True), (2, 2, True)]
    by = {r.doc_id: r for r in licenses.summary(found).collect()}
    assert by[1].labels == "mit" and by[1].base_labels == "" and by[4].labels == "" and 0 < by[4].score < licenses.LEAST and by[5].score == 0


def test_shares_equal_a_plain_loop(spark):
    """Random texts over few words: spans by diagonal votes, merged, against sets of places."""
    rng = random.Random(5)
    alphabet = list("abcdefgh")
    made = [(f"t{k}", " ".join(rng.choice(alphabet) for _ in range(n)), 0.5, False) for k, n in enumerate((1, 2, 3, 9, 15, 30))]
    rows = []
    for i in range(60):
        parts = [rng.choice(alphabet) for _ in range(rng.randrange(30))]
        t = rng.choice(made)[1].split()
        at = rng.randrange(len(t))
        rows.append((i, " ".join(parts + t[at : at + rng.randrange(1, 25)] + parts[::-1])))
    spec = spark.createDataFrame(made + made[:2], "label string, text string, least double, base boolean")
    got = {r.doc_id: r.spans for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), spec).collect()}
    for i, text in rows:
        w, want = text.split(), []
        for label, t, least, _ in made:
            t = t.split()
            width = min(licenses.GRAM, len(t))
            votes = defaultdict(set)
            for a in range(len(w) - width + 1):
                for b in range(len(t) - width + 1):
                    if w[a : a + width] == t[b : b + width]:
                        votes[a - b].add(b)
            clusters = []
            for d in sorted(votes):
                if clusters and d - clusters[-1][-1] <= (licenses.SHIFT if len(t) > width else 0):
                    clusters[-1].append(d)
                else:
                    clusters.append([d])
            for c in clusters:
                low, high = min(d + min(votes[d]) for d in c), max(d + max(votes[d]) + width for d in c)
                share = len({b + k for d in c for b in votes[d] for k in range(width)}) / len(t)
                want.append((low, high - low, label, share, share >= least))
        assert sorted((s.start, s.length, s.label, s.share, s.enough) for s in got[i]) == sorted(want)


def test_licenses_on_odd_rows(spark, odd, none):
    spec = licenses.templates(spark)
    got = licenses.summary(licenses.scan(odd, spec)).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len(license_words(t or ""))) for i, t in ROWS)
    assert licenses.scan(none, spec).count() == 0
    assert all(r.spans == [] for r in licenses.scan(odd, spec.where("false")).collect())
    hot = odd.select("doc_id", F.lit("the mit license " * 3000).alias("text")).unionByName(odd.select("doc_id", F.lit(None).cast("string").alias("text")))
    assert Counter(r.n_base for r in licenses.summary(licenses.scan(hot, spec)).collect()) == Counter({3000: len(ROWS), 0: len(ROWS)})


# --- periodic runs --------------------------------------------------------------------------


def plain_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            # A run of a smaller period that holds all of it has the smallest period.
            if j > i and n >= max(least, times * q) and not any(s <= i and i + n <= s + m for s, m, _ in out):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 7)), max_size=8), st.sampled_from([(6, 4), (4, 3), (12, 5), (1, 3)]))
def test_runs_equal_a_plain_loop(blocks, rule):
    w = [x for b, k in blocks for x in b * k]
    assert periodic_runs.repetitions(w, *rule) == plain_runs(w, *rule)
    around = [b"a b c a b c", " ".join(w).encode(), b"c c c"]
    _, runs = periodic_runs._of_chunk(around, *rule)
    assert runs[1] == plain_runs(w, *rule)


def test_the_automaton_tells_last_occurrences():
    w = "abracadabra abracadabra"
    longest, link, ends = periodic_runs.automaton(w)
    paths = periodic_runs.Paths(link)
    for i, state in enumerate(ends):
        for x, end in paths.access(state, i):
            suffix = w[i + 1 - longest[x] : i + 1]
            assert end == (w[: i].rfind(suffix) + len(suffix) - 1 if suffix in w[:i] else -1)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + j % p] for j in range(n - a)]


def check_runs(row, w):
    runs = plain_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    assert row.n_runs == len(runs)
    assert (row.start, row.length, row.period, row.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    assert row.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


def test_runs_of_whole_documents(spark, texts):
    got = {r.doc_id: r for r in catalog.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got.values()) > 10
    for doc_id, text in texts:
        w = planted(doc_id, re.findall("[^\x20\x09-\x0d]+", text))
        if len(w) <= 1500:  # the plain loop is quadratic
            check_runs(got[doc_id], w)


def test_runs_on_odd_rows(spark, odd, none):
    got = periodic_runs.collapse(odd).collect()
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len(split(t))) for i, t in ROWS)
    long = next(r for r in got if r.doc_id == 8)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.text == "word"
    assert all(r.text == " ".join(split(t)) for r in got for i, t in ROWS if r.doc_id == i and i in (1, 5, 6, 7))
    assert periodic_runs.collapse(none).count() == 0
    assert Counter(r.doc_id for r in periodic_runs.digests(periodic_runs.collapse(periodic_runs.with_tail(odd))).collect()) == Counter(i for i, _ in ROWS)
    with pytest.raises(ValueError):
        periodic_runs.collapse(odd, times=2)


# --- spelling variants ----------------------------------------------------------------------


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(counts, ratio=5):
    near = {w: [x for x in counts if is_near(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def as_set(df):
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block", [3, 2048])
def test_groups_equal_all_pairs(spark, block):
    rng = random.Random(block)
    made = {"".join(rng.choice("abékÀ") for _ in range(rng.randint(1, 6))) for _ in range(400)} | {"x" * 40, "x" * 41, "x" * 39 + "y", "日本語", "日本", "naïve", "naive"}
    counts = {w: rng.choice([1, 1, 2, 5, 30, 200, 2000]) for w in made}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert as_set(spelling.group(words, block=block)) == plain_groups(counts)


def test_long_chains_lead_to_their_root(spark):
    words = ["a" * (6 + k) for k in range(12)]
    counts = {w: 5 ** k for k, w in enumerate(words, 1)}
    got = as_set(spelling.group(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_groups(counts) and {r[5] for r in got} == {words[-1]}


def plain_vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def test_spelling_of_whole_tables(spark, texts):
    counts = plain_vocabulary(texts)
    assert as_set(catalog.QUERIES["op13_spelling_variants"](spark, SF)) == plain_groups(counts) and len(counts) > 100


def test_spelling_on_odd_rows(spark, odd, none):
    words = spelling.vocabulary(spelling.occurrences(odd), least_length=1, least_count=1)
    want = Counter(lower(x) for _, t in ROWS for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    assert {r.word: r.n for r in words.collect()} == want
    assert as_set(spelling.group(words)) == plain_groups(dict(want))
    assert spelling.group(spelling.vocabulary(spelling.misspelt(spelling.occurrences(none)))).count() == 0
    missing = spark.createDataFrame([(None, 7), ("alone", 3)], "word string, n long")
    assert {r[0] for r in as_set(spelling.group(missing)) if r[0] is not None} == {"alone"}


def test_squared_distances_lose_no_pair():
    rng = np.random.default_rng(1)
    a = ["".join(map(chr, rng.integers(97, 100, 6))) for _ in range(300)]
    b = ["".join(map(chr, rng.integers(97, 100, 7))) for _ in range(300)]
    for x, y in ((a, b), (a, None)):
        got = {(int(i), int(j)) for p, q in spelling.near_pairs(pa.array(x), None if y is None else pa.array(y)) for i, j in zip(p, q)}
        other = x if y is None else y
        assert got == {(i, j) for i, v in enumerate(x) for j, w in enumerate(other) if is_near(v, w) and (y is not None or i < j)}
