"""Every query of the subpackage on whole tables: against its check SQL, or against the library or a plain loop."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from brightledger.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def test_registered():
    assert [n.split("_")[0] for n in sorted(catalog.QUERIES, key=lambda n: int(re.sub(r"\D", "", n) or 99))] == [
        *(f"op{i}" for i in range(1, 14)), "pipeline",
    ]
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    ours = Counter(tuple(r[c] for c in cols) for r in df.collect())
    theirs = Counter(duck.execute(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLES[name]})").fetchall())
    assert ours == theirs and ours


def test_token_files(spark, texts, tokenizer):
    library, at = Tokenizer.from_file(tokenizer), 0
    got = {r.doc_id: r for r in catalog.QUERIES["op2_token_files"](spark, SF).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def check_pieces(rows, texts, tokenizer):
    library, by = Tokenizer.from_file(tokenizer), defaultdict(list)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        by[r.doc_id].append(r)
        # A sequence is one piece: full, or a power of two long, so nothing is padded.
        assert r.offset == 0 and 0 < r.length <= 2048 and r.length & (r.length - 1) == 0
    assert set(by) == {i for i, _ in texts}
    for doc_id, text in texts:
        ids, at = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing(spark, texts, tokenizer):
    check_pieces(catalog.QUERIES["op9_packing"](spark, SF).collect(), texts, tokenizer)


def plain_words(text):
    return re.sub(r"[!-/:-@\[-`{-~]", "", text.lower()).split()


def contaminated(texts, items):
    """(document, item) pairs with 13 words in place, or the whole shorter item, of which four fifths are equal."""
    out = set()
    items = [(i, plain_words(t or "")) for i, t in items]
    vocabulary = {w: {i for i, x in items if w in x} for w in {w for _, x in items for w in x}}
    for doc_id, text in texts:
        w = plain_words(text)
        near = Counter(i for x in set(w) if x in vocabulary for i in vocabulary[x])
        for i, item in items:
            span = min(13, len(item))
            if len(item) < 8 or near[i] < 5:
                continue
            for shift in range(span - len(item), len(w) - span + 1):
                same = [0 <= shift + k < len(w) and w[shift + k] == x for k, x in enumerate(item)]
                runs = [sum(same[k : k + span]) for k in range(len(item) - span + 1) if 0 <= shift + k and shift + k + span <= len(w)]
                if runs and max(runs) >= 0.8 * span:
                    out.add((doc_id, i))
                    break
    return out


def test_decontamination(spark, duck, texts):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = catalog.QUERIES["op7_decontaminate"](spark, SF).collect()
    short = [(i, t) for i, t in texts if len(t) < 4000]
    ids = {i for i, _ in short}
    want = contaminated(short, items)
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id in ids} == want
    whole = {(d, i) for d, t in texts for i, x in items if " ".join(plain_words(x)) in " ".join(plain_words(t))}
    assert whole <= {(r.doc_id, r.item_id) for r in got} and len({(r.doc_id, r.item_id) for r in got}) == len(got)


def test_main_text_is_made_of_the_articles_lines(spark, duck, texts):
    """Every page has exactly one document whose lines it holds, below a title that begins the first of them."""
    lines = {" ".join(line.split()) for _, t in texts for line in t.split("\n")}
    whole = {tuple(b for b in (" ".join(line.split()) for line in t.split("\n")) if b) for _, t in texts}
    got = catalog.QUERIES["op10_html_text"](spark, SF).collect()
    assert len(got) == duck.execute("SELECT count(*) FROM pages").fetchone()[0]
    for r in got:
        title, *rest = r.text.split("\n\n")
        assert r.n_chars == len(r.text) and all(b in lines for b in rest) and (not rest or rest[0].startswith(title[:50]))
    found = [tuple(r.text.split("\n\n")[1:]) in whole for r in got]
    assert all(found)


@pytest.mark.parametrize("name, label, parts, held, least", [("op4_quality", "quality", 4, 2, 0.97), ("op8_toxicity", "toxic", 3, 1, 0.93)])
def test_held_out_accuracy(spark, name, label, parts, held, least):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet' WHERE {label} IS NOT NULL").fetchall())
    rows = catalog.QUERIES[name](spark, sf).collect()
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    known = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(known) / len(known) >= least


def shingles(text, n):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def test_pipeline(spark, duck, tokenizer):
    """Each stage against a plain loop over the rows that the stage before it kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(corpus_pipeline.settle(stage(spark, kept[-1], SF), "test"))
        assert kept[-1].schema.names == docs.schema.names
    whole = {r.doc_id: tuple(r) for r in docs.collect()}
    good, distinct, near, clean = ({r.doc_id: r.text or "" for r in k.collect()} for k in kept[1:])
    assert all(tuple(r) == whole[r.doc_id] for r in kept[-1].collect())
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    known = [(i in good) == bool(labels[i]) for i in whole if i in labels]
    assert sum(known) / len(known) > 0.97
    by_text = defaultdict(list)
    for i, t in good.items():
        by_text[hashlib.sha256(t.translate({c: c + 32 for c in range(65, 91)}).encode()).digest()].append(i)
    assert set(distinct) == {max(ids) for ids in by_text.values()}
    sets, group = {i: shingles(t, 5) for i, t in distinct.items()}, {i: i for i in distinct}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    order = sorted(sets)
    for a in order:
        for b in order:
            if a < b and 0.8 * max(len(sets[a]), len(sets[b])) <= min(len(sets[a]), len(sets[b])):
                common = len(sets[a] & sets[b])
                if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((top(a), top(b)))
                    group[y] = x
    assert set(near) == {top(i) for i in distinct}
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    dirty = {d for d, t in near.items() for _, x in items if " ".join(plain_words(x)) in " ".join(plain_words(t))}
    assert set(near) - set(clean) == dirty
    rows = corpus_pipeline.run(spark, SF).collect()
    check_pieces(rows, sorted(clean.items()), tokenizer)
