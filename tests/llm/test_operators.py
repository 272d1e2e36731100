"""The operators on small frames: odd rows, hot groups, empty tables, and their parts against plain code."""

import hashlib
import itertools
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightledger.llm import chat, common, decontaminate, exact_dedup, graph, html_text, hyperminhash, near_dedup, packing, quality, substring_dedup, token_files, tokens, toxicity, training, words

from .conftest import ROWS

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# --- exact dedup ----------------------------------------------------------------------------


def test_exact_dedup_on_odd_rows(odd, none):
    got = exact_dedup.decide(odd).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[(t or "").translate(FOLD)].append(i)
    assert len(got) == len(ROWS)
    for text, ids in groups.items():
        own = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        best = max((i for i in ids if i is not None), default=None)
        assert Counter(r.doc_id for r in own) == Counter(ids)
        assert {(r.keep_id, r.group_size) for r in own} == {(best, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [best]
    left = exact_dedup.deduplicate(odd)
    assert left.columns == odd.columns and left.count() == len(groups)
    assert exact_dedup.decide(none).count() == 0 and exact_dedup.deduplicate(none).count() == 0


def test_frequent_digests_are_verified(spark):
    """A third of all rows share a text; winners beside the shuffle and within it agree with a plain count."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 500}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    count, best = Counter(t for _, t in rows), {t: i for i, t in rows}
    got = exact_dedup.decide(docs).collect()
    texts = dict(rows)
    assert all((r.keep_id, r.group_size, r.kept) == (best[texts[r.doc_id]], count[texts[r.doc_id]], r.doc_id == best[texts[r.doc_id]]) for r in got)
    prepared = docs.select(F.col("doc_id").alias("id"), exact_dedup.digest("text").alias("digest"), F.col("doc_id").alias("rid"))
    few = exact_dedup.frequent(prepared, top=4, tracked=64).collect()
    assert [(r.size, r.best.id) for r in few] == [(3000, 8997)]


# --- tokens, token files, packing -----------------------------------------------------------


PARTS = [" ", "  ", "\n", "\t", "\r\n", " ", "\u0085", "\x1c", "a", "Bc", "'s", "'", "17", "!", "é", "é", "日本", "😀", "<|endoftext|>"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=4))
def test_ids_are_those_of_the_library(texts):
    import public_tokenizers

    enc = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode(texts) == want


def test_a_forgotten_piece_is_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    enc = tokens.Encoder(tokenizer)
    for k in range(20):
        texts = [f"some words {k} {j} and others{k * j}" for j in range(20)]
        assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]


def test_a_worker_of_the_pipeline_keeps_fewer_pieces(tokenizer, monkeypatch):
    """A worker took 300 MB and more for a million pieces, beside what the stages before had left in the executor."""
    import corpus_pipeline

    given = []
    monkeypatch.setattr(packing, "pack", lambda docs, path, **options: given.append(options))
    monkeypatch.setattr(packing, "checked", lambda pieces: pieces)
    corpus_pipeline.pack(None, None, "")
    enc = tokens.Encoder(tokenizer, **given[0])
    for k in range(25):
        enc.encode([" ".join(f"x{k * 20_000 + j}" for j in range(20_000))])
    assert len(enc.memo) <= 300_000 and len(enc.flat) <= 1 << 21
    texts = ["x1 x499999 x250000 x77"]
    assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]


def test_long_pieces_count_by_their_size(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 10_000)
    enc = tokens.Encoder(tokenizer)
    for k in range(30):
        texts = ["frequent words, " + chr(97 + k % 26) * 3_000 + str(k), "frequent. " + "ab" * (k % 7) + f" é{k}!"]
        assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]
        assert enc.chars == sum(map(len, enc.memo))
        assert enc.chars + 4 * enc.used < 10_000 + 20_000  # one call more


def test_known_short_pieces_are_found_without_making_strings(tokenizer, monkeypatch):
    """Each piece of each text was made a string and sought in a dictionary, also those met thousands of times."""
    enc = tokens.Encoder(tokenizer)
    texts = ["The frequent words, é and\nothers 17!", "", "  two\t tabs ", "a\0b a\0 a \0a", "exactly15bytes_ and sixteen__bytes_ or_more_than_that"]
    want = [enc._ids(t).tobytes() for t in texts]
    assert enc.encode(texts) == want
    asked, ask = [], enc._ask
    monkeypatch.setattr(enc, "_ask", lambda pieces: asked.extend(pieces) or ask(pieces))
    assert enc.encode(texts * 50) == want * 50
    assert set(asked) == {" sixteen__bytes_", " or_more_than_that"}
    assert enc.encode(["a\u3000 b", "x\x1cy", "c\xa0\n d"] + texts) == [enc._ids(t).tobytes() for t in ("a\u3000 b", "x\x1cy", "c\xa0\n d")] + want


def test_the_table_of_short_pieces_forgets_with_the_others(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    monkeypatch.setattr(tokens, "PLACES", 4)  # many pieces share a place
    enc = tokens.Encoder(tokenizer)
    for k in range(20):
        texts = [f"some words {k} {j} and others{k * j}" for j in range(20)]
        assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]


def test_portions_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "PORTION", 100)
    texts = ["", "a" * 60, "b" * 60, "c" * 500, "é" * 50, "", "d"] + ["e"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = list(tokens.portions(batch, 8))
    assert [t for _, part in got for t in part] == texts and [i for ids, _ in got for i in ids] == list(range(len(texts)))
    assert all(len(part) <= 8 and (len(part) == 1 or sum(len(t.encode()) for t in part) <= 100) for _, part in got)
    assert list(tokens.portions(batch.slice(0, 0), 8)) == []
    assert [part for _, part in tokens.portions(batch.slice(2, 2), 8)] == [texts[2:3], texts[3:4]]


def test_a_batch_is_scored_by_portions(monkeypatch):
    """All texts of a batch became Python objects at once, several times over."""
    monkeypatch.setattr(tokens, "PORTION", 1000)
    texts, most, ran = ["x" * (k % 7 * 30) if k % 5 else None for k in range(400)], [], []
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts, pa.string())], ["doc_id", "text"])

    def score(part):
        most.append(sum(map(len, part)))
        return np.array([len(t) / 200 for t in part])

    class Docs:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            ran.append(run)

    training.filtered(Docs(), lambda: score, 0.5)
    got = [r for b in ran[0](iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert got == [{"doc_id": k, "text": t} for k, t in enumerate(texts) if t and len(t) >= 100]
    assert max(most) <= 1000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab9é.,!?'|<&- \n", max_size=9), max_size=30))
def test_pieces_with_punctuation_are_put_together(parts):
    import public_tokenizers

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(parts), "".join(parts)]
    want = [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode(texts) == want and enc.encode(texts[::-1]) == want[::-1]


@given(st.binary(max_size=80), st.binary(max_size=300))
def test_checksums_are_joined(a, b):
    assert token_files.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("n", [1, 7, 4096])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    assert (token_files.from_planes(token_files.to_planes(ids)) == ids).all()


def test_token_files_on_odd_rows(spark, odd, none, tokenizer, tmp_path):
    enc = tokens.encoder(tokenizer)
    token_files.write(odd, str(tmp_path / "t"), tokenizer, end_id=7, block=1000)
    want = sorted(((i is not None, i or 0), t or "", enc.encode([t or ""])[0] + b"\x07\0\0\0") for i, t in ROWS)
    starts = list(itertools.accumulate((len(x) // 4 for *_, x in want), initial=0))
    got = token_files.read(spark, str(tmp_path / "t")).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i if known else None, s, len(x) // 4, zlib.crc32(x)) for ((known, i), _, x), s in zip(want, starts)
    )
    flat = [x for r in token_files.ids_of(spark, str(tmp_path / "t")).orderBy("shard", "block").collect() for x in r.ids]
    assert np.array(flat, "<u4").tobytes() == b"".join(x for *_, x in want)
    assert token_files.round_trip(none, tokenizer).count() == 0


def test_lengths_are_powers_of_two():
    assert packing.lengths(5000) == [2048, 2048, 512, 256, 128, 8] and packing.lengths(1) == [1] and packing.lengths(4096) == [2048, 2048]
    for n in range(1, 700):
        got = packing.lengths(n, 64)
        assert sum(got) == n and got == sorted(got, reverse=True) and len(set(got) - {64}) == len([x for x in got if x != 64])


def test_packing_of_odd_rows(odd, none, tokenizer):
    rows = packing.checked(packing.pack(odd, tokenizer)).collect()
    enc = tokens.encoder(tokenizer)
    want = Counter((i, len(enc.encode([t or ""])[0]) // 4 + 1) for i, t in ROWS)
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n * k for (_, n), k in want.items())
    assert packing.pack(none, tokenizer).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, tokenizer, longest=100)


# --- substring dedup ------------------------------------------------------------------------


@pytest.mark.parametrize("period", sorted(substring_dedup.COVERS))
def test_covers(period):
    cover = substring_dedup.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def kept_words(rows, width):
    seen, out = {}, []
    rows = sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0]))
    for k, (i, t) in rows:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        gone = set()
        for a in range(len(w) - width + 1):
            if seen.setdefault(tuple(w[a : a + width]), (k, a)) != (k, a):
                gone.update(range(a, a + width))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return Counter(out)


@pytest.mark.parametrize(("width", "bucket"), [(2, 16 << 20), (2, 700), (5, 16 << 20), (20, 16 << 20), (20, 700), (40, 16 << 20)])
def test_repeats_are_removed_as_by_a_plain_loop(spark, monkeypatch, width, bucket):
    """Small units and few words, so that repeats lie within and across units, at every shift, and one line is in a third of the texts.

    Small buckets make several posts, so that herds fold what their units ask, and several buckets for each post.
    """
    monkeypatch.setattr(substring_dedup, "UNIT_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", bucket)
    rng = random.Random(width)
    line = " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(60))
    rows = []
    for i in range(150):
        text = " ".join(rng.choice("abcdefgh") + str(rng.randrange(9 if width > 2 else 99)) for _ in range(rng.randrange(90)))
        if rows and rng.random() < 0.4:
            old = (rng.choice(rows)[1] or "").split()
            a = rng.randrange(len(old) + 1)
            text += " " + " ".join(old[a : a + rng.randrange(2 * width)])
        if i % 3 == 0:
            text += "\n" + line + "\n" + text[: rng.randrange(200)] + " " + line
        rows.append((i * 7 % 150, text))
    rows += [(500, None), (501, ""), (502, "  "), (503, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = Counter(tuple(r) for r in substring_dedup.remove_repeats(docs, width).select("doc_id", "n_words", "n_removed", "text").collect())
    assert got == kept_words(rows, width)


def test_herds_ask_once_for_each_hash():
    """A post folds the questions of its units, and the answers return to each of them in its own order."""
    keys = [np.array(k, np.uint64) for k in ([1, 5, 9 << 60], [1, 7], [5, 7, 8])]
    again = [np.array(a, bool) for a in ([0, 0, 0], [0, 0], [0, 0, 1])]
    post = pa.table({"unit": [10, 11, 12], "post": [0] * 3, "keys": [k.tobytes() for k in keys], "again": [substring_dedup._bits(a) for a in again]})
    folded = pa.Table.from_batches([substring_dedup.Anchors.fold(post, 4, 0, 4, {"herd": 3, "post": 0})])
    assert folded.column("bucket").to_pylist() == [0, 2] and folded.column("herd").to_pylist() == [3, 3]
    assert [np.frombuffer(k, np.uint64).tolist() for k in folded.column("keys").to_pylist()] == [[1, 5, 7, 8], [9 << 60]]
    assert substring_dedup._flags(folded.column("again").to_pylist()[0], 4).tolist() == [True, True, True, True]
    back = substring_dedup.Anchors.back(post, np.array([1, 0, 1, 1, 0], bool))
    assert back.tolist() == [True, False, False, True, True, False, True, True]


def test_repeats_on_odd_rows(odd, none):
    got = substring_dedup.remove_repeats(odd, 2).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS)
    # Of the equal rows with one doc_id the later goes; the earlier loses what doc_id 5 has in the same case.
    assert sorted(r.text for r in got if r.doc_id == 9) == ["", "aLPHA BETA gamma", "alpha"]
    assert next(r for r in got if r.doc_id == 8).n_removed == 29_999 and {r.text for r in got if r.doc_id in (2, 3, 4)} == {""}
    assert substring_dedup.remove_repeats(none).count() == 0


# --- near dedup -----------------------------------------------------------------------------


def components_of(links, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links += [(7, 7), (41, 300), (300, 299)]
    nodes = {n for a, b in links for n in (a, b) if a != b}
    df = spark.createDataFrame([(b, a) if k % 2 else (a, b) for k, (a, b) in enumerate(links)], "a long, b long")
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == {n: c for n, c in components_of([x for x in links if x[0] != x[1]], nodes).items()}
    assert graph.components(df.where("false")).count() == 0


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(3)
    for n in (3, 20, 200, 3000):
        for share in (1.0, 0.9, 0.5, 0.0):
            a = rng.integers(0, 1 << 63, n, np.uint64)
            b = a.copy()
            b[: int(n * (1 - share))] = rng.integers(0, 1 << 63, int(n * (1 - share)), np.uint64)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            at = hyperminhash.level(n)
            x, y = (hyperminhash.registers(np.unique(s), at)[None] for s in (a, b))
            assert abs(hyperminhash.estimate(x, y, np.array([n]), np.array([n]))[0] - true) < 0.13


def test_a_similar_larger_set_shares_a_level():
    for n in range(1, 3000):
        for m in range(n, int(n / 0.8) + 1):
            assert hyperminhash.level(m) in hyperminhash.levels(n, 0.8) and hyperminhash.level(m) in hyperminhash.levels(m, 0.8)


def shingle_set(text, n):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def plain_groups(rows, n, percent):
    sets = [shingle_set(t, n) for _, t in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    top, least = components_of(links, range(len(rows))), {}
    for k, (i, _) in enumerate(rows):
        old = least.get(top[k])
        least[top[k]] = i if old is None or i is not None and i < old else old
    return Counter((i, len(sets[k]), least[top[k]]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block, size", [(16, 64 << 20), (16, 4000), (1024, 20_000)])
def test_groups_equal_all_pairs(spark, odd, none, monkeypatch, block, size):
    """A crowd of copies at similarities about the threshold, in blocks and parts of blocks far smaller than the crowd, and the odd rows."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", size)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(140)]
    rows = []
    for i in range(110):
        text = list(base)
        for _ in range(rng.randrange(4, 14)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(text).upper() if i % 5 == 0 else " ".join(text)))
    rows += [(2000 + i, f"one two three{i // 3}") for i in range(9)] + [(3000, "single"), (3001, "SINGLE")] + [(4000 + i, rows[0][1]) for i in range(40)]
    rows += ROWS
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dedup.groups(docs, 2, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_groups(rows, 2, 80)
    count = len({(r.doc_id, r.th) for r in found if r.n_shingles == 0}) and sum(r.first for r in found)
    groups = Counter(g for g in ((r.component_id) for r in found if r.n_shingles))
    assert count >= len(groups)
    left = near_dedup.deduplicate(odd, shingle=2)
    assert left.columns == odd.columns
    # Texts without words are linked with nothing: 2, 3, None and 4 stay, and one each of the groups of 9 and 5, of 8, 1, 6, 7 and the text without id.
    assert Counter(r.doc_id for r in left.collect()) == Counter([2, 3, None, 4, 5, None, 6, 7, 8, 1])
    assert near_dedup.groups(none).count() == 0 and near_dedup.deduplicate(none).count() == 0


def test_parts_of_a_block_hold_each_pair_once_asked(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 800)
    cols = "band long, mb int, sb int, role int, stray boolean, node long, component long, n long"
    whole = [(1, 0, 0, 0, k % 3 == 0, k, k, 20) for k in range(30)]  # a bucket in one block
    dealt = [(2, 0, 1, 0, False, k, k, 20) for k in range(20)] + [(2, 0, 1, 1, True, 100 + k, 100 + k, 20) for k in range(20)]
    light = [(3, 0, 0, 0, k == 0, k, k, 5) for k in range(10)]
    got = near_dedup._by_bytes(spark.createDataFrame(whole + dealt + light, cols)).collect()
    met = defaultdict(lambda: ([], []))
    for r in got:
        met[r.band, r.mp, r.sp][r.role].append(r.node)
    pairs = Counter((key[0], a, b) for key, (members, asked) in met.items() for a in members for b in asked)
    assert pairs == Counter([(1, a, b) for a in range(30) for b in range(0, 30, 3)] + [(2, a, 100 + b) for a in range(20) for b in range(20)])
    assert sorted(met[3, 0, 0][0]) == list(range(10)) and not met[3, 0, 0][1]
    assert max(len(m) + len(a) for m, a in met.values()) < 30


@pytest.mark.parametrize("percent, rows", [(95, 6), (80, 6), (70, 4), (60, 3), (50, 2), (10, 1)])
def test_bands_find_pairs_at_any_percent(percent, rows):
    s = percent / 100
    assert hyperminhash.band_rows(s) == rows and (1 - s**rows) ** (256 // rows) <= 3e-6
    for n in (1, 5, 40, 900):
        assert {hyperminhash.level(m) for m in range(n, int(n / s) + 1)} <= set(hyperminhash.levels(n, s))
    # Pairs of that similarity, by their real signatures.
    rng = np.random.default_rng(percent)
    for _ in range(20):
        common, one, two = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (20 * percent, 10 * (100 - percent), 10 * (100 - percent)))
        a, b = (hyperminhash.band_keys(hyperminhash.registers(np.unique(np.concatenate([common, x])), 7), 7, rows) for x in (one, two))
        assert (a == b).any()
    with pytest.raises(ValueError):
        hyperminhash.band_rows(0.01)


# --- decontamination ------------------------------------------------------------------------

ITEM = "The quick brown fox, it jumps over the lazy dog and then it runs home to rest."


def test_any_two_of_thirteen_words_may_be_replaced():
    item = [f"w{i}" for i in range(13)]
    items = decontaminate.Items([(1, " ".join(item))])
    for pair in itertools.combinations(range(13), 2):
        text = [f"other{i}" if i in pair else w for i, w in enumerate(item)]
        assert items.search([("so " + " ".join(text) + " on").encode()])
    assert not items.search([" ".join(f"other{i}" if i in (2, 6, 10) else w for i, w in enumerate(item)).encode()])


@pytest.mark.parametrize("n", range(decontaminate.LEAST, decontaminate.SPAN + 1))
def test_any_fifth_of_the_words_of_an_item_may_be_replaced(n):
    item = [f"w{i}" for i in range(n)]
    items = decontaminate.Items([(1, " ".join(item))])
    for k in range(n // 5 + 1):
        for gone in itertools.combinations(range(n), k):
            assert items.search([" ".join(["so", *(f"other{i}" if i in gone else w for i, w in enumerate(item)), "on"]).encode()]), gone
    assert not items.search([" ".join(f"other{i}" if i <= n // 5 else w for i, w in enumerate(item)).encode()])


@pytest.mark.parametrize("n", range(1, decontaminate.LEAST))
def test_short_items_are_sought_word_by_word(n):
    item = [f"w{i}" for i in range(n)]
    items = decontaminate.Items([(1, " ".join(item)), (2, "")])
    found = items.search([f"so {' '.join(item).upper()}, on {' '.join(item)}".encode().lower().replace(b",", b""), b"", b"other"])
    assert found == [(0, 0, 1, 0, n, n)]
    assert not items.search([" ".join(["so", *item[:k], "other", *item[k + 1 :], "on"]).encode() for k in range(n)])


def test_overlaps(spark, odd, none):
    words_of = ITEM.split()
    rows = [
        (1, f"Before. {ITEM} After."), (2, ITEM.upper().replace(" ", "\n")), (3, " ".join(words_of[:12])), (4, " ".join(words_of[:13])),
        (5, " ".join("zzz" if k % 5 == 2 else w for k, w in enumerate(words_of))), (6, " ".join(reversed(words_of))), (7, None), (8, ""),
        (9, "far " * 50_000 + ITEM), (None, ITEM), (1, ITEM),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(10, ITEM), (10, ITEM), (11, "far too short"), (12, None), (None, "")], "item_id long, text string")
    got = decontaminate.find(docs, benchmark).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, 1, 2, 2, 4, 4, 5, 5, 9, 9, None, None, 1, 1])  # the item is there twice
    assert next(r for r in got if r.doc_id == 9).doc_word == 50_000
    left = decontaminate.remove(docs.withColumn("extra", F.lit(1)), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [3, 6, 7, 8] and left.columns == ["doc_id", "text", "extra"]
    assert decontaminate.remove(odd, benchmark).count() == len(ROWS) and decontaminate.remove(odd, benchmark.where("false")).count() == len(ROWS)
    assert decontaminate.find(none, benchmark).count() == 0 == decontaminate.find(docs, benchmark.where("false")).count()


def test_a_large_benchmark_is_joined(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 200)
    benchmark = spark.createDataFrame([(i, " ".join(f"t{i}w{k}" for k in range(14))) for i in range(20)], "item_id long, text string")
    docs = benchmark.select(F.col("item_id").alias("doc_id"), "text")
    assert decontaminate.small(decontaminate.folded(benchmark)) is None
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find(docs, benchmark).collect()) == [(i, i) for i in range(20)]
    assert decontaminate.remove(docs, benchmark).count() == 0


def test_a_repeated_row_of_the_benchmark_is_folded(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 200)
    rows = [(i, " ".join(f"t{i}w{k}" for k in range(14))) for i in range(6)]
    benchmark = spark.createDataFrame(rows + rows[:1] * 30, "item_id long, text string")
    every = decontaminate.folded(benchmark)
    assert sorted(every.collect()) == [(i, t, 31 if i == 0 else 1) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.item_id for r in decontaminate.find(docs, benchmark).collect()) == {0: 31, **{i: 1 for i in range(1, 6)}}
    monkeypatch.undo()
    assert sorted(decontaminate.small(every)) == sorted(every.collect())
    assert Counter(r.item_id for r in decontaminate.find(docs, benchmark).collect()) == {0: 31, **{i: 1 for i in range(1, 6)}}


def test_the_join_and_the_search_in_tasks_give_the_same_rows(spark, odd, monkeypatch):
    rng = random.Random(5)
    items, texts = [], []
    for _ in range(60):
        n = rng.choice([1, 2, 3, 5, 7, 8, 9, 10, 11, 12, 13, 14, 20, 40])
        items.append([f"w{rng.randrange(60)}" for _ in range(n)])
    for _ in range(500):
        x = list(rng.choice(items))
        for k in rng.sample(range(len(x)), rng.randrange(0, len(x) // 3 + 1)):
            x[k] = "other"
        texts.append(" ".join([f"W{rng.randrange(60)}," for _ in range(rng.randrange(6))] + x[rng.randrange(3) :] + [f"w{rng.randrange(60)}" for _ in range(rng.randrange(6))]))
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 40 + [(None, texts[1]), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text")).withColumns({"key": F.lit(1), "item": F.lit("x")})
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(3, " ".join(items[3])), (70, " ".join(items[4])), (71, None), (72, ""), (73, "!"), (None, " ".join(items[5]))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    searched = Counter(decontaminate.find(docs, benchmark).collect())
    left = Counter(decontaminate.remove(docs, benchmark).collect())
    assert len(searched) > 300
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 100)
    joined = decontaminate.find(docs, benchmark)
    assert Counter(joined.collect()) == searched
    assert "CartesianProduct" not in (plan := joined._jdf.queryExecution().toString()) and "BroadcastNestedLoopJoin" not in plan
    kept = decontaminate.remove(docs, benchmark)
    assert Counter(kept.collect()) == left and kept.columns == docs.columns
    assert decontaminate.find(docs.where("false"), benchmark).count() == 0 == decontaminate.remove(docs.where("false"), benchmark).count()


def test_a_full_table_of_bits_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 100)
    monkeypatch.setattr(decontaminate, "_BITS", (1 << 15, 1 << 15))
    benchmark = spark.createDataFrame([(i, " ".join(f"t{i}w{k}" for k in range(14))) for i in range(900)], "item_id long, text string")
    docs = benchmark.select(F.col("item_id").alias("doc_id"), "text")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find(docs, benchmark).collect()) == [(i, i) for i in range(900)]


# --- chat -----------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "c\\n", ""]), st.lists(st.sampled_from(["<", "|", "\\", "<|", "<|im_end|>\n", "x", "\n", "é"]), max_size=8).map("".join)), max_size=4))
def test_the_template_is_reversible(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def test_masks(spark, tokenizer):
    turns = [
        (1, 1, "assistant", "  Hi — 日本 😀 "), (1, 0, "user", "<|im_end|>\n<|im_start|>assistant no"), (1, 2, "assistant", "<|x"), (1, 2, "assistant", "<|x"),
        (2, None, None, None), (2, 0, "assistant", None), (None, 0, "assistant", "word " * 20_000),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r.conv_id: r for r in chat.format_chats(df, tokenizer).collect()}
    assert set(got) == {1, 2, None}
    r = got[1]
    assert [chat.unescape(r.text[a:b]) for a, b in zip(r.loss_starts, r.loss_ends)] == ["  Hi — 日本 😀 ", "<|x", "<|x"]
    coded = tokens.encoder(tokenizer).tokenizer.encode(r.text, add_special_tokens=False)
    inside = lambda a, b: any(a < e and s < b for s, e in zip(r.loss_starts, r.loss_ends))
    assert r.ids == coded.ids and r.loss_mask == [inside(a, b) for a, b in coded.offsets]
    said = {d.conv_id: d for d in chat.digests(chat.format_chats(df, tokenizer)).collect()}
    assert said[2].n_turns == 2 and said[2].loss_chars == 0 and said[None].loss_chars == 100_000
    assert said[2].turns_sha256 == hashlib.sha256(b"\n\nassistant\n\n").hexdigest()
    assert chat.format_chats(df.where("false"), tokenizer).count() == 0


# --- html -----------------------------------------------------------------------------------


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain &lt;text&gt; &eacute;", ["plain <text> é"]), ("<p>a<p>b\n\t c<br>d", ["a", "b c d"]),
    ("<nav>x</nav><article><h1>T</h1><p>one <b>tw</b>o<p class='notice'>n<p>three</article><footer>f</footer>", ["T", "one two", "three"]),
    ("<div class='ad'>buy<article><p>body<aside>s<p>t</aside><form>q</form></article>rest", ["body"]),
    ("<main><div id=comments><p>hi<div>no</div></div><script>if (a<b) '</p>'</script><p title='a>b'>kept", ["kept"]),
    ("<article><p>1</p><article class='comment'><p>2</p></article><p>3</p></article>", ["1", "3"]),
    ("<p>5 < 6 and <unclosed", ["5 < 6 and <unclosed"]), ("<title>t</title><style>p{}</style><!-- <p>c</p> --><p>x", ["x"]),
])
def test_blocks(page, want):
    inner, outer, marked = html_text.blocks(page)
    assert (inner if marked else inner + outer) == want


@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_shared_blocks_are_a_common_subsequence(a, b):
    keep = [x for x, k in zip(a, html_text.shared(a, b)) if k]
    rest = iter(b)
    assert all(x in rest for x in keep)
    if len(set(a)) == len(a) and len(set(b)) == len(b):
        best = max((n for n in range(len(a) + 1) for c in itertools.combinations(a, n) if all(x in it for it in [iter(b)] for x in c)), default=0)
        assert len(keep) == best


def test_pages_without_markup_lose_what_neighbours_share(spark):
    page = lambda body: f"<div>My site</div><div>Home | News</div>{body}<div>All rights reserved</div>"
    rows = [
        (1, "http://a.org/x/1", page("<p>first article, long enough to be the page</p><p>shared quote</p>")),
        (2, "http://a.org/x/2", page("<p>second article, which is another text altogether</p>")),
        (3, "http://a.org/x/3?q=1", page("<p>second article, which is another text altogether</p>")),  # a copy says nothing about the site
        (4, "http://b.org/x/2", page("<p>alone on its host</p>")),
        (5, None, page("<p>no address</p>")),
        (6, "http://a.org/x/4", None),
        (7, "http://a.org/x/5", "<article><p>My site</p><p>marked</p></article>"),
        (7, "http://a.org/x/5", "<article><p>My site</p><p>marked</p></article>"),
        (None, "not a url", "x" * 100_000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("rid", "blocks", "host", "position")})
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in html_text.extract(df).collect())
    texts = {i: t for i, t, _ in got}
    assert texts[1] == "first article, long enough to be the page\n\nshared quote"
    assert texts[2] == "second article, which is another text altogether"
    assert texts[4].startswith("My site") and texts[5].endswith("All rights reserved") and texts[6] == ""
    assert [t for i, t, _ in got if i == 7] == ["My site\n\nmarked"] * 2 and all(n == len(t) for _, t, n in got)
    assert html_text.extract(df.where("false")).count() == 0


def test_copies_and_short_articles_lose_what_the_site_adds(spark):
    page = lambda body: f"<div>My site</div><div>Home | News | Sports | Travel | Food</div>{body}<div>All rights reserved by all of us</div>"
    second = page("<p>second article, which is another text altogether</p>")
    long = [f"a long passage of one article, number {k}" for k in range(6)]
    rows = [
        # The page of the test above with a copy before it and an empty page after it, and a run of copies.
        (1, "http://a.org/x/1", page("<p>first article, long enough to be the page</p>")), (2, "http://a.org/x/2", second),
        (3, "http://a.org/x/3?q=1", second), (4, "http://a.org/x/4", None), (5, "http://a.org/x/5", second), (6, "http://a.org/x/6", second),
        (7, "http://a.org/x/7", page("<p>third article</p>")),
        # Menus are most of the text.
        *((10 + k, f"http://c.org/{k}", page(f"<p>short {k}</p>")) for k in range(4)),
        # A run of near copies, with other pages far from it.
        *((20 + k, f"http://d.org/a/{k}", page("".join(f"<p>{x}</p>" for x in long) + f"<p>edition {k}</p>")) for k in range(5)),
        *((30 + k, f"http://d.org/b/{k}", page(f"<p>{'other ' * 30}{k}</p>")) for k in range(5)),
    ]
    texts = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert texts[1] == "first article, long enough to be the page" and texts[4] == ""
    assert {texts[i] for i in (2, 3, 5, 6)} == {"second article, which is another text altogether"}
    assert texts[7] == "third article"
    assert [texts[10 + k] for k in range(4)] == [f"short {k}" for k in range(4)]
    assert [texts[20 + k] for k in range(5)] == ["\n\n".join([*long, f"edition {k}"]) for k in range(5)]
    assert [texts[30 + k] for k in range(5)] == ["other " * 30 + str(k) for k in range(5)]


def test_marked_articles_lose_the_lines_of_every_page(spark):
    page = lambda body, first="<p>Partner of the year</p>": f"<nav>x</nav><article>{first}{body}<p>Read us daily</p><div class=box9>By the desk</div></article>"
    quote = "<p>a quoted passage</p>"
    rows = [
        *((k, f"http://a.org/{k}", page(f"<h1>title {k}</h1>{quote}<p>{'text ' * 30}{k}</p>" + (quote if k % 2 else ""))) for k in range(8)),
        # A passage that ends half of the articles stays; so does all of a host with few pages.
        *((10 + k, f"http://b.org/{k}", f"<main><p>{'words ' * 20}{k}</p>{quote if k % 2 else ''}</main>") for k in range(8)),
        *((20 + k, f"http://c.org/{k}", page(f"<p>{'text ' * 30}{k}</p>")) for k in range(4)),
        *((30 + k, f"http://d.org/{k}", f"<main>{''.join(f'<p>near copy, passage {j}</p>' for j in range(6))}<p>{k}</p></main>") for k in range(8)),
    ]
    texts = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(8):
        want = [f"title {k}", "a quoted passage", "text " * 30 + str(k)] + ["a quoted passage"] * (k % 2)
        assert texts[k] == "\n\n".join(want)
        assert texts[30 + k].count("near copy") == 6 and texts[30 + k].endswith(str(k))
    assert [texts[10 + k].count("quoted") for k in range(8)] == [0, 1] * 4
    assert all("Partner" in texts[20 + k] and "By the desk" in texts[20 + k] for k in range(4))


# --- classifiers ----------------------------------------------------------------------------


@pytest.mark.parametrize("module", [quality, toxicity])
def test_models_on_odd_rows_and_few_labels(spark, odd, none, module):
    labels = spark.createDataFrame([(5, 1), (6, 0), (6, None), (None, 1), (77, 0), (8, 1)], "doc_id long, mark int")
    for keep in (F.lit(True), F.col("mark") == 1, F.lit(False)):
        model = module.learn(odd, labels, keep, label="mark")
        scores = module.score(odd, model).collect()
        assert Counter(r.doc_id for r in scores) == Counter(i for i, _ in ROWS) and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in scores} == {0.5}
    assert module.score(none, model).count() == 0
    kept = quality.accepted(odd, quality.fit([]), 0.5)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) and quality.accepted(odd, quality.fit([]), 0.6).count() == 0


def plain_quality(model, text):
    """The score of one text, feature by feature."""
    mask = (1 << 32) - 1

    def slot(h):
        h = ((h ^ (h >> 15)) * 0x85EBCA6B) & mask
        h = ((h ^ (h >> 13)) * 0xC2B2AE35) & mask
        return h >> (32 - quality.BITS)

    blanks = re.compile(rb"[\x20\x09-\x0d]")
    data = text.encode()
    found = [w for w in blanks.split(data) if w]
    kinds = [[slot(int(words.split([w]).hashes()[0]) >> 32) for w in found]]
    padded = blanks.sub(b" ", data) + b" "
    for n in quality.GRAMS:
        grams = [padded[i : i + n] for i in range(len(padded) - n + 1)]
        kinds.append([slot((n + sum(c * pow(0x9E3779B1, k + 1, 1 << 32) for k, c in enumerate(g))) & mask) for g in grams if b" " not in g[1:-1]])
    looks = []
    for i, w in enumerate(found):
        upper = sum(0x41 <= c <= 0x5A for c in w)
        lower = sum(0x61 <= c <= 0x7A or c >= 0x80 for c in w)
        digits = sum(0x30 <= c <= 0x39 for c in w)
        code = (0 if lower else min(upper, 2)) + (3 if lower else 0) + 4 * min(digits, 1) + 8 * min(len(w) - upper - lower - digits, 3)
        code = code * 8 + min(len(w), 28) // 4
        for back in (1, 2, 3):
            code = code * 2 + (i >= back and found[i - back] == w)
        looks.append(slot(code * 0x9E3779B1 & mask))
    kinds.append(looks)
    assert len(kinds) == quality.KINDS
    odds = model.bias + sum(sum(float(model.weight[x]) for x in k) / len(k) for k in kinds if k) / quality.KINDS
    return 1 / (1 + np.exp(-odds))


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB9é.,!- \n\t\u2028語", max_size=60), max_size=8))
def test_quality_scores_equal_a_plain_loop(found):
    """Neighbours in a chunk do not matter, nor do empty texts and texts of blanks."""
    rng = np.random.default_rng(5)
    model = quality.Model(rng.normal(0, 2, 1 << quality.BITS).astype(np.float32), 0.3)
    found = [*found, "", "  ", "word " * 300, "x" * 5000]
    assert np.allclose(model.score(found), [plain_quality(model, t) for t in found], atol=1e-9)


@pytest.mark.parametrize(("marks", "want"), [([], 6), ([(1, 0), (2, 0)], 6), ([(1, 1), (3, 1)], 6), ([(1, 1), (2, 0), (3, 1), (4, 0)], None)])
def test_the_first_stage_keeps_all_unless_it_can_tell(spark, tmp_path, marks, want):
    import corpus_pipeline

    rows = [(1, "good plain words in a row"), (2, "zzz ### 000 zzz"), (3, "more good plain words here"), (4, "### zzz 000 ###"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.keep_quality(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = {r.doc_id for r in got.collect()}
    if want:
        assert len(kept) == want
    else:
        assert {1, 3} <= kept and not kept & {2, 4} and len(kept & {5, 6}) in (0, 2)


def test_the_sample_is_bounded_and_balanced(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("mark"))
    rows = training.sample(docs, labels, "mark", F.col("doc_id") < 3000, 200)
    assert Counter(y for _, y in rows) == {0: 100, 1: 100} and all(int(t.split()[1]) < 3000 for t, _ in rows)
    assert rows == training.sample(docs.repartition(9), labels, "mark", F.col("doc_id") < 3000, 200)


def test_pairs_of_terms_are_learned():
    """Each of two terms is harmless; together they are not."""
    rng = random.Random(2)
    rows = []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        filler = [f"word{rng.randrange(30)}" for _ in range(6)]
        rows.append((" ".join(["insult"] * a + ["group"] * b + filler), int(a and b)))
    model = toxicity.fit(rows)
    assert (model.score(["insult word1", "group word2", "insult and the group", ""]) >= 0.5).tolist() == [False, False, True, False]


def test_word_hashes_do_not_depend_on_the_chunk():
    texts = [b"a b  c", b"", b" \t", "é b".encode(), b"a"]
    whole = words.split(texts)
    parts = [words.split([t]) for t in texts]
    assert np.array_equal(whole.hashes(), np.concatenate([p.hashes() for p in parts]))
    assert np.diff(whole.first).tolist() == [3, 0, 0, 2, 1] and list(words.chunks(texts, 3)) != list(words.chunks(texts, 100))


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_a_polynomial_confuses_stay_apart(spark):
    """Two words of 1,024 letters, equal under any polynomial modulo 2**64, in the operators that compare words by hashes."""
    x, y = thue_morse(1024), thue_morse(1024, "b", "a")
    h = words.split([f"{x} {y} {x}".encode()]).hashes()
    assert h[0] == h[2] != h[1]
    for seed in (0, 1):
        short = words.split([b"a b ab ba a\x00 aa aaaaaaaa aaaaaaaaa aaaaaaaaaaaaaaaa aaaaaaaaaaaaaaaaa aaaaaaaab baaaaaaaa"]).hashes(seed)
        assert len(set(short.tolist())) == 12
    assert (words.split([b"one two"]).hashes(0) != words.split([b"one two"]).hashes(1)).all()
    tail = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{x} {tail}"), (2, f"{y} {tail}")], "doc_id long, text string")
    kept = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs, width=31).collect()}
    assert kept == {1: 0, 2: 0}
    pair = spark.createDataFrame([(1, f"{x} {x}"), (2, f"{y} {y}")], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.groups(pair, shingle=2, percent=80).collect()} == {1, 2}
    items = spark.createDataFrame([(7, " ".join([y] * 9))], "item_id long, text string")
    assert decontaminate.find(spark.createDataFrame([(1, " ".join([x] * 9))], "doc_id long, text string"), items).count() == 0


def test_common_openings_cost_bounded_work():
    """800 items share an opening that stands 4,000 times in one text: every meeting is looked at, in parts."""
    import time
    import tracemalloc

    opening = "which of the following statements"
    items = decontaminate.Items([(i, f"{opening} tells about case number x{i} y{i} z{i} best") for i in range(800)])
    text = " ".join(f"{opening} a{i} b{i}" for i in range(4000)) + f" {opening} tells about case number x7 y7 z7 best"
    items.search([b"which of the following"])
    tracemalloc.start()
    began = time.perf_counter()
    found = items.search([decontaminate.normal(text)])
    took, (_, peak) = time.perf_counter() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (0, 7, 28000, 0, 13, 13) in found and peak < 200e6 and took < 20


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=18), max_size=4), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=16), min_size=1, max_size=3))
def test_best_overlaps_equal_a_plain_loop(texts, items):
    """Items of every length, over few words, so that seeds meet everywhere."""
    got = decontaminate.Items([(k, " ".join(x)) for k, x in enumerate(items)]).search([" ".join(t).encode() for t in texts])
    want = {}
    for t, text in enumerate(texts):
        for k, item in enumerate(items):
            span = min(decontaminate.SPAN, len(item))
            least = decontaminate.SHARE * span if len(item) >= decontaminate.LEAST else span
            best = None
            for d in range(-len(item), len(text)):
                low, high = max(d, 0), min(d + len(item), len(text))
                for a in range(low, high - span + 1):
                    same = sum(text[a + x] == item[a + x - d] for x in range(span))
                    if same >= least and (best is None or same > best[0]):
                        best = (same, a, a - d)
            if best:
                want[t, k] = best
    assert {(t, k): (same, a, b) for t, k, a, b, _, same in got} == want


CASES = [
    ('<article><div class="social-sciences"><p>one</p></div><p>two</p></article>', "one two"),
    ('<main><section id="related-work"><h2>Related work</h2><p>text</p></section><p>rest</p></main>', "Related work text rest"),
    ('<article><p>a</p><p class="ad-hoc">b</p></article>', "a b"),
    ('<article><div class="content alert-system"><p>the whole article stands here</p></div></article>', "the whole article stands here"),
    ('<article><div class="share"><p>the whole article stands in this element</p></div><p>end</p></article>', "the whole article stands in this element end"),
    ("<article><p>E = <math><mi>m</mi><msup>c2</msup></math> holds</p></article>", "E = mc2 holds"),
    ('<article></article><div><p>the text</p></div>', "the text"),
    ('<article><p>a long enough text</p><div class="comment-list"><p>first!</p></div><div id="cookieBanner">ok?</div><ul class="site-footer x"><li>c</li></ul></article>', "a long enough text"),
    ('<article><p>a long enough text</p><p class="ad">buy</p><nav>n</nav><aside>s</aside></article>', "a long enough text"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_names_lose_no_text_of_the_article(page, want):
    inner, outer, marked = html_text.blocks(page)
    assert " ".join(inner if marked else inner + outer) == want


def plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@given(st.lists(st.integers(0, 30), max_size=12, unique=True), st.lists(st.integers(0, 30), max_size=12, unique=True))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    assert html_text.shared(a, b).sum() == plain_lcs(a, b)


def test_html_of_odd_rows(spark, odd, none):
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>"
    pages = [(1, "http://h.x/a", None), (None, None, "<p>no id"), (2, "http://h.x/b", ""), (3, "http://h.x/c", long), (3, "http://h.x/c", long)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.withColumns({c: F.lit("x") for c in ("rid", "host", "key", "marked", "lines", "position", "gone", "count")})
    got = html_text.extract(df).collect()
    whole = "\n\n".join(f"line {i}" for i in range(20_000))
    assert Counter((r.page_id, r.text) for r in got) == Counter({(1, ""): 1, (None, "no id"): 1, (2, ""): 1, (3, whole): 2})
    assert html_text.extract(df.where("false")).count() == 0


def test_pairs_without_a_signal_of_their_own_are_learned():
    """The label is 1 if both terms stand in a text or neither: no term tells anything alone."""
    rng = random.Random(2)
    rows = []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = [f"w{rng.randrange(300)}" for _ in range(30)] + ["insultword"] * a + ["groupname"] * b
        rng.shuffle(w)
        rows.append((" ".join(w), int(a == b)))
    model = toxicity.fit(rows[:3000])
    texts = [t for t, _ in rows[3000:]]
    got = model.score(texts)
    assert ((got >= 0.5) == [y for _, y in rows[3000:]]).mean() > 0.9
    # A slow scorer: the bias, the weight of each term, and the product of the vectors of each pair.
    for text, score in zip(texts[:40], got):
        _, slot = toxicity._terms([toxicity._normal(text)])
        own = sorted({int(r) for r in model.place[np.unique(slot)] if r >= 0})
        odds = model.bias + sum(model.weight[r] for r in own) + sum(model.vector[r] @ model.vector[q] for r, q in itertools.combinations(own, 2))
        assert 1 / (1 + np.exp(-odds)) == pytest.approx(score, abs=1e-9)


def test_small_tables_of_links_are_few_files(spark, monkeypatch):
    """A step writes files by its rows, not one for each shuffle partition: a file is a call of chmod, and the steps are many."""
    written = []

    def counted(df, *a):
        out = common.settle(df, *a)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "settle", counted)
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(1, 300).selectExpr("id as a", "id - 1 as b")
        assert {r.component for r in graph.components(df).collect()} == {0}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(written) > 5 and max(written) == 1


def test_common_values_in_ranges(monkeypatch):
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2)
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 50, 300, 120, 7)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:3]]
    for values in (1 << 20, 100):
        monkeypatch.setattr(near_dedup, "VALUES", values)
        assert near_dedup._common(sets[:3], sets).tolist() == want
