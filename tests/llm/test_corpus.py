"""Corpus operators against brute force on small fixtures, with nulls, empty and long texts, repeats and extra columns."""

import base64
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from cohortgrid.llm import conversation_trie, decontaminate, embedding_dedup, encoding, html_extraction, language_id, lexical_search, line_dedup, minhash_dedup, packing, token_counts, token_ids, url_filter, warc  # noqa: E402
from cohortgrid.llm.words import ALNUM, NONSPACE, Words  # noqa: E402
from cohortgrid.session import work_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}


def prose(rng, n, size=400):
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(size)]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\n", "  "]) for _ in range(n))


def edge_documents(spark, rng=None):
    rng = rng or random.Random(1)
    base = prose(rng, 120)
    texts = [None, "", " \n ", "one", "one two", base, base, base + " tail", prose(rng, 9000), "日本語 <|endoftext|> 'S x'S", "a  b\t\tc\r\nd", *(prose(rng, rng.randint(1, 60)) for _ in range(15))]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """Columns with the names that the operators use themselves."""
    return df.withColumns({c: F.lit(1) for c in ("key", "n", "v", "node", "part", "ids", "start", "line", "host", "a", "b", "component_id", "kept")})


def empty(df):
    return df.limit(0)


def components(ids, links):
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_words_equal_patterns():
    rng = random.Random(2)
    texts = [None, "", "É A-b_c9 x", "\x7fq\x00r", *("".join(rng.choice("aB9 \n\x0b\x1cé日-_.") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    for inside, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NONSPACE, r"[^\x20\x09-\x0D]+")):
        w = Words(pa.array(texts, pa.string()), inside)
        got = [[w.text(i) for i in range(a, b)] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
        assert got == [re.findall(pattern, (t or "").translate(LOWER)) for t in texts]
        assert len({*w.hash.tolist()}) == len({x for row in got for x in row})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    path = public_tokenizers.path(name)
    rng = random.Random(3)
    pieces = ["a", "B", "é", "ß ", "'s", "'S", "'", "12", " ", "  ", "\n", "\t", "…", "_", "!?", "´", "日本", "<|endoftext|>", "<|", "x.y", "I'LL", "\u00a0", "½", "Œ"]
    texts = [None, "", *("".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(600))]
    library = Tokenizer.from_file(path)
    own = encoding.Encoder(path, most_words=200)
    for _ in range(2):
        got = own.encode(texts)
        assert own.n <= 200
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids if t else [] for t in texts]


def library_ids(df, name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return {r.doc_id: np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in df.collect()}


def test_lookup_reads_row_groups(spark):
    """A document is found by reading the row group that holds it, of 8; ids between those written are ruled out by Bloom filters."""
    docs = spark.range(8000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    path = work_path(spark, "lookup")
    token_ids.write_token_ids(docs, path, public_tokenizers.path("byte_bpe_50k.json"), partitions=2)

    def read(doc_id):
        found = token_ids.lookup(spark, path, doc_id)
        rows = found.collect()
        return len(rows), found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    for doc_id in (0, 2468, 9000, 15998):
        n, scanned = read(doc_id)
        assert n == 1 and 1 <= scanned <= 1000
    absent = [read(doc_id) for doc_id in range(501, 15000, 1000)]
    assert all(n == 0 for n, _ in absent) and sum(scanned for _, scanned in absent) <= 2000
    assert read(-5) == (0, 0) and read(90_000) == (0, 0)



def test_token_ids(spark):
    df = edge_documents(spark)
    ids = library_ids(df, "byte_bpe_50k.json")
    got = {r.doc_id: r for r in token_ids.token_ids(clashing(df)).collect()}
    at = 0
    for i in sorted(ids):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids[i]), zlib.crc32(ids[i].tobytes()))
        at += len(ids[i])
    path = work_path(spark, "t")
    token_ids.write_token_ids(df, path, public_tokenizers.path("byte_bpe_50k.json"))
    assert [r.ids for r in token_ids.lookup(spark, path, 3).collect()] == [ids[3].tolist()]
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (0, None)], "doc_id long, text string")
    rows = token_ids.token_ids(repeated).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 0, 1, 1] and [r.start for r in rows] == list(itertools.accumulate([0, *[r.n_tokens for r in rows[:-1]]]))
    assert token_ids.token_ids(empty(df)).count() == 0


def test_packing(spark):
    df = edge_documents(spark)
    ids = library_ids(df, "word_bpe_49k.json")
    rows = packing.pack(clashing(df), capacity=256).collect()
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids == piece.tolist() and r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for by, place in (("doc_id", "start"), ("sequence_id", "offset")):
        for _, own in itertools.groupby(sorted(rows, key=lambda r: (r[by], r[place])), key=lambda r: r[by]):
            at = 0
            for r in own:
                assert r[place] == at
                at += r.length
            assert at <= 256 if by == "sequence_id" else at == r.doc_tokens
    assert packing.pack(empty(df)).count() == 0


def test_encoder_remembers_what_it_met_again():
    own = encoding.Encoder(public_tokenizers.path("word_bpe_49k.json"), most_words=400)
    assert own.family == "word" and encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json")).family == "byte"
    rng = random.Random(3)
    for _ in range(20):
        texts = ["often again " + "".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(6)]
        assert [x.tolist() for x in own.encode(texts)] == [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        own._make_room(350)
        kept = own.n
        assert kept <= 50
        own.encode(["often again"] * 3)
    long = "x" * 5000 + " a" + " word's 12\n" * 60000 + "é" * 700
    assert own.encode([long])[0].tolist() == own.library.encode(long, add_special_tokens=False).ids
    wide = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert wide.encode([long])[0].tolist() == wide.library.encode(long, add_special_tokens=False).ids
    assert [(int(c.sum()), int(n.sum())) for c, n in wide.leaves([long[:9000], ""])] == [(9000, len(wide.library.encode(long[:9000]).ids)), (0, 0)]


def test_redactions_are_linear_in_long_words():
    import time

    began = time.time()
    text = "a" * 300_000 + " b@c.de " + "1" * 300_000 + "x " + "a.b-" * 100_000
    assert (300_001, 6, "<mail>") in token_counts.redactions(text)
    assert time.time() - began < 5


def test_equal_rows_and_null_ids_count_alone(spark):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    assert token_counts.edit_aware_counts(clashing(df)).count() == 4
    rows = token_ids.token_ids(clashing(df)).collect()
    assert sorted((r.doc_id is None, r.start, r.n_tokens) for r in rows) in ([(False, 4, 3), (False, 7, 3), (True, 0, 1), (True, 1, 3)], [(False, 4, 3), (False, 7, 3), (True, 0, 3), (True, 3, 1)])
    pieces = packing.pack(clashing(df)).collect()
    assert sum(r.length for r in pieces) == 10 and len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)


def test_little_is_moved_out_of_its_place():
    rng, moved, total = random.Random(8), 0, 0
    for _ in range(4):
        p = packing.SumOfSquares(4096)
        for _ in range(2500):
            size = int(rng.lognormvariate(6, 1)) + 1
            total += size
            p.add((0, 0, np.zeros(size, np.uint32), size))
        p.finish()
        moved += p.moved
        sizes = [sum(len(x[2]) for x in s) for s in p.closed]
        assert all(x == 4096 or x & (x - 1) == 0 for x in sizes)
    assert moved < 0.05 * total


def test_sum_of_squares_rule():
    rng = random.Random(4)
    p = packing.SumOfSquares(64)
    for _ in range(300):
        size = rng.randint(1, 63)
        n = p.count.copy()

        def squares(g, size=size, n=n):
            m = n.copy()
            if g:
                m[g] -= 1
            if g + size < 64:
                m[g + size] += 1
            return int((m * m).sum())

        options = [g for g in range(0, 64 - size + 1) if g == 0 or n[g]]
        assert squares(p.level_for(size)) == min(map(squares, options))
        p.add((0, 0, np.zeros(size, np.uint32), size))
    p.finish()
    assert sum(len(x[2]) for s in p.closed for x in s) and not p.open
    last = [sum(len(x[2]) for x in s) for s in p.closed]
    assert all(x == 64 or x & (x - 1) == 0 for x in last if x < 20) and max(last) <= 64


def test_edit_aware_counts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rng = random.Random(5)
    texts = [None, "", "mail a.b@c.de and http://x.y/z?q, 10.0.0.1!", "call +49 (30) 1234-5678 now", *(prose(rng, 30) + " me@x.org " + prose(rng, 3000) for _ in range(3))]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, edits int")
    for r in token_counts.edit_aware_counts(df).collect():
        text = new = texts[r.doc_id] or ""
        for a, n, by in reversed(token_counts.redactions(text)):
            new = new[:a] + by + new[a + n :]
        assert (r.n_tokens, r.n_tokens_after, r.n_chars_after) == (len(library.encode(text).ids), len(library.encode(new).ids), len(new))
        assert r.n_edits == len(token_counts.redactions(text)) and r.n_encoded < 60
    assert token_counts.edit_aware_counts(df.limit(0)).count() == 0


def test_edits_of_any_kind():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    tokens, rng = encoding.encoder(path), random.Random(6)
    pieces = ["a", "b", " ", "  ", "\n", "'", "'re", "s", "1", "23", "!", "é", "\u3000", "日本", "ß ", "\t", "\r\n", "_", "<|endoftext|>", "\u0301"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        own = tokens.split(text)
        tree = token_counts.PretokenTree(np.array([len(x) for x in own], int), tokens.count(own))
        for _ in range(4):
            a = rng.randint(0, len(text))
            text, _ = token_counts.edit(tokens, text, tree, a, rng.randint(0, min(5, len(text) - a)), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 3))))
            assert (tree.chars, tree.tokens) == (len(text), len(library.encode(text, add_special_tokens=False).ids))


def test_minhash_dedup(spark):
    rng = random.Random(7)
    texts = [None, "", "one", "one", "a b c d"]
    common = prose(rng, 70)
    for _ in range(12):
        base = prose(rng, rng.choice([5, 40, 150, 900]))
        texts.append(base)
        for _ in range(rng.randint(0, 4)):
            w = base.split(" ")
            for _ in range(max(1, len(w) // rng.choice([12, 25, 60]))):
                w[rng.randrange(len(w))] = "xx" + str(rng.randint(0, 9))
            texts.append(" ".join(w))
    texts += [common + " " + prose(rng, rng.randint(3, 30)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(None, "one")], "doc_id long, text string")
    sets = {i: shingles(t, 4) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = minhash_dedup.near_duplicates(clashing(df), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert minhash_dedup.near_duplicates(empty(df)).count() == 0


def test_minhash_blocks(spark, monkeypatch):
    """Lists longer than a block are compared in full."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    rng = random.Random(8)
    common = prose(rng, 90)
    rows = [(i, common + " " + prose(rng, rng.randint(2, 14))) for i in range(40)]
    sets = {i: shingles(t, 4) for i, t in rows}
    want = components(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_embedding_dedup(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    rng = np.random.default_rng(9)
    vectors, labels = [], []
    for g in range(6):
        base = rng.normal(size=24)
        for _ in range(10):
            vectors.append((base + rng.normal(scale=0.1, size=24)).tolist())
            labels.append(g % 2)
        vectors.append(base.tolist())
        labels.append(g % 2)
        vectors.append(base.tolist())
        labels.append(g % 2)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, la) for i, (v, la) in enumerate(zip(vectors + odd, labels + [0] * len(odd)))]
    rows += [(500, vectors[0], None), (None, vectors[0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    n = len(vectors)
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    links = [(a, b) for a, b in itertools.combinations(range(n), 2) if labels[a] == labels[b] and unit[a] @ unit[b] >= 0.98] + [(n + 6, n + 7)]
    want = components([r[0] for r in rows if r[0] is not None], links)
    degree = {i: sum(i in x for x in links) for i in want}
    got = embedding_dedup.near_duplicate_vectors(df.withColumns({"key": F.lit(1), "v": F.lit(1), "node": F.lit(1)})).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == {i: (degree[i], want[i]) for i in want}
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_scale_and_repeated_ids(spark):
    rows = [(1, [1e-200, 2e-200], 0), (2, [1e-200, 2e-200], 0), (3, [1e200, 2e200], 0), (4, [2e200, 4e200], 0), (5, [5e-324, 0.0], 0), (6, [1.0, 0.0], 0)]
    rows += [(7, [0.0, 1.0], 0), (7, [-1.0, 0.0], 0), (8, [0.0, 2.0], 0), (9, [-3.0, 0.0], 0), (9, [-3.0, 0.0], 0), (10, [0.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicate_vectors(clashing(df).withColumns({"cls": F.lit(0), "weight": F.lit(0)})).collect()
    want = [(i, 3, 1) for i in (1, 2, 3, 4)] + [(5, 1, 5), (6, 1, 5), (7, 1, 7), (7, 2, 7), (8, 1, 7), (9, 2, 7), (9, 2, 7), (10, 0, 10)]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def test_recall_of_vector_links(spark):
    rng = np.random.default_rng(12)
    v = np.concatenate([b + rng.normal(scale=rng.choice([0.05, 0.12, 0.14]), size=(14, 64)) for b in rng.normal(size=(120, 64))])
    label = rng.integers(0, 2, len(v))
    table = spark.createDataFrame([(i, x.tolist(), int(la)) for i, (x, la) in enumerate(zip(v, label))], "vec_id long, embedding array<double>, label int")
    v /= np.sqrt((v * v).sum(1))[:, None]
    true = int(((v @ v.T >= 0.98) & (label[:, None] == label)).sum()) - len(v)
    found = embedding_dedup.near_duplicate_vectors(table).agg(F.sum("n_links")).first()[0]
    assert true and 0.9 * true <= found <= true


@pytest.mark.parametrize("slop", [0, 2])
def test_decontamination(spark, monkeypatch, slop):
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 3000)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    rng = random.Random(10)
    items = {i: prose(rng, rng.choice([3, 12, 25])) for i in range(12)} | {90: None, 91: "...", 92: "Ünïcode Wort"}
    docs = edge_documents(spark, rng).select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    for k in range(30):
        item = (items[k % 12] or "").split(" ")
        if slop and k % 3 == 0:
            item.insert(len(item) // 2, "zzz")
        rows.append((100 + k, prose(rng, rng.randint(0, 20)) + " " + "--".join(item) + " " + prose(rng, 9) + (" ünïcode... WORT" if k % 7 == 0 else "")))
    df = clashing(spark.createDataFrame([*rows, (None, "x")], "doc_id long, text string"))
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.search(decontaminate.build_index(df), tests, slop=slop).collect()}
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda t: re.findall(pattern, (t or "").translate(str.maketrans({chr(k): chr(v) for k, v in LOWER.items()})))
    windows = {}
    for i, t in items.items():
        w = words(t)
        for x in [tuple(w[j : j + 10]) for j in range(len(w) - 9)] or ([tuple(w)] if w else []):
            windows.setdefault(x, set()).add(str(i))
    for i, t in rows:
        w = words(t)
        hit, found = set(), set()
        for x, names in windows.items():
            for s in range(len(w)):
                e, k = s, 0
                while e < len(w) and k < len(x):  # the first place of each word in turn, as the search takes
                    if w[e] == x[k]:
                        k += 1
                    elif k == 0 or not slop:
                        break
                    e += 1
                if k == len(x) and e - s <= len(x) + slop:
                    hit |= set(range(s, e))
                    found |= names
        assert (got[i].n_words, got[i].n_hit, got[i]["items"], got[i].contaminated) == (len(w), len(hit), sorted(found), bool(hit)), i
    assert decontaminate.search(decontaminate.build_index(empty(df)), tests).count() == 0
    assert decontaminate.search(decontaminate.build_index(df), tests.limit(0)).where("n_hit > 0").count() == 0


def test_line_dedup(spark, monkeypatch):
    rows = []
    for i in range(40):
        lines = [f"own {i}", "shared by all", "", "  padded ", f"pair {i // 2}"] + (["on three sites"] if i % 10 < 3 else [])
        rows.append((i, "\n".join(lines), f"s{i % 10}" if i != 7 else None, "x"))
    rows += [(100, None, "s1", "x"), (101, "", "s1", "x"), (None, "shared by all\nz", None, "x"), (102, "  ", "s2", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, line string")
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(df, min_sites=4).collect()}
    for i, text, _, _ in rows:
        want = None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" ") not in ("shared by all", "padded"))
        assert got[i].text == want
    assert got[0].lines_removed == 2 and got[None].lines_removed == 1 and got[101].lines_removed == 0
    exact = line_dedup.boilerplate_lines(df, min_sites=3)
    assert sorted(r.sites for r in exact.collect()) == [3, 10, 10]
    assert line_dedup.remove_boilerplate(df.limit(0)).count() == 0
    once = line_dedup.remove_boilerplate(df).collect()
    twice = line_dedup.remove_boilerplate(clashing(df.union(df))).select("doc_id", "text", "lines_removed").collect()
    assert sorted(map(str, twice)) == sorted(map(str, line_dedup.remove_boilerplate(df).select("doc_id", "text", "lines_removed").collect() * 2))
    monkeypatch.setattr(line_dedup, "MOST_KEYS", 0)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 2)
    assert sorted(map(str, line_dedup.remove_boilerplate(df).collect())) == sorted(map(str, once))


def test_url_filter(spark):
    urls = [None, "", "nohost", "http://A.Example.com/en/x?q#f", "https://www.example.com/en/", "x://www.example.com/fr", "ftp://shop.net/es/1", "http://bad.org/p", "http://sub.bad.org", "http://notbad.org/p", "a://b?c://d", "http://e.org/listed", "http://e.org/other"]
    df = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
    listed = spark.createDataFrame([("bad.org",), ("e.org/listed",), ("absent.org",), (None,)], "key string")
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules, listed).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[4][2:] == ("www.example.com/en/", "allow") and got[5][2:] == ("com/", "allow") and got[6] == ("shop.net", "/es/1", "net/es/", "block")
    assert [got[i][3] for i in range(7, 13)] == ["block", "block", "allow", "allow", "block", "allow"]
    assert url_filter.judge(df.limit(0), rules, listed).count() == 0
    assert url_filter.judge(df, [], listed.limit(0)).where("verdict = 'block'").count() == 0
    twice = url_filter.judge(clashing(df.union(df).drop("key")).withColumn("host", F.lit("x")).withColumn("page_id", F.expr("nullif(page_id, 7)")), rules, listed).collect()
    assert len(twice) == 26 and sorted(r.verdict for r in twice if r.page_id is None) == ["block", "block"]


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.Cascade(universe, rate=0.4)
    assert len(cascade.levels) > 2 and sum(n > 0 for n in cascade.sizes) > 2
    assert universe.where(cascade.holds(F.col("key")) != F.col("listed")).count() == 0


def test_shards_give_the_same_answer(spark):
    asked = spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") % 1500).cast("string")).alias("key"))
    listed = asked.where("key like '%7%'").unionByName(spark.createDataFrame([("absent",), (None,)], "key string"))
    for shard_bytes in (1 << 20, 200):
        found = url_filter.membership(asked.unionByName(listed.where("key is null")), listed, shard_bytes=shard_bytes)
        assert found.count() == 3001
        assert found.where(F.col("listed") != F.coalesce(F.col("key").contains("7"), F.lit(False))).count() == 0


def test_warc(spark):
    pages = [(5, "http://b.org/x", "same"), (2, "http://A.org/y?z", "same"), (9, None, None), (3, "http://a.org/y", ""), (4, "http://a.org/y", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (7, "http://a.org/y", "x" * 200000), (8, "nohost", "tail\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "run": F.lit(1)})
    got = warc.archive_pages(df).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    for i, _, html in pages:
        data = (html or "").encode()
        assert (by[i].payload_bytes, by[i].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert {i: (r.record_type, r.refers_to) for i, r in by.items() if r.record_type == "revisit"} == {5: ("revisit", 2), 9: ("revisit", 3), None: ("revisit", 2)}
    order = [(r.url_key, r.capture_time) for r in sorted(got, key=lambda r: r.position)]
    assert order == sorted(order)
    assert got[0].__fields__[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {r.record_type for r in warc.archive_pages(df, min_bytes=10).collect()} == {"response"}
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_warc_records_by_place(spark, monkeypatch):
    """A record is found by run, offset and length; pages of unlike size are in archives of their own; repeats stay."""
    monkeypatch.setattr(warc, "SIZES", ((100, 3), (3000, 2), (1 << 31, 1)))
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 4)
    pages = [(i, f"http://h{i % 4}.org/{i}", "p" * (40 * i * i)) for i in range(14)] + [(3, "http://h3.org/3", "p" * 360), (3, "http://h3.org/3", "p" * 360), (20, "http://x.org", "p" * 360)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = work_path(spark, "warc")
    warc.write_archives(df, path)
    index = warc.merge_index(warc.read_archives(spark, path)).collect()
    assert len(index) == len(pages) and len({r.position for r in index}) == len(pages)
    order = [(r.url_key, r.capture_time, r.page_id) for r in sorted(index, key=lambda r: r.position)]
    assert order == sorted(order)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in index if r.payload_bytes == 360) == [(3, "response", None)] * 3 + [(20, "revisit", 3)]
    stored = {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).collect()}
    for r in index:
        record = warc.read_record(stored[r.run], r.offset, r.length)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"page:{r.page_id}>".encode() in record
        if r.record_type == "response":
            assert record[:-4].endswith(b"p" * r.payload_bytes)


def test_loser_tree():
    rng = random.Random(11)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_language_id(spark):
    rng = random.Random(12)
    lexicon = {"de": "der die und nicht ist für über schön", "en": "the and of with this that which have", "es": "el los una niño señor pero que como", "fr": "le les une être où çà mais avec"}
    text = lambda la: " ".join(rng.choice(lexicon[la].split()) for _ in range(rng.randint(5, 40)))
    rows = [(i, text(la), la, f"s{i % 3}", None) for i, la in enumerate(list(lexicon) * 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit(df.where("doc_id < 60"))
    found = {r.key: r for r in language_id.identify(language_id.document_evidence(df).withColumn("declared", F.lit(None)), model).collect()}
    keys = df.select("lang", F.xxhash64("doc_id", "lang", "source", "text").alias("key"), "doc_id").collect()
    held = [found[r.key].language == r.lang for r in keys if r.doc_id >= 60]
    assert np.mean(held) > 0.97 and all(r.accepted for r in found.values())
    odd = spark.createDataFrame([(1, None, "de", None, None), (2, "123 !", None, "x", None), (3, "the and of", None, None, None)], SCHEMA)
    got = sorted((r.language, r.accepted) for r in language_id.identify(language_id.document_evidence(odd), model).collect())
    assert got == [("en", True), ("und", False), ("und", False)]
    page = spark.createDataFrame([(1, "http://x.fr/a", '<html lang="fr"><script>the the the</script><p>le les une avec mais</p>'), (2, None, None)], "page_id long, url string, html string")
    assert sorted(r.language for r in language_id.identify(language_id.page_evidence(page), model).collect()) == ["fr", "und"]
    assert language_id.identify(language_id.document_evidence(df.limit(0)), model).count() == 0


def test_fusion_equals_brute_force(spark):
    """Priors, own shares taken out, reliability of the declared language and the fused posterior, recomputed row by row."""
    rng = random.Random(21)
    lexicon = {"de": "der die und nicht ist für über schön", "en": "the and of with this that which have", "fr": "le les une être où çà mais avec", "it": "il gli una perché che sono anche"}
    docs = spark.createDataFrame([(i, " ".join(rng.choices(lexicon[la].split(), k=20)), la.upper() if i % 2 else la, "s", None) for i, la in enumerate(list(lexicon) * 20)], SCHEMA)
    model = language_id.fit(docs)
    assert model.languages == sorted(lexicon)
    rows = []
    for i in range(120):
        words = [w for la in rng.sample(sorted(lexicon), 2) for w in rng.choices(lexicon[la].split(), k=rng.randint(1, 3))]
        rows.append((i, rng.choice([None, "", "12", "цитата слова", " ".join(words), " ".join(words)]), rng.choice([None, "de", "en", "xx"]), rng.choice([None, "de", "org"]), rng.choice([None, "a.de", "b.org", "c.org"])))
    rows += [(200, "und nicht the", "de", "de", "a.de")] * 2
    table = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string")
    got = language_id.identify(clashing(table.withColumnsRenamed({"key": "k", "host": "h"})).withColumns({"key": F.col("k"), "host": F.col("h")}), model).collect()

    names, logs = model
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    lls, ps, known = [], [], []
    for _, text, *_ in rows:
        _, code = language_id.trigrams(pa.array([text], pa.string()))
        ll = logs[:, code].sum(1) * language_id.TEMPER
        known.append(len(code) > 0 and ll.max() >= len(code) * language_id.background(logs) * language_id.TEMPER)
        lls.append(ll - ll.max())
        ps.append(soft(ll) if known[-1] else np.zeros(len(names)))
    total = sum(ps)
    base = (total + 1) / (total.sum() + len(names))
    sums = [{}, {}, {}]
    for r, p in zip(rows, ps):
        for by, value in zip(sums, r[2:]):
            if value is not None:
                by[value] = by.get(value, 0) + p
    want = []
    for r, p, ll, ok in zip(rows, ps, lls, known):
        prior = base
        for by, value in ((sums[1], r[3]), (sums[2], r[4])):
            if value is not None:
                own = np.maximum(by[value] - p, 0)
                prior = (own + prior * 20) / (own.sum() + 20)
        met = (np.maximum(sums[0][r[2]] - p, 0) + 1) / (total + 1 + len(sums[0])) if r[2] is not None else np.ones(len(names))
        fused = soft(ll + np.log(prior) + np.log(met))
        want.append((r[0], names[int(fused.argmax())] if ok else "und", bool(ok and fused.max() >= 0.5), fused.max()))
    assert len(got) == len(rows)
    for a, b in zip(sorted((r.key, r.language, r.accepted, r.confidence) for r in got), sorted(want)):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-5
    assert {r[1] for r in want} > {"und", "de", "en"}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(13)
    item = prose(rng, 14)
    long = prose(rng, 200)
    rows = [(i, prose(rng, 60), "en", f"s{i % 12}", 1) for i in range(24)] + [(50, long, "en", "s1", 1), (51, long + " x", "en", "s2", 1), (52, prose(rng, 30) + " " + item, "en", "s1", 1), (53, "12 34", "en", "s1", 1), (54, None, None, None, None)]
    rows = [(i, t if t is None or i >= 53 else t + "\nfooter of many sites", la, s, n) for i, t, la, s, n in rows]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    ids = {r.doc_id for r in docs.collect()}
    assert ids == {*range(24), 50}
    assert docs.where(F.col("text").contains("footer")).count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(17)
    names = ["key", "doc_key", "doc", "row", "lines_before", "lines_removed", "_row", "bad", "a.b"]
    rows = [(i, prose(rng, 40) + "\nfooter of many sites", "en", f"s{i % 12}", 1, *(f"{c}{i}" for c in names)) for i in range(24)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in names))
    spark.createDataFrame([(1, "never seen here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert sorted((r[0], *r[5:]) for r in out.collect()) == sorted((r[0], *r[5:]) for r in rows)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.packing(spark, docs, "").select("doc_id").distinct().count() == 24


def test_near_duplicates_of_repeated_ids(spark):
    """Against brute force: a document's texts count together, whichever of them is linked."""
    rng = random.Random(18)
    base = [prose(rng, 60) for _ in range(12)]
    rows = [(1, base[0]), (2, base[0]), (2, base[1]), (3, base[1]), (3, base[2] + " x"), (9, base[2]), (None, base[2]), (None, None), (4, None), (4, ""), (5, "a b c d e"), (5, "a b c d e"), (6, base[3]), (6, base[4])]
    rows += [(rng.randint(20, 60), rng.choice(base[5:]) + rng.choice(["", " tail", " other words at the end of it all"])) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash_dedup.near_duplicates(clashing(df)).collect()), key=str)
    sets = [(i, shingles(t, 5)) for i, t in rows]
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(sets, 2) if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b)]
    comp = components({i for i, _ in rows if i is not None}, links)
    assert got == sorted(((i, len(s), comp.get(i), i is None or comp[i] == i) for i, s in sets), key=str)


def test_lines_of_a_long_document(spark):
    """Thousands of boilerplate lines in a document take no longer than as many in many documents."""
    lines = [f"boilerplate number {i}" for i in range(4000)]
    rows = [(i, "\n".join(x for j, x in enumerate(lines + [f"own {i}", ""] + lines) if j % 7 or i), f"s{i}") for i in range(12)]
    began = time.time()
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: f"own {i}\n" for i in range(12)}
    assert time.time() - began < 30


def test_rare_languages_are_fitted(spark):
    rows = [(i, "the and of with", "en", "s", 1) for i in range(3000)] + [(5000, "kaikki ihmiset ovat", "fi", "s", 1)]
    assert language_id.fit(spark.createDataFrame(rows, SCHEMA)).languages == ["en", "fi"]


def test_pipeline_dedup_of_repeated_ids(spark):
    """Rows go by their id and text: a clean text under a repeated id stays, and so does one row of each group."""
    import corpus_pipeline

    rng = random.Random(14)
    a, b, x, y, z = (prose(rng, 40) for _ in range(5))
    rows = [(1, b), (5, a), (5, b), (7, x), (7, x), (None, y), (None, y), (None, z), (9, z + " tail"), (None, None), (None, None), (8, ""), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    got = corpus_pipeline.minhash_dedup(spark, docs, "")
    want = [(1, b), (5, a), (7, x), (None, y), (9, z + " tail"), (None, None), (None, None), (8, ""), (8, "")]
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))
    assert corpus_pipeline.minhash_dedup(spark, docs.limit(0), "").count() == 0


def test_language_of_none(spark):
    """Text in none of the fitted languages is rejected, whatever else speaks for one of them."""
    rng = random.Random(15)
    lexicon = {"de": "der die und nicht ist für über schön", "en": "the and of with this that which have", "es": "el los una niño señor pero que como", "fr": "le les une être où çà mais avec"}
    df = spark.createDataFrame([(i, " ".join(rng.choices(lexicon[la].split(), k=30)), la, "s", None) for i, la in enumerate(list(lexicon) * 30)], SCHEMA)
    model = language_id.fit(df)
    odd = ["Все люди рождаются свободными и равными", "人人生而自由,在尊严和权利上一律平等", "Kaikki ihmiset syntyvät vapaina ja tasavertaisina", "qwpx zxcvk jkjhg fghjk wqrtz"]
    rows = df.unionByName(spark.createDataFrame([(1000 + i, t, "en", "s", None) for i, t in enumerate(odd)], SCHEMA))
    keys = {r.key: r.doc_id for r in rows.select("doc_id", F.xxhash64("doc_id", "lang", "source", "text").alias("key")).collect()}
    found = {keys[r.key]: r for r in language_id.identify(language_id.document_evidence(rows), model).collect()}
    assert [(found[1000 + i].language, found[1000 + i].accepted) for i in range(len(odd))] == [("und", False)] * len(odd)
    assert all(found[i].accepted for i in range(120))


def test_language_query_covers_pages(spark, tmp_path):
    from cohortgrid.llm.queries import op3_language_id

    spark.createDataFrame([(1, "the and of with this that", "en", "s", 1), (2, "le les une avec mais où", "fr", "s", 1)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    pages = [(7, "http://x.fr/a", '<html lang="fr"><p>le les une avec mais</p>'), (7, "http://x.org/b", "<p>the and of with</p>"), (None, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.doc_id or 0, r.page_id or 0, r.language) for r in op3_language_id(spark, str(tmp_path)).collect())
    assert got == [(0, 0, "und"), (0, 7, "en"), (0, 7, "fr"), (1, 0, "en"), (2, 0, "fr")]


def brute_trie(rows):
    """All nodes of the rebuilt conversations ``(conv_id, turn, role, text)``."""
    given, out = {}, []
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            given.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in given.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + own[c][h:])
    members, below = {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for s in members:
        if s:
            below.setdefault(s[:-1], []).append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves[s] = sum(leaves[x] for x in below.get(s, ())) or 1
        saved[s] = sum(saved[x] for x in below.get(s, ())) + (len(members[s]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[s]) if len(whole[c]) == len(s))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(below.get(s, ())), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2] + r[3:])


def test_conversation_trie(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(None, 1, "user", "x"), *((c, t, "user", f"w{t} x") for c in (200, 201, 220) for t in range(300))]
    for c in [*range(-45, 140), 1000, 1020, 1021]:
        if c != 40:
            rows += [(c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d  e\tf"])) for t in range(rng.choice([1, 1, 2, 3, 4, 6]))]
    rows += rows[-30:]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    wanted = brute_trie(rows)
    found = lambda *sizes: sorted((tuple(r) for r in conversation_trie.prefix_trie(conversation_trie.rebuild(clashing(df)), *sizes).collect()), key=lambda r: r[:2] + r[3:])
    assert found() == wanted
    # Few members make a spine and few nodes a shard; long conversations are hashed in stretches.
    monkeypatch.setattr(conversation_trie, "STRETCH", 50)
    assert found(5, 10) == wanted
    monkeypatch.setattr(conversation_trie, "SPINE", 10**9)
    assert found(1, 3) == wanted
    assert conversation_trie.prefix_trie(conversation_trie.rebuild(empty(df))).count() == 0


def test_parentheses_close():
    rng = random.Random(5)
    for n in (1, 2, 3, 200, 4000):
        opening, depth = [], 0
        while len(opening) < 2 * n:
            left = 2 * n - len(opening)
            up = depth == 0 or (depth < left and rng.random() < (0.9 if len(opening) < n // 2 else 0.5))
            opening.append(up)
            depth += 1 if up else -1
        stack, wanted = [], {}
        for i, up in enumerate(opening):
            if up:
                stack.append(i)
            else:
                wanted[stack.pop()] = i
        opens = np.array(sorted(wanted))
        assert conversation_trie.Parentheses(np.array(opening)).find_close(opens).tolist() == [wanted[i] for i in opens]


PAGE = """<html><head><title>T</title><body class=has-sidebar><header><h1>Site</h1><p>The tag line of a site that has one</p></header>
<nav><a href=x>Home</a></nav><div class="cookie-notice"><p>We use cookies on this site for all sorts of things, you know.</p></div>
<div id=wrap class="layout sidebar"><article class="post-12"><header><h1>Title &amp; more</h1><span>by me</span></header><p>First,<br>a  paragraph
that is &lt;long&gt; enough.<p>Second <b>bold <i>text</b> here is long enough too <span class=share>Share!</span><ul><li>one<li><p>two</ul>
<table><tr><td>a<td>b<tr><td>c</table><form>email <input></form><div class='ad'>buy</div><script>var t="</p>";</script><style>p{}</style><!-- <p>no</p> -->
<blockquote>quo&nbsp;te</blockquote><div hidden>unseen</div></article></div>
<section id=comments><article class=comment><p>I agree with this article, says a comment that is rather long, longer than all else, and I go on to say so
again and again, since comments may well be longer than what they comment on.</p></article></section><aside>side</aside><footer>&copy;</footer>"""
MAIN = ["Title & more", "First, a paragraph that is <long> enough.", "Second bold text here is long enough too", "one", "two", "a b", "c", "quo te"]


def test_html_extraction(spark):
    plain = "<div class=x{0}><p>{1}</p></div><div class=main{0}><h2>Head {0}</h2><p>{2}</p></div>"
    long, short = "A sentence of the text that is long enough to be one. " * 8, "Another box with some words in it."
    rows = [(1, "http://a.b/1", PAGE), (2, "http://a.b/2", None), (3, None, ""), (4, "http://a.b/2", "no markup\n at all"), (4, "http://a.b/2", "no markup\n at all"), (None, "x", "<p title='a>b'>t</p><p>&#x41;&nbsp;")]
    rows += [(10 + i, "http://c.d/", plain.format(i, short, long)) for i in range(5)]
    # The consensus: on this page alone the other box would win.
    rows += [(20, "http://c.d/", plain.format(7, long, "Little."))]
    rows += [(30, "http://e.f/", "<p>" + "x<b>y " * 20000), (31, "http://e.f/", "<p title='" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extraction.extract(clashing(df)).collect()
    texts = {r.page_id: r.text for r in got}
    assert texts[1].split("\n\n") == MAIN and texts[2] == texts[3] == "" and texts[4] == "no markup at all" and texts[None] == "t\n\nA"
    assert [texts[10 + i].split("\n\n") for i in range(5)] == [[f"Head {i}", long.strip()] for i in range(5)]
    assert texts[20] == "Head 7\n\nLittle." and texts[30] == ("xy " * 20000).strip()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert html_extraction.extract(empty(df)).count() == 0
    # Too many hosts to send to all tasks are joined.
    kept, html_extraction.MOST_BYTES = html_extraction.MOST_BYTES, 0
    assert sorted(map(tuple, html_extraction.extract(df).collect()), key=str) == sorted(map(tuple, got), key=str)
    html_extraction.MOST_BYTES = kept


def brute_search(docs, queries, k):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(i, Counter(pattern.findall((t or "").translate(LOWER)))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    frequency = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(queries):
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in pattern.findall((text or "").translate(LOWER)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("short", [1, 128])
def test_lexical_search(spark, monkeypatch, short):
    rng = random.Random(6)
    base = edge_documents(spark).select("doc_id", "text").collect()
    docs = [(r.doc_id, r.text) for r in base] + [(100 + i // 2, prose(random.Random(i % 7), rng.randint(0, 80), 60)) for i in range(400)] + [(None, base[6].text)]
    queries = [(1, base[6].text[:200]), (1, base[6].text[:200]), (2, "one two One"), (3, None), (4, "..."), (None, "never-seen"), (5, docs[40][1]), (6, docs[60][1] + " " + docs[77][1]), (6, "two")]
    monkeypatch.setattr(lexical_search, "SEGMENT_BYTES", 4000)
    monkeypatch.setattr(lexical_search, "SHORT", short)
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(queries, "item_id long, text string")
    index = lexical_search.build_index(clashing(df))
    wanted = brute_search(docs, queries, 10)
    assert sorted(map(tuple, lexical_search.search(index, clashing(asked)).collect()), key=str) == wanted
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, lexical_search.search(index, asked).collect()), key=str) == wanted
    assert lexical_search.search(index, empty(asked)).count() == 0
    assert lexical_search.search(lexical_search.build_index(empty(df)), asked).count() == 0
