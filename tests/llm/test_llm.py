"""The training-data operators against brute force, exact round trips and held-out labels."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import bpe, chunked_bpe, components, divergence, exact, minhash, packing, periodic, planes, repeats, rlz, simhash, sketches, suffixes, toxicity, warc
from tallyloom.llm.queries import QUERIES, SQL, periodic_columns, vocabulary
from tests.check_sql import compare, connect
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row string, th int, fp double, n_chars long"


def table(spark, rows, parts=3):
    """Documents with extra columns whose names clash with the operators' own."""
    full = [(d, t, "x", None, 1.5, len(t or "")) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "One two"), (5, "one TWO"), (6, "one two"), (6, "one two"), (None, "one two"), (None, None), (7, long), (8, long), (8, long), (9, "Ünï cödé ß 日本 語 \U0001f600 é"), (9, "another text of the same id"), (10, "word"),
    ]


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def plain(spark):
    return [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]


def both(spark):
    return [(table(spark, odd_rows()), odd_rows()), (documents(spark), plain(spark))]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) == ""


def test_empty_tables(spark, tmp_path):
    none = table(spark, [])
    assert packing.pack(none, vocabulary("byte_bpe_50k.json")).count() == 0
    assert exact.dedup(none).count() == exact.keep_one(none).count() == 0
    assert simhash.near_groups(none).count() == simhash.keep_one(none).count() == minhash.near_groups(none).count() == 0
    assert divergence.audit(none.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))).count() == periodic.collapsed(none).count() == 0
    planes.write_tokens(none, str(tmp_path / "t"), vocabulary("byte_bpe_50k.json"))
    assert planes.read_documents(spark, str(tmp_path / "t")).count() == planes.shard_starts(spark, str(tmp_path / "t")).count() == 0
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.parsed(warc.read_records(spark, str(tmp_path / "w"))).count() == 0
    assert rlz.removed(none).count() == suffixes.removed(none).count() == suffixes.without_repeats(none).count() == 0
    assert chunked_bpe.encode_decode(none, vocabulary("word_bpe_49k.json")).count() == 0
    assert sketches.fingerprints(none).count() == 0
    model = toxicity.learn(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.scores(none, model).count() == toxicity.accepted(none, model).count() == 0


# 1 ----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("top", [1, 16, 1024])
def test_pieces(top):
    for n in range(0, 3000, 7):
        lengths = packing.piece_lengths(n, top)
        assert sum(lengths) == n and all(x <= top and x & (x - 1) == 0 for x in lengths)
        assert all(c == 1 for x, c in Counter(lengths).items() if x < top)


def test_packing(spark):
    tok = bpe.load(vocabulary("byte_bpe_50k.json"))
    for docs, rows in both(spark):
        want = Counter()
        for d, t in rows:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
            at = 0
            for n in packing.piece_lengths(len(ids), 1024):
                want[(d, at, n, len(ids), brute.crc_ids(ids[at : at + n]))] += 1
                at += n
        got = packing.pack(docs, vocabulary("byte_bpe_50k.json")).withColumn("crc", F.crc32("ids")).collect()
        assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.crc) for r in got) == want
        assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
        assert all(1 << r.bucket == r.length for r in got)


def test_byte_encoder_is_exact():
    path, rnd = vocabulary("byte_bpe_50k.json"), random.Random(1)
    tok, own = bpe.load(path), bpe.ByteBpe(path)
    bits = [" ", "  ", "\n", "\t", "a", "é", "Z", "12", ".", ",", "'s", "'", "<|endoftext|>", " ", "\x1c", "日本", "\r\n", "!!", "word", "\U0001f600", " ", " \n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert own.encode(text) == bpe.packed(tok.encode(text, add_special_tokens=False).ids), repr(text)


# 2 ----------------------------------------------------------------------------------------------
def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 2500):
        a, b = rng.integers(0, 1 << 28, n), rng.integers(1, 1 << 28, n)
        group = rng.integers(0, max(1, n // 4), n)
        pilots, slots = exact.find_pilots(a, b, group)
        assert sorted(slots) == list(range(n))
        assert n == 0 or (((a + pilots * b) % exact.PRIME % n) == slots).all()
        assert all(len(set(pilots[group == g])) == 1 for g in set(group))


def test_keys_with_small_steps_find_a_slot():
    """Consecutive pilots move these keys by 2 alone, to even slots until the step wraps after 2**30 pilots."""
    n = 64
    a, b, group = np.arange(n) * 2, np.full(n, 2), np.arange(n)
    pilots, slots = exact.find_pilots(a, b, group)
    assert sorted(slots) == list(range(n))
    assert (((a + pilots * b) % exact.PRIME % n) == slots).all()


def test_exact_dedup(spark):
    for docs, rows in both(spark):
        groups = defaultdict(list)
        for d, t in rows:
            groups[brute.low(t)].append(d)
        want = Counter()
        for t, ids in groups.items():
            keep = max((d for d in ids if d is not None), default=None)
            for d in ids:
                want[(d, keep, len(ids), hashlib.sha256(t.encode()).hexdigest())] += 1
        got = exact.dedup(docs).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        kept = [r for r in got if r.kept]
        assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
        left = exact.keep_one(docs)
        assert left.columns == docs.columns
        assert Counter((r.doc_id, brute.low(r.text)) for r in left.collect()) == Counter((max((d for d in ids if d is not None), default=None), t) for t, ids in groups.items())


def test_nonmembers_and_members(spark):
    rows = spark.createDataFrame([(i, i, hashlib.sha256(str(i % 50).encode()).hexdigest()) for i in range(200)], "doc_id long, row long, digest string")
    for edge in (0, 30, 170, 200):
        got = {r.digest: (r.win.doc_id, r.n) for r in exact.decide(rows.where(f"doc_id < {edge}"), rows.where(f"doc_id >= {edge}")).collect()}
        assert got == {hashlib.sha256(str(k).encode()).hexdigest(): (150 + k, 4) for k in range(50)}


def test_history_of_digests_with_small_steps(spark):
    digests = [f"{0:014x}{2 * i:07x}{1:07x}{i // 4:07x}{i:029x}" for i in range(64)]  # the shard, a, b - 1, the group, the rest
    rows = spark.createDataFrame([(i, i, digests[i % 64]) for i in range(128)], "doc_id long, row long, digest string")
    got = {r.digest: (r.win.doc_id, r.n) for r in exact.decide(rows.where("doc_id >= 64"), rows.where("doc_id < 64")).collect()}
    assert got == {d: (64 + i, 2) for i, d in enumerate(digests)}
    slots, shards = exact.build_index(exact._groups(rows.where("doc_id >= 64")))
    assert exact.look_up(slots, shards, exact._groups(rows)).where("member").count() == 64


# 3 ----------------------------------------------------------------------------------------------
def test_simhash(spark):
    for docs, rows in both(spark):
        prints = [(d, brute.simhash(t, 3)) for d, t in rows]
        lows, n = brute.groups_of(prints, 2)
        want = Counter((d, f"{p:016x}", c) for (d, p), c in zip(prints, lows))
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(docs).collect()) == want
        left = simhash.keep_one(docs, words=3, most=2, segments=2)
        assert left.columns == docs.columns
        assert left.count() == n


@pytest.mark.parametrize("most,segments,hot", [(2, 2, 64), (2, 2, 1), (3, 2, 64), (3, 3, 1), (5, 3, 2), (6, 4, 64), (1, 1, 64), (0, 2, 1)])
def test_links_are_complete(spark, monkeypatch, most, segments, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rnd = random.Random(most)
    base = [rnd.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    prints = set(base)
    for b in base:
        for _ in range(12):
            prints.add(b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, most + 1))))
    prints = sorted(simhash._signed(p) for p in prints)
    want = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= most}
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), most, segments).collect()
    assert sorted((r.a, r.b) for r in got) == sorted(want)


@pytest.mark.parametrize("hot", [1, 4096])
def test_balls_are_not_broadcast(spark, monkeypatch, hot):
    """A ball has the size of its fingerprint to Spark, however many values it holds."""
    plans, stored = [], simhash.stored

    def seen(df, name):
        if name == "met":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "stored", seen)
    assert [tuple(r) for r in simhash.links(spark.createDataFrame([(0,), (3,), (255,)], "fp long")).collect()] == [(0, 3)]
    assert len(plans) == (2 if hot == 1 else 1) and all("SortMergeJoin" in p for p in plans)
    assert not any("Inner" in line and "Broadcast" in line for p in plans for line in p.splitlines())


def test_spans_are_not_broadcast(spark, monkeypatch):
    """Stored spans take many times the size of their files in memory."""
    plans, stored = [], repeats.stored

    def seen(df, name):
        if name == "spans":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(repeats, "stored", seen)
    shared = " ".join(f"w{i}" for i in range(70))
    docs = table(spark, [(1, f"a {shared} b"), (2, f"c {shared} d"), (3, "other words")])
    cut = suffixes.without_repeats(docs, width=50, gram=12, kind="words")
    plans.append(cut._jdf.queryExecution().sparkPlan().toString())
    joins = [[line for line in p.splitlines() if "Join" in line and keys in line] for p, keys in zip(plans, ("[h#", "LeftOuter"))]
    assert len(plans) == 2 and any("SortMergeJoin" in x and x.count("#") == 6 for x in joins[0]) and all("SortMergeJoin" in x for x in joins[1]) and joins[1]
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == [(1, "a b"), (2, "c d"), (3, "other words")]


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)] + [(-5, -5), (-9, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != -5}


# 4, 9 -------------------------------------------------------------------------------------------
def repetitive(seed, n, letters, least, most):
    """Short documents of few letters with shared, nested and overlapping passages."""
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice(letters) for _ in range(rnd.randint(least, most))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, most))) if rnd.random() < 0.6 else rnd.choice(passages)[rnd.randint(0, 3) :] for _ in range(rnd.randint(0, 4))]
        rows.append((rnd.choice([i, i, i, i // 2, None]), "".join(parts)))
    return rows + [(500, letters[0] * 90), (501, letters[0] * 60), (502, None), (503, "")]


def check_words(spark, docs, rows, width, gram):
    want = Counter((d, len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode()) for d, w, g in brute.earlier_windows(rows, width))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in rlz.removed(docs, width, gram).collect())
    assert got == want


def check_bytes(spark, docs, rows, width, gram):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(docs, width, gram).collect())
    assert got == Counter(brute.repeated_bytes(rows, width))


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 256), (3, 3), (4, 2), (5, 1)])
def test_substrings_of_few_letters(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repetitive(seed, 70, "ab" if seed % 2 else "abcdefgh", 12, 60)
    check_bytes(spark, table(spark, rows), rows, 16, 4)
    spaced = [(d, " ".join(t) if t else t) for d, t in rows]
    check_words(spark, table(spark, spaced), spaced, 12, 4)


def test_substrings(spark):
    for docs, rows in both(spark):
        check_words(spark, docs, rows, 50, 12)
        check_bytes(spark, docs, rows, 400, 40)
    docs = table(spark, odd_rows())
    for kind in ("bytes", "words"):
        left = suffixes.without_repeats(docs, kind=kind)
        assert left.columns == docs.columns and left.count() == docs.count()
        assert all(r.n_chars == len(r.text) for r in left.collect())


@pytest.mark.parametrize("seed,hot", [(6, 256), (7, 2)])
def test_repeated_words_are_cut(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [(d, "  ".join(t) + "\n" if t else t) for d, t in repetitive(seed, 60, "abcd", 12, 60)]
    got = Counter(tuple(r.text.split()) for r in suffixes.without_repeats(table(spark, rows), 12, 4, "words").collect())
    want = [tuple(w.decode() for w, g in zip(*found) if not g) for found in brute.repeated_words([t for _, t in rows], 12)]
    assert got == Counter(want)


def test_passages_of_51_words_between_unlike_documents(spark):
    rnd = random.Random(51)
    word = lambda: f"w{rnd.randrange(10**5)}"
    passage = [word() for _ in range(51)]
    rows = [(i, " ".join([word() for _ in range(80)] + (passage if i % 3 == 0 else []) + [word() for _ in range(40)])) for i in range(30)]
    assert len(" ".join(passage)) < 400
    for r in suffixes.without_repeats(table(spark, rows), 50, 12, "words").collect():
        text = dict(rows)[r.doc_id]
        assert r.text == text.replace(" ".join(passage) + " ", "")


def test_long_documents_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SHALLOW", 8)
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcde ") for _ in range(700_000))
    rows = [(1, text), (2, text[300_000:300_900] + "x" + text[600_000:600_450])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.removed(table(spark, rows, 1)).collect()}
    assert got == {1: (1350, 2), 2: (1350, 2)}
    words = " ".join(rnd.choice(["ab", "c", "de"]) + str(rnd.randint(0, 99)) for _ in range(620_000)).split()
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[500_000:500_070], "y", *words[523_000:524_500]]))]
    got = {r.doc_id: r.n_removed for r in rlz.removed(table(spark, rows, 1)).collect()}
    assert got == {1: 0, 2: 1570}


@pytest.mark.parametrize("shallow", [0, 8, 64])
def test_suffix_order(shallow):
    rnd = random.Random(shallow)
    for n in (0, 1, 2, 50, 300):
        strings = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 40))) for _ in range(n)]
        strings += [s[: rnd.randint(0, len(s))] for s in strings]
        assert [strings[i] for i in suffixes.deep_shallow_order(strings, shallow)] == sorted(strings)


def test_greedy_factors():
    ref = rlz.Reference(4, 2)
    ref.add(list(range(10)))
    ref.add([3, 4, 99, 98, 97])
    assert ref.parse([50, 2, 3, 4, 99, 98, 97]) == [(0, 1), (1, 3), (4, 3)]
    assert ref.covered([50, 2, 3, 4, 99, 98, 97]) == [(2, 6), (3, 7)]  # the first crosses a boundary


# 5 ----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("kind,block", [("byte", 16_384), ("bit", 37)])
def test_token_files(spark, tmp_path, kind, block):
    tok = bpe.load(vocabulary("byte_bpe_50k.json"))
    for k, (docs, rows) in enumerate(both(spark)):
        path = str(tmp_path / f"{kind}{k}")
        planes.write_tokens(docs, path, vocabulary("byte_bpe_50k.json"), block=block, chunk_ids=500, kind=kind)
        got = planes.read_documents(spark, path).join(planes.shard_starts(spark, path), "shard").collect()
        want = Counter((d, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in rows)
        assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
        at = 0
        for r in sorted(got, key=lambda r: r.first + r.base):
            assert r.first + r.base == at
            at += r.n_tokens
        ids = [r.doc_id for r in sorted(got, key=lambda r: r.first + r.base)]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


# 6 ----------------------------------------------------------------------------------------------
def test_chunked_encoding(spark):
    path, rnd = vocabulary("word_bpe_49k.json"), random.Random(2)
    tok, own = bpe.load(path), chunked_bpe.WordBpe(path)
    bits = [" ", "\n", "\t", "Ab", "É", "é", "7", ",", ".", "'S", "<|endoftext|>", "<|startoftext|>", " ", "\x1c", "日本", "ΣΑΣ", "\r", "!?", "İ", "\U0001f600", "word, and words. "]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + [t or "" for _, t in odd_rows()] + [t for _, t in plain(spark)]
    for t in texts:
        ids = tok.encode(t, add_special_tokens=False).ids
        data = np.frombuffer(t.encode(), np.uint8)
        assert own.encode(data, chunked_bpe.chunk_ends(data)) == (bpe.packed(ids), tok.decode(ids, skip_special_tokens=False)), repr(t)
    assert own.reused > 0
    for docs, rows in both(spark):
        got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in chunked_bpe.encode_decode(docs, path).collect())
        encoded = [(d, tok.encode(t or "", add_special_tokens=False).ids) for d, t in rows]
        assert got == Counter((d, len(i), bpe.packed(i), tok.decode(i, skip_special_tokens=False)) for d, i in encoded)


@pytest.mark.parametrize("text", ["DALİ.", "तरक़,", "DALİ, DALİ", "तरक़.", "né, né.", "e\u0301, E\u0301."])
def test_marks_left_by_the_normaliser(text):
    path = vocabulary("word_bpe_49k.json")
    tok, own = bpe.load(path), chunked_bpe.WordBpe(path)
    data = np.frombuffer(text.encode(), np.uint8)
    assert own.encode(data, chunked_bpe.chunk_ends(data))[0] == bpe.packed(tok.encode(text, add_special_tokens=False).ids)


# 7 ----------------------------------------------------------------------------------------------
def test_archive_of_odd_pages(spark, tmp_path):
    big = "<p>" + "é" * 600
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (2, "http://c", big), (None, None, big), (3, "u", None), (4, "u", ""), (5, None, "x\r\n\r\ny"), (6, "u", "x\r\n\r\ny")]
    path = str(tmp_path / "w")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    records = warc.read_records(spark, path)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.parsed(records).collect())
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    n = len(big.encode())
    want = [(1, n, digest(big), "revisit", 2), (2, n, digest(big), "response", None), (2, n, digest(big), "revisit", 2), (None, n, digest(big), "revisit", 2)]
    want += [(d, len((t or "").encode()), digest(t), "response", None) for d, _, t in rows[4:]]
    assert got == Counter(want)
    for r in records.collect():
        head, _, body = r.record.encode().partition(b"\r\n\r\n")
        size = int(head.partition(b"Content-Length: ")[2].split(b"\r\n")[0])
        assert len(body) == size + 4 and body.endswith(b"\r\n\r\n")


# 8 ----------------------------------------------------------------------------------------------
def test_automaton_finds_one_edit():
    terms = ["idiots", "imbecile", "scum", "moron", "chlla*"]
    lexicon = toxicity.Lexicon(terms)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def disguised(t):
        """All words that a disguising edit makes of a term, symbols as 1."""
        swapped = {t[:i] + t[i + 1] + t[i] + t[i + 2 :] for i in range(len(t) - 1)} - {t}
        return swapped | {t[:i] + "1" + t[i + 1 :] for i in range(len(t))} | {t[: i + 1] + t[i:] for i in range(len(t))}

    def kind(w):
        if w in terms or w.startswith("chlla"):
            return toxicity.EXACT
        if any(w in disguised(t) for t in terms[:4]):
            return toxicity.DISGUISED
        return toxicity.EDITED if edits(w, "imbecile") <= 1 else toxicity.NONE

    rnd = random.Random(4)
    words = {"".join(rnd.choice("idotx1") for _ in range(rnd.randint(3, 7))) for _ in range(3000)} | {"idiot", "idoits", "id1ots", "idiots", "idits", "scum", "scam", "scumm", "csum", "chllaxyz", "chllx", "chlla", "m0ron", "mor1n", "moorn", "morron"}
    for t in ("imbecile", "idiots", "moron", "chlla"):
        for _ in range(800):
            i = rnd.randrange(len(t))
            words.add(rnd.choice([t[:i] + rnd.choice("abcehilm1") + t[i + rnd.randint(0, 1) :], t[:i] + t[i + 1 :], t[:i] + t[i + 1 : i + 2] + t[i : i + 1] + t[i + 2 :]]))
    for w in words:
        assert lexicon.holds(w) == kind(w.replace("0", "1")), w
    assert lexicon.counts("You idiots!") == (1, 0, 0, 0) and lexicon.counts('He said "idiots" twice') == (0, 1, 0, 0) and lexicon.counts("") == (0, 0, 0, 0)
    assert lexicon.counts("you m0ron, imbexile") == (0, 0, 1, 1)


def test_misspelled_insults_are_caught(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.learn_without_held_out(docs, labels)
    again = toxicity.learn_without_held_out(docs.repartition(7), labels.repartition(5))
    assert (model.terms, model.weights) == (again.terms, again.weights)
    clean = "the people of this town are at the market and we talk about the weather"
    bad = ["idiiot", "m0ron", "tr4sh", "scmu", "l0ser", "wh0re", "b1tch", "worthles", "pathettic", "disgustingg", "imbecille"]
    rows = [(i, f"you are such a {w} today") for i, w in enumerate(bad)] + [(100, clean), (101, "she met him at the whore house museum, he said"), (102, "his son lost the short race")]
    got = {r.doc_id: r.predicted for r in toxicity.scores(table(spark, rows), model).collect()}
    assert all(got[i] for i in range(len(bad))) and not got[100] and not got[102]


def test_toxicity_of_held_out_labels(spark):
    folder = FOLDER.replace("0.001", "0.01")
    got = QUERIES["op8_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.95
    assert sum(r.predicted and not r.toxic for r in got) <= 1
    model = toxicity.learn_without_held_out(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    docs = table(spark, odd_rows() + [(77, "you are a worthless idiot"), (78, None)])
    rows = toxicity.scores(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.accepted(docs, model).columns == docs.columns
    assert {r.doc_id for r in rows if r.predicted} == {77}


# 10 ---------------------------------------------------------------------------------------------
def test_fingerprints(spark):
    for docs, rows in both(spark):
        got = sketches.fingerprints(docs).collect()
        assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
        ids = Counter(d for d, _ in rows)
        order = sorted((r for r in rows if r[0] is not None and ids[r[0]] == 1), key=lambda r: -r[0])
        by = {r.doc_id: r for r in got}
        for (d, t), (e, following) in zip(order, order[1:]):
            if any(e < x < d for x in ids if x is not None):
                continue
            t, following = t or "", following or ""
            k = len(t) // 3
            edited = t[: len(t) - k] + following[:k]
            assert by[d].n_chars == len(t) and by[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for r in got:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    whole = sketches.fingerprints(documents(spark))
    assert whole.where("n_chars > 3000 AND near_edited < 0.35").count() == 0
    assert "Python" not in whole._jdf.queryExecution().executedPlan().toString()


def test_next_of_the_last_is_the_first(spark):
    for rows in ([(5, "only one text here")], [(1, "a b c d e f"), (2, "g h i j k l"), (None, "m n o p q r")], [(None, "a b c"), (None, "d e f")]):
        got = {(r.doc_id, r.n_chars): r.edited_sha256 for r in sketches.fingerprints(table(spark, rows)).collect()}
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
        if all(d is not None for d, _ in rows[:1]):
            for (d, t), (_, f) in zip(order, order[1:] + order[:1]):
                k = len(t) // 3
                assert got[(d, len(t))] == hashlib.sha256((t[: len(t) - k] + f[:k]).encode()).hexdigest()
        assert len(got) <= len(rows)


def by_hash(spark, rows):
    """The rows with the row that follows each, in descending order of doc_id and hash."""
    th = {r.text: r.th for r in sketches.keyed_texts(table(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, th[r[1]]), reverse=True)
    return list(zip(order, order[1:] + order[:1]))


def check_following(spark, rows):
    want = Counter()
    for (d, t), (_, f) in by_hash(spark, rows):
        k = len(t) // 3
        want[(d, len(t), hashlib.sha256((t[: len(t) - k] + f[:k]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in sketches.fingerprints(table(spark, rows)).collect()) == want


def short_texts(n, seed):
    rnd = random.Random(seed)
    return [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(8, 20))) for _ in range(n)]


def test_next_of_large_ids(spark):
    rnd = random.Random(3)
    check_following(spark, [((1 << 62) + rnd.randrange(1 << 60), t) for t in short_texts(600, 1)])


def test_rows_that_share_an_id_are_split(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(short_texts(900, 2))]
    check_following(spark, rows)
    sizes = sketches._in_ranges(table(spark, rows)).groupBy("range").count().collect()
    assert max(r["count"] for r in sizes) <= 90


def shingles_of(text, widths=(2, 5)):
    w = text.split()
    return {tuple(w[i : i + n]) for n in widths for i in range(len(w) - n + 1)} | ({tuple(w)} if w and len(w) < max(widths) else set())


def likeness_of(a, b):
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    return len(a & b) / len(a) if a else float(not b)


@pytest.mark.parametrize("one_in", [1, 2])
def test_near_edited_against_exact_containment(spark, one_in):
    rows = list(enumerate(short_texts(300, 4)))
    got = {r.doc_id: r.near_edited for r in sketches.fingerprints(table(spark, rows), one_in=one_in).collect()}
    off = []
    for (d, t), (_, f) in by_hash(spark, rows):
        k = len(t) // 3
        off.append(abs(got[d] - likeness_of(shingles_of(t), shingles_of(t[: len(t) - k] + f[:k]))))
    assert max(off) < 1e-9 if one_in == 1 else sum(off) / len(off) < 0.15 and sum(x > 0.4 for x in off) < 0.05 * len(off)


def test_near_next_is_the_likeness_of_sketches(spark):
    for docs in (table(spark, odd_rows()), documents(spark)):
        rows = sorted(sketches.fingerprints(docs).join(sketches.keyed_texts(docs).groupBy("doc_id").agg(F.max("th").alias("th"), F.count("*").alias("n")), "doc_id").where("n = 1").collect(), key=lambda r: -r.doc_id)
        ids = sorted({r.doc_id for r in docs.select("doc_id").collect() if r.doc_id is not None}, reverse=True)
        following = dict(zip(ids, ids[1:]))
        by = {r.doc_id: r for r in rows}
        pairs = [(r, by[following[r.doc_id]]) for r in rows if following.get(r.doc_id) in by]
        assert pairs
        for a, b in pairs:
            x, y = set(a.sketch), set(b.sketch)
            assert a.near_next in {likeness_of(x, y), likeness_of(y, x)} and a.fingerprint == ",".join(f"{h & (2**64 - 1):016x}" for h in a.sketch)
        assert all(h < 0 or h == r.sketch[0] for r in rows for h in r.sketch)


def test_ranges_are_found_in_two_steps(spark):
    edges = sorted({random.Random(i).randrange(10**6) for i in range(170)})
    df = spark.range(0, 10**6, 997).withColumn("n", sketches._count_below([edges, [0] * len(edges)], lambda e: (e["c0"] < F.col("id")) | ((e["c0"] == F.col("id")) & (e["c1"] <= 0))))
    assert all(r.n == sum(e <= r.id for e in edges) for r in df.collect())
    assert spark.range(3).select(sketches._count_below([[]], lambda e: e["c0"] <= F.col("id")).alias("n")).distinct().collect()[0].n == 0


def test_sketches_merge(spark):
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words[:250]), " ".join(words[246:])
    df = sketches.with_sketch(sketches.with_sketch(sketches.with_sketch(spark.createDataFrame([(a, b, " ".join(words))], "a string, b string, c string"), "a", "sa"), "b", "sb"), "c", "sc")
    r = df.select(sketches.merged(F.col("sa"), F.col("sb")).alias("m"), "sc", sketches.containment(F.col("sa"), F.col("sc")).alias("inside")).first()
    assert r.m == r.sc and r.inside >= 0.9


# 11 ---------------------------------------------------------------------------------------------
def check_divergence(spark, rows, least, top):
    full = [(i, *r, "x", 1.5) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, lang string, source string, text string, term string, n double").repartition(3)
    got = [tuple(r) for r in divergence.audit(docs, least, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.divergence(rows, least, top)


def test_divergence(spark):
    rows = [(r.lang, r.source, r.text) for r in documents(spark).collect()]
    check_divergence(spark, rows, 30, 50)
    rnd = random.Random(8)
    odd = [(None, None, "Ab aB ÉÉ é x1y ß日本"), (None, "s", None), ("en", "a", ""), ("en", "b", "!!"), ("xx", "only", "word word"), ("", "", "ab")]
    words = ["Ab", "ab", "cd", "e", "É", "日本", "f-g", "h_i", "\U0001f600"]
    odd += [(rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None, ""]), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for _ in range(150)]
    for least, top in ((1, 50), (4, 2), (1000, 50)):
        check_divergence(spark, odd, least, top)


def test_counts_of_terms_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    rnd = random.Random(9)
    check_divergence(spark, [("en", f"s{i % 7}", " ".join(f"t{chr(97 + rnd.randrange(26))}" for _ in range(20))) for i in range(200)], 2, 5)


def test_tree_corrects_each_node_with_its_ancestors():
    tree = divergence.PathTree()
    rows = [([("a", 5, 1), ("b", 7, 2)], 3), ([("a", 5, 1), ("b", 7, 2), ("c", 4, 4)], 2), ([("a", 6, 1)], 1), ([("b", 7, 2), ("c", 9, 4)], 1)]
    for path, times in rows:
        tree.add(path, times)
    tree.close(0)
    want = Counter()
    for path, times in rows:
        for j, (b, q, zb) in enumerate(path):
            for a, p, za in path[:j]:
                want[a, b] += times * (abs(p - q) - abs(p - zb) - abs(za - q) + abs(za - zb))
    assert {k: v for k, v in tree.sums.items() if v} == {k: v for k, v in want.items() if v}


# 12 ---------------------------------------------------------------------------------------------
def test_lyndon_arrays():
    rnd = random.Random(12)
    for _ in range(300):
        w = [rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randint(1, 24))]
        ranks = np.unique(w, return_inverse=True)[1]
        assert periodic.lyndon_lengths(ranks).tolist() == brute.lyndon(w)


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_are_complete(least):
    rnd = random.Random(least)
    for _ in range(400):
        docs = []
        for _ in range(rnd.randint(1, 4)):
            letters = [b"a", b"b", b"c", b"d", b"e"][: rnd.choice([1, 2, 3, 5])]
            docs.append([w for _ in range(rnd.randint(0, 4)) for w in [rnd.choice(letters) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 6)])
        assert periodic.runs_of_documents(docs, least) == [brute.runs(d, least) for d in docs]


def test_runs_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(periodic, "stretch_hash", lambda prefix, a, b, which: (b - a).astype(np.uint64) % np.uint64(3))
    w = [0, 1, 2, 3] * 6 + [9, 8, 7] + [4, 5] * 8
    assert periodic.find_runs(np.unique(w, return_inverse=True)[1]) == brute.runs(w, 12)


def test_periodic_runs(spark):
    def expected(d, t):
        words = (t or "").encode().split()
        n, h = len(words), zlib.crc32(str(d).encode())
        if d is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = periodic.runs_of_documents([words])[0] if n > 3000 else brute.runs(words, 12)
        gone = {i for s, size, p in found for i in range(s + p, s + size)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{size},{p}\n" for s, size, p in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        return (d, len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    rows = odd_rows() + [(20, "a b " * 6), (21, "a b " * 5 + "a"), (22, "A a " * 9), (23, "x y z " * 4 + "q r " * 7)]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for docs, plain_rows in ((table(spark, rows), rows), (documents(spark), plain(spark))):
        got = periodic_columns(docs).select(*columns).collect()
        assert Counter(tuple(r) for r in got) == Counter(expected(d, t) for d, t in plain_rows)


# 13 ---------------------------------------------------------------------------------------------
def near_rows():
    """Copies with a few, with some and with many changed words, chains of changes, a large group, many nearly similar texts and odd rows."""
    rnd, rows = random.Random(11), []
    for g in range(25):
        words = [f"g{g}w{i}" for i in range(rnd.choice([30, 80, 200]))]
        for c in range(8):
            some = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                some[rnd.randrange(len(some))] = f"x{rnd.random()}"
            rows.append((len(rows) + 20, " ".join(some)))
            words = some if c % 3 == 2 else words
    base = [f"b{i}" for i in range(100)]
    rows += [(1000 + i, " ".join(base[: i % 97] + [f"y{i}"] + base[i % 97 + 1 :])) for i in range(150)]
    for i in range(120):
        some = list(base)
        for j in rnd.sample(range(100), 8):
            some[j] = f"z{i}.{j}"
        rows.append((2000 + i, " ".join(some)))
    return rows + odd_rows() + [(30, "One"), (31, "ONE"), (32, "One two three"), (33, "two one"), (None, "lone text"), (None, " ")]


def test_near_copies_are_those_of_similar_sets(spark):
    for docs, rows in [(table(spark, near_rows()), near_rows()), (documents(spark), plain(spark))]:
        sets = brute.shingle_sets([t for _, t in rows], 2)
        want = Counter()
        for (d, _), s, g in zip(rows, sets, brute.near_groups(sets, 80)):
            low = min((rows[i][0] for i in g if rows[i][0] is not None), default=None)
            want[d, len(s), low, d == low] += 1
        got = minhash.near_groups(docs).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def test_unlike_texts_with_a_common_part_are_not_all_compared(spark, monkeypatch):
    rnd, rows = random.Random(5), []
    base = [f"b{i}" for i in range(120)]
    for i in range(400):  # near the base or too far from all others, with words of their own
        some = list(base)
        for k, j in enumerate(rnd.sample(range(120), rnd.choice([2, 4, 12, 14, 16]))):
            some[j] = f"z{i}.{k}"
        rows.append((i, " ".join(some[: 120 - i % 4])))
    compared, linked = [], minhash._linked
    monkeypatch.setattr(minhash, "_linked", lambda pairs, *rest: compared.append(pairs.count()) or linked(pairs, *rest))
    got = {r.doc_id: r.component_id for r in minhash.near_groups(table(spark, rows)).collect()}
    assert got == {i: min(g) for i, g in zip(range(400), brute.near_groups(brute.shingle_sets([t for _, t in rows], 2), 80))}
    assert 150 < len(set(got.values())) and sum(compared) < 40 * len(rows)


@pytest.mark.parametrize("least", [50, 80, 95])
def test_similar_sets_share_a_prefix_value(least):
    rnd = random.Random(least)
    for most in (12, 60, 700):
        sets = []
        for _ in range(20):
            whole = rnd.sample(range(most * 3), most)
            sets += [set(whole[: rnd.randint(most // 2, most)]) | set(rnd.sample(range(most * 3), rnd.randint(0, most // 8))) for _ in range(5)]
        holders = defaultdict(list)
        for s in sets:
            for x in s:
                holders[x].append(len(s))
        values = []
        for s in sets:
            shared = sorted((x for x in s if len(holders[x]) > 1), key=lambda x: (len(holders[x]), x))
            low, high = (np.array([f(holders[x]) for x in shared], np.int64) for f in (min, max))
            values.append(set(zip(*(a.tolist() for a in minhash.prefix_values(len(s), len(s) - len(shared), np.array(shared, np.int64), low, high, least)))))
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                    assert any((v, -1 if side < 0 else 1 - side) in values[j] for v, side in values[i])


def test_coordinates_are_shifted_permutations():
    sets = list(minhash.shingle_sets(np.frombuffer(b"a b c d ea b c d eA b", np.uint8), np.array([0, 9, 18, 21]), 2))
    assert [len(s) for s in sets] == [4, 4, 1] and (sets[0] == sets[1]).all() and sets[2][0] in sets[0]
    got = minhash.signatures(sets)
    assert got.shape == (3, minhash.BANDS * minhash.DEEP) and (got[0] == got[1]).all()
    wide = [np.sort(np.random.default_rng(i).integers(0, 1 << 63, 40_000, dtype=np.uint64)) for i in range(2)]
    wide.append(np.unique(np.concatenate((wide[0][:36_000], wide[1][:4_000]))))
    same = (minhash.signatures(wide)[0] == minhash.signatures(wide)[2]).mean()
    assert 0.65 < same < 0.97  # 36,000 of 44,000


# pipeline ----------------------------------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    docs = rows = documents(spark)
    kept = {}
    for name, stage in P.STAGES:
        rows = stage(spark, rows, FOLDER)
        if name != "packing":
            assert rows.columns == docs.columns
            rows = kept[name] = spark.createDataFrame(rows.collect(), docs.schema)
    model = toxicity.learn_without_held_out(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.scores(docs, model).where("predicted = 0").collect()}
    assert {r.doc_id for r in kept["toxicity"].collect()} == clean
    texts = {r.doc_id: r.text for r in kept["toxicity"].collect()}
    largest = {brute.low(t): d for d, t in sorted(texts.items())}
    assert {r.doc_id for r in kept["exact_dedup"].collect()} == set(largest.values())
    prints = [(d, brute.simhash(texts[d], 3)) for d in largest.values()]
    assert {r.doc_id for r in kept["near_dedup"].collect()} == set(brute.groups_of(prints, 2)[0])
    left = [(r.doc_id, r.text) for r in kept["near_dedup"].collect()]
    gone = dict(zip([d for d, _ in left], brute.repeated_words([t for _, t in left], 50)))
    for r in kept["suffix_dedup"].collect():
        words, flags = gone[r.doc_id]
        assert r.text.encode().split() == [w for w, g in zip(words, flags) if not g]
        assert r.n_chars == len(r.text) and (any(flags) or r.text == texts[r.doc_id])
    tok = bpe.load(vocabulary("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: r.start):
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert ids == {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [0] for r in kept["suffix_dedup"].collect()}
