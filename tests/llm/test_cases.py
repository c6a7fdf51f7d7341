"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and the paths for very large groups."""

import heapq
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.llm import anchors, binary, counts, graph, packing, pieces, quality, rules, simhash, suffixes, toxicity, vectors
from tidewright.llm.common import vocabulary

SCHEMA = "doc_id long, text string, ids string, h long, score string, start long"  # the last four clash with the operators' own
LONG = " ".join(f"w{i % 977} x" for i in range(40_000))
ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "plain words here"), (4, "plain words here"), (None, "no id at all"), (6, LONG), (7, "ünï çødé 中文 😀 ▁ <|endoftext|>"), (8, "a\x00b ퟿")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")


def all_operators(docs, labels, path):
    yield pieces.decode(pieces.encode(docs))
    yield quality.score(docs, quality.fit(docs, labels))
    yield packing.pack(docs)
    yield simhash.near_duplicates(docs)
    yield toxicity.score(docs, toxicity.fit(docs, labels))
    yield suffixes.with_spans(docs)
    binary.write_ids(docs, f"{path}/ids")
    yield binary.read_ids(docs.sparkSession, f"{path}/ids")
    yield counts.token_counts(docs)
    yield rules.judge(rules.rule_counts(docs))


def test_odd_rows(odd, labels, tmp_path):
    for frame in all_operators(odd, labels, tmp_path):
        found = frame.collect()
        if "length" not in frame.columns:
            assert len(found) == len(ROWS)
            assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in ROWS)


def test_empty_tables(spark, odd, labels, tmp_path):
    for frame in all_operators(odd.limit(0), labels.limit(0), tmp_path):
        assert frame.count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_filters_keep_columns(odd, labels):
    model = quality.fit(odd, labels)
    for frame in (quality.keep_good(odd, model, 0.0), rules.keep_good(odd), simhash.keep_first(odd), suffixes.keep_unique(odd)):
        assert frame.columns == odd.columns
        assert frame.count() <= len(ROWS)


def heap_agenda(encoder, chunk, variant):
    """The agenda with a heap, one chunk: best score first, leftmost of equals; a dropped candidate is not asked again."""
    t = encoder.table
    key = np.array([pieces.chunk_key(encoder.seed, variant, chunk)], "u8")
    symbols = [[i, 1, t.ids.get(c)] for i, c in enumerate(chunk)]  # offset, length, id
    alive = {s[0]: s for s in symbols}

    def push(heap, a, b):
        piece = chunk[a[0] : b[0] + b[1]]
        if a[2] is not None and b[2] is not None and piece in t.ids:
            heapq.heappush(heap, (-float(t.scores[t.ids[piece]]), a[0], len(piece), b[0]))

    heap = []
    for a, b in zip(symbols, symbols[1:]):
        push(heap, a, b)
    while heap:
        _, start, size, right = heapq.heappop(heap)
        a, b = alive.get(start), alive.get(right)
        if not a or not b or a[0] + a[1] != b[0] or a[1] + b[1] != size:
            continue
        piece = t.ids[chunk[start : start + size]]
        if pieces.skips(key, np.array([start]), np.array([piece]), encoder.rate)[0]:
            continue
        alive[start] = [start, size, piece]
        del alive[right]
        order = sorted(alive)
        at = order.index(start)
        if at:
            push(heap, alive[order[at - 1]], alive[start])
        if at + 1 < len(order):
            push(heap, alive[start], alive[order[at + 1]])
    return [alive[k][2] for k in sorted(alive)]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_agenda_equals_heap(rate):
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), rate)
    rng = random.Random(3)
    chunks = ["▁internationalization", "▁▁▁▁the", "▁a", *("▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 14))) for _ in range(60))]
    for variant in range(encoder.variants):
        got = encoder.agenda(chunks, [pieces.chunk_key(encoder.seed, variant, c) for c in chunks])
        for chunk, ids in zip(chunks, got):
            assert np.frombuffer(ids, "<u4").tolist() == heap_agenda(encoder, chunk, variant)


def test_pieces_equal_the_library_without_dropout_and_vary_with_it():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    plain = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), 0.0)
    text = "  Some thing,   re-tokenized\n\n twice — naïvely 中 😀 "
    assert np.frombuffer(plain.encode([1], [text])[0], "<u4").tolist() == library.encode(text)
    dropped = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), 0.3)
    several = dropped.encode(list(range(40)), [text] * 40)
    assert len(set(several)) > 1 and several == dropped.encode(list(range(40)), [text] * 40)
    for ids in several:
        assert dropped.decode(np.frombuffer(ids, "<u4")) == text
    with pytest.raises(ValueError):
        pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), 1.5)


def test_longest_match_automaton():
    rng = random.Random(5)
    for _ in range(60):
        known = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        match = counts.LongestMatch(known)
        for _ in range(40):
            word = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 12)))
            n = i = 0
            while i < len(word):
                size = next((k for k in range(5, 0, -1) if word[i : i + k] in known and i + k <= len(word)), 0)
                n += 1 if size else len(word[i].encode())
                i += size or 1
            assert match.length(word) == n, (known, word)


def test_suffix_array_and_small_groups(spark):
    rng = random.Random(2)
    for n in (1, 2, 50, 400):
        body = bytes(rng.choice(b"ab") for _ in range(n)) + b"\xff"
        order = suffixes.suffix_array(np.frombuffer(body + b"\xff" * (n + 8), "u1"), n)
        assert sorted(order.tolist()) == list(range(len(body)))
        keys = [body[i : i + n] for i in order]
        assert keys == sorted(keys)


def test_contents_with_company_are_told_across_batches():
    """Of each k-gram hash the first two contents of a partition are left to be counted (kind 0), further ones are not (kind 2)."""
    rng = random.Random(4)
    rows = sorted((0, h, w, w, rng.randint(0, 3), 0, rng.randint(0, 9), 100) for h in range(40) for w in range(rng.choice([1, 2, 3, 30])) for _ in range(rng.choice([1, 1, 2])))
    rows.sort(key=lambda r: (r[1:4], r[4:]))
    names, types = "kind h w1 w2 doc th start size".split(), [pa.int8(), *[pa.int64()] * 7]
    contents = {}
    for r in rows:
        contents.setdefault(r[1], {}).setdefault(r[2], r)
    expected = sorted((0 if rank < 2 else 2, h, r[4], r[6]) for h, own in contents.items() for rank, r in enumerate(own.values()))
    for size in (1, 2, 3, 7, len(rows)):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + size]), types)], names=names) for k in range(0, len(rows), size)]
        out = [r for b in suffixes._meet(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["kind"], r["h"], r["doc"], r["start"]) for r in out if r["kind"] != 1) == expected
    own = sorted(rng.choice([k, 2 * k]) for k in range(60))
    for size in (1, 2, 3, 7, 60):
        batches = [pa.RecordBatch.from_pydict({"h": own[k : k + size], "at": list(range(k, min(k + size, 60)))}) for k in range(0, 60, size)]
        assert [r["at"] for b in suffixes._with_company(iter(batches)) for r in b.to_pylist()] == [i for i, h in enumerate(own) if own.count(h) > 1]


def by_key(docs, **settings):
    """What is left of each row: (doc_id, text) to (kept bytes, runs)."""
    return {(r["doc_id"], r["text"]): suffixes.cut(r["text"].encode(), r["_spans"]) for r in suffixes.with_spans(docs, **settings).where("text is not null").collect()}


def brute_rows(spark, rows, length=100):
    """Distinct (doc_id, text) in order of id (null first) and text hash; each window that came before goes."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").where("text is not null").distinct().withColumn("th", F.xxhash64("text", F.col("doc_id").isNull()))
    seen, out = set(), {}
    for r in sorted(frame.collect(), key=lambda r: (-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["th"])):
        data = r["text"].encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        out[r["doc_id"], r["text"]] = np.frombuffer(data, "u1")[~gone].tobytes()
    return out


def test_large_groups_and_odd_ids_equal_brute_force(spark):
    """A hot passage of many distinct contents, split at several limits; repeated, negative and null ids with different texts; bytes above 127."""
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh éß") for _ in range(260))
    rows = [(k - 20, "".join(rng.choice("ijklmnop ") for _ in range(rng.randint(0, 90))) + passage[rng.randint(0, 20) :] + str(k) * 40) for k in range(60)]
    alone = "".join(rng.choice("qrstuvw ") for _ in range(600))
    rows += [(1, passage), (5, "x" + passage + "y"), (5, alone), (5, alone), (None, passage + alone[:50]), (None, "other " + passage), (None, alone), (-(1 << 63), passage), (70, None), (71, ""), (72, alone + alone)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute_rows(spark, rows)
    for limit in (1, 3, 10_000):
        got = by_key(docs, group=limit)
        assert {k: v[0] for k, v in got.items()} == expected
    assert expected[5, "x" + passage + "y"] != b"" and sum(map(len, expected.values())) < sum(len(t or "") for _, t in rows)
    short = spark.createDataFrame([(1, "abcdefghij" * 3), (2, "xabcdefghijabc")], "doc_id long, text string")
    assert {k: v[0] for k, v in by_key(short, length=12).items()} == brute_rows(spark, [tuple(r) for r in short.collect()], 12)


def test_unrelated_texts_of_one_id_stay(spark):
    p, n = (" ".join(str(k * f) for k in range(100, 220)) for f in (7919, 104_729))
    for d in (5, None):
        docs = spark.createDataFrame([(-3, p), (d, "a " + p), (d, n)], "doc_id long, text string")
        got = by_key(docs)
        assert got[d, n] == (n.encode(), [])


def test_segments_of_long_texts(spark):
    assert len(" ".join(str(i * 7919) for i in range(180_000))) > anchors.SEGMENT
    body = "".join(chr(97 + (i * i) % 23) for i in range(3000))
    unique = " ".join(str(i * 7919) for i in range(180_000))  # beyond one segment
    docs = spark.createDataFrame([(1, unique), (2, body + unique[1_000_000:1_100_000] + body)], "doc_id long, text string")
    found = {r["doc_id"]: suffixes.cut(r["text"].encode(), r["_spans"])[1] for r in suffixes.with_spans(docs).collect()}
    assert not found[1]
    assert any(a <= 3000 and b >= 103_000 for a, b in found[2])


def test_simhash_long_lists(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(25)})
    nodes = spark.createDataFrame([(k, fp - (1 << 64) if fp >> 63 else fp) for k, fp in enumerate(prints)], "node long, fp long")
    expected = {k: k for k in range(len(prints))}
    for a in range(len(prints)):
        for b in range(a + 1, len(prints)):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((expected[a], expected[b]))
                expected = {k: x if v == y else v for k, v in expected.items()}
    for longest in (2, 8, 4096):
        got = {r["node"]: r["component"] for r in graph.components(simhash.links(nodes, longest)).collect()}
        assert {k: got.get(k, k) for k in expected} == expected


def test_simhash_negative_null_and_repeated_ids(spark):
    """Nodes k and -k at distance 3 in blocks of one list; documents joined only through one without an id; what keep_first leaves."""
    rng = random.Random(12)
    base = rng.getrandbits(64)
    prints = {}
    for k in range(1, 61):
        a = base ^ (rng.getrandbits(20) << 12)
        prints[k], prints[-k] = a, a ^ 0b111
    nodes = spark.createDataFrame([(k, fp - (1 << 64) if fp >> 63 else fp) for k, fp in prints.items()], "node long, fp long")
    got = {r["node"]: r["component"] for r in graph.components(simhash.links(nodes, 4)).collect()}
    assert all(got[k] == got[-k] for k in range(1, 61))
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(7, text, 1), (7, text, 1), (None, text, 2), (9, text, 3), (None, "", 4), (None, None, 5), (12, "other words that are far away", 6), (-4, "one two three four five", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `group` int").withColumn("row", F.lit(1)).withColumn("th", F.lit(2))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows) and all(r["component_id"] == 7 for r in found if r["fp"] == next(x["fp"] for x in found if x["doc_id"] == 7))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    left = sorted((str(r["doc_id"]), r["group"]) for r in kept.collect())
    assert left[:3] == [("-4", 7), ("12", 6), ("7", 1)] and len(left) == 4 and left[3][0] == "None"


def test_tally_prunes_before_verification():
    """Lists share three bytes; the tally of five drops most of their pairs, and no pair within the distance."""
    rng = np.random.default_rng(3)
    fp = (rng.integers(0, 1 << 40, 3000, dtype="u8") << np.uint64(24)) | np.uint64(0xABCDEF)
    near = fp[:200] ^ (np.uint64(1) << rng.integers(24, 64, 200).astype("u8"))
    fp = np.unique(np.concatenate([fp, near]))
    seen = simhash.Counter()
    found = simhash.forest(fp, np.zeros(len(fp), "i8"), seen=seen)
    i, j = np.triu_indices(len(fp), 1)
    assert seen["linked"] == int(simhash.verified(fp, i, j).sum()) >= len(found) >= 200
    assert seen["met"] == len(i) and seen["linked"] <= seen["retained"] < seen["met"] / 100


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(1000, 1060)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 5 for k in [5, *range(1000, 1060)]) and 7 not in got


def test_vectors_odd_and_blocked(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((8, 16))
    rows = [(k, (centre[k % 8] + 0.05 * rng.standard_normal(16)).tolist(), int(k % 2)) for k in range(300)]
    rows += [(300 + k, rows[3][1], 1) for k in range(5)]
    odd = [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, rows[0][1], None), (404, [None] * 16, 1), (405, [], 1), (406, [float("inf")] + [1.0] * 15, 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    from .test_contracts import assert_links

    for slab in (16, 1024):
        found = vectors.near_duplicates(frame, slab=slab).toPandas().set_index("vec_id")
        assert len(found) == len(rows) + len(odd)
        for v, *_ in odd:
            assert tuple(found.loc[v]) == (0, v, True)
        assert_links(found, frame.limit(len(rows)).toPandas())
    assert vectors.needed_collisions(24, 1.5, 0.99999) < 24 * 0.87


def test_deobfuscation():
    model = toxicity.smooth(toxicity.sequences(["what an idiot and a moron, stupid people, pathetic"] * 50).astype("f8"))
    channel = toxicity.Channel(model)
    for written, word in (("1d10t", "idiot"), ("m0r0n!", "moron"), ("stuuuupid", "stupid"), ("p.a.t.h.e.t.i.c", "pathetic"), ("$tupid", "stupid")):
        assert word in channel.token(written), written
    assert "stupid" in channel.words("so s t u p i d here")
    assert channel.token("plain") == ("plain",) and channel.token("2024") == ()


def test_estimation_and_packing_rules():
    share, good, bad = rules.estimate([((1,) * 6, 900), ((1, 1, -1, 1, 1, -1), 60), ((-1, -1, 1, 1, 0, 1), 40)], 6)
    assert rules.posterior((1,) * 6, share, good, bad) > 0.9 > 0.5 > rules.posterior((1, 1, -1, 1, 1, -1), share, good, bad)
    assert rules.estimate([], 6)[0] == rules.PRIOR
    with pytest.raises(ValueError):
        packing.TierPacker((1024, 500))
    packer, found = packing.TierPacker(), []
    sizes = [random.Random(1).randint(1, 3000) for _ in range(200)]
    for k, n in enumerate(sizes):
        found += packer.add(k, n)
    found += [*packer.flush(False), *packer.flush(True)]
    assert sum(p[2] for _, ps in found for p in ps) == sum(sizes)
    assert all(sum(p[2] for p in ps) == w or ps is found[-1][1] for w, ps in found)
    groups = packing.step_groups(found, 16_384)
    assert len(groups) == len(found)


def test_dictionary_and_blocks():
    import zstandard

    data = binary.train_dictionary([b"abc" * 50] * 3)
    docs = [(None, np.arange(5, dtype="<u4").tobytes()), (3, b""), (9, np.array([65_535], "<u4").tobytes())]
    payload = binary.pack_block(docs, 2, 11, data, zstandard.ZstdCompressor(dict_data=binary.dictionary_of(data)))
    block = binary.Block(payload, data)
    assert block.start == 11 and [block.document(i).tolist() for i in range(3)] == [[0, 1, 2, 3, 4], [], [65_535]]
    with pytest.raises(ValueError):
        binary.Block(payload, data + b"x")
