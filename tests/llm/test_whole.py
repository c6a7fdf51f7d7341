"""Cases of the review: what an operator must do on every row, occurrence or repeated row."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import binary, pieces, quality, rules, simhash, suffixes, toxicity, vectors
from tidewright.llm.common import vocabulary


def test_every_occurrence_is_cut_anew():
    path = vocabulary("piece_bpe_32k.model")
    encoder = pieces.PieceEncoder(path)
    text = " ".join(["internationalization"] * 400)
    ids = encoder.encode([1, 2], [text, text])
    assert ids == encoder.encode([1, 2], [text, text]) == [pieces.PieceEncoder(path, memo=0).encode([d], [text])[0] for d in (1, 2)]
    assert ids[0] != ids[1]
    words = [w for x in ids for w in " ".join(encoder.table.pieces[i] for i in np.frombuffer(x, "<u4")).replace(" ▁", "\n▁").split("\n")]
    assert len(words) == 800 and len(set(words)) > 8  # of four tables, and one table in a document, no more than four
    assert len(set(words[:100])) > 4
    # each merge is dropped at the rate: a chunk of two characters is one merge
    plain = pieces.PieceEncoder(path, 0.0)
    assert len(plain.encode([0], ["a"])[0]) == 4
    pairs = len(encoder.encode([3], [" ".join(["a"] * 20_000)])[0]) // 4 - 20_000
    assert abs(pairs / 20_000 - encoder.rate) < 0.01


def test_repeated_row_of_one_block_keeps_its_text(spark):
    text = " ".join(str(k * 7919) for k in range(60))
    rows = [(5, text), (5, text), (7, text + " and " + text)]
    for parts in (1, 3):  # in one block and in several: the same
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = [(r["doc_id"], suffixes.cut(r["text"].encode(), r["_spans"])) for r in suffixes.with_spans(docs).collect()]
        for doc_id, (kept, runs) in found:
            if doc_id == 5:
                assert kept.decode() == text and not runs
            else:
                assert runs and len(kept) < len(text)


def test_obfuscations_meet_the_decoder():
    model = toxicity.smooth(toxicity.sequences(["what an idiot and a moron, stupid people, such shit, it is in the book of a good man"] * 50).astype("f8"))
    channel = toxicity.Channel(model)
    for written, word in (("5h17", "shit"), ("1d107", "idiot"), ("stuupid", "stupid"), ("1d10t", "idiot")):
        assert word in channel.token(written), written
    for text in ("so s  t  u  p  i  d here", "s\tt\tu\tp\ti\td", "you\ns\nt\nu\np\ni\nd\nyou", "that stu pid people", "such s h i t here"):
        assert {"stupid", "shit"} & channel.words(text), text
    assert {"book", "good", "man"} <= channel.words("it is in the book of a good man")
    assert channel.token("...") == ()
    obscene = toxicity.Channel(toxicity.smooth(toxicity.sequences(["an ass, asses, the ass and such shit, shit of an ass"] * 50).astype("f8")))
    for text, word in (("a s s", "ass"), ("s  h  i  t", "shit"), ("s\nh\ni\nt", "shit"), ("sh it", "shit"), ("4$$", "ass"), ("@$$", "ass")):
        assert word in obscene.words(text), text
    # only what was restored is scored: no fragment of the token as written
    assert channel.words("1d10t") == {"idiot"} and channel.words("stu.pid") == {"stupid"}


def test_encoder_equals_brute_force_on_documents():
    """encode against an agenda by rescanning: every occurrence with the key of its place, memo or not, long chunks too."""
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), 0.2)
    t = encoder.table

    def rescan(chunk, key):
        symbols = [(i, c) for i, c in enumerate(chunk)]
        key = np.array([key], "u8")
        while True:
            best = None
            for (i, a), (_, b) in zip(symbols, symbols[1:]):
                piece = t.ids.get(a + b)
                if piece is None or a not in t.ids or b not in t.ids or pieces.skips(key, np.array([i]), np.array([piece]), encoder.rate)[0]:
                    continue
                if best is None or t.scores[piece] > best[0]:
                    best = t.scores[piece], i
            if best is None:
                return [t.ids[s] if s in t.ids else None for _, s in symbols]
            at = next(k for k, (i, _) in enumerate(symbols) if i == best[1])
            symbols[at : at + 2] = [(best[1], symbols[at][1] + symbols[at + 1][1])]

    rng = random.Random(8)
    words = ["the", "ofthe", "internation", "a", "stone"] + ["".join(rng.choice("etaoinshr") for _ in range(rng.choice((5, 9, 300)))) for _ in range(6)]
    texts = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(4)]
    for round_ in range(2):  # the second time from the memo
        for d, (text, ids) in enumerate(zip(texts, encoder.encode(list(range(4)), texts))):
            chunks = encoder.escape(text)
            keys = encoder.keys(d, len(chunks)).tolist()
            assert np.frombuffer(ids, "<u4").tolist() == [x for c, k in zip(chunks, keys) for x in rescan(c, k)]


def test_a_long_unspaced_text_is_encoded_in_time():
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    rng = random.Random(1)
    text = "".join(rng.choice("etaoinshrdlu中文字") for _ in range(1_000_000))
    start = time.perf_counter()
    ids = encoder.encode([1], [text])[0]
    assert time.perf_counter() - start < 30
    assert encoder.decode(np.frombuffer(ids, "<u4")) == text


def test_estimation_recovers_planted_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(40_000) < 0.7
    on_good, on_bad, votes = [0.95, 0.9, 0.85, 0.8, 0.92, 0.75], [0.8, 0.6, 0.9, 0.7, 0.55, 0.65], [0.9, 0.7, 0.8, 0.5, 0.9, 0.6]
    columns = []
    for a, b, p in zip(on_good, on_bad, votes):
        right = rng.random(len(good)) < np.where(good, a, b)
        columns.append(np.where(rng.random(len(good)) < p, np.where(right == good, 1, -1), 0))
    patterns = Counter(map(tuple, np.stack(columns, 1).tolist()))
    share, found_good, found_bad = rules.estimate(list(patterns.items()), 6, 200)
    assert abs(share - 0.7) < 0.05
    assert np.abs(np.array(found_good) - on_good).max() < 0.05 and np.abs(np.array(found_bad) - on_bad).max() < 0.05


def test_one_bad_vote_can_be_outvoted(spark, sf):
    """The verdict is not that of the filter that every rule must pass, and no estimate but those without say is at its bound."""
    counts = rules.materialize(rules.rule_counts(spark.read.parquet(f"{sf}/documents.parquet")), "counts")
    plain = [rules.vote(g, b).alias(f"v{j}") for j, (_, g, b) in enumerate(rules.RULES)]
    patterns = [(tuple(r[:-1]), r[-1]) for r in counts.where(f"not ({rules.BASE_FAILED})").select(*plain).groupBy(*[f"v{j}" for j in range(len(plain))]).count().collect()]
    share, good, bad = rules.estimate(patterns, len(plain))
    assert 0.5 < share < 0.99 and all(0.5 < a < 1 for a in good) and all(b >= 1 - a for a, b in zip(good, bad))
    mixed = [(p, rules.posterior(p, share, good, bad)) for p, _ in patterns if -1 in p]
    assert any(q < 0.5 for _, q in mixed)
    lines = next(j for j, (name, *_) in enumerate(rules.RULES) if name == "lines")
    one = tuple(-1 if j == lines else 1 for j in range(len(plain)))
    assert rules.posterior(one, share, good, bad) > 0.5  # good documents repeat a line now and then


def test_clashing_names_are_kept(spark):
    rows = [(1, "plain words of a text that goes on and on with many more words in it so that rules have a say " * 2, 1), (2, "", 2), (None, None, 3)]
    names = ["_key", "_spans", "spans", "counts", "row", "kept", "th", "doc", "fp", "n_words", "size", "group"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for name in names:
        docs = docs.withColumn(name, F.lit("x"))
    model = quality.train([])
    for frame in (rules.keep_good(docs), suffixes.keep_unique(docs), simhash.keep_first(docs), quality.keep_good(docs, model, 0.0)):
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
        assert all(r["_key"] == r["group"] == "x" for r in frame.collect())


def test_ids_beyond_the_item_size_are_refused(spark, tmp_path):
    wide = np.array([70_000], "<u4").tobytes()
    with pytest.raises(ValueError):
        binary.serialize(wide, 2)
    assert binary.serialize(wide, 4) == wide
    with pytest.raises(ValueError):
        binary.serialize(np.array([65_536], "<u4").tobytes(), 2)


def test_the_word_of_stutter_is_no_word():
    text = "one \0again \0again two again"
    assert quality.tokens_of(text)[quality.AGAIN] == 1 and quality.tokens_of(text)["\0again"] == 2


def test_recall_of_tables_at_the_threshold():
    """Pairs at cosine 0.98 share a bucket and pass the count, for small and large labels."""
    rng = np.random.default_rng(2)
    x = vectors.unit(rng.standard_normal((20_000, 64)))
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    y = vectors.unit(0.98 * x + np.sqrt(1 - 0.98**2) * vectors.unit(side))
    for size in (100, 50_000, 10**8):
        m, tables = vectors.table_shape(size)
        met = (vectors.bucket_keys(x, m, tables) == vectors.bucket_keys(y, m, tables)).any(axis=1)
        assert met.mean() >= 0.9999
    shapes = [vectors.table_shape(10**k) for k in (3, 6, 9)]
    assert shapes[-1][1] < 12 * shapes[0][1]  # a million times the rows: few more tables
