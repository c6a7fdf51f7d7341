"""Work that moved off the driver or was made cheaper: same results by plainer ways."""

import os
import random
import tracemalloc

import numpy as np

from tidewright.llm import pieces, quality, toxicity
from tidewright.llm.common import vocabulary
from tidewright.llm.ids import IdEncoder

WORDS = ["a", "ab", "the", "été", "日本語", "\ud800x", quality.AGAIN, "x" * 5000, "ab"]


def test_features_of_many_words_are_those_of_each():
    ids, of = quality.features_of(WORDS)
    for k, word in enumerate(WORDS):
        alone, owner = quality.features_of([word])
        assert ids[of == k].tolist() == alone.tolist() and not owner.any()
        assert len(alone) == (1 if word == quality.AGAIN else quality.feature_number(len(word)))
    same = quality.features_of(["xabcx"])[0][1:].tolist()  # 3-grams: <xa xab abc bcx cx>
    assert same[2] == quality.features_of(["yabcz"])[0][1:].tolist()[2] and quality.features_of([])[0].size == 0


def test_scores_are_the_plain_sum_in_any_order_and_beyond_the_memo(monkeypatch):
    rng = np.random.default_rng(4)
    model = quality.Model(rng.normal(size=quality.BUCKETS), 0.2)
    texts = ["one two two three", "three two one two", "", " \t\n", "one two x x x", "été " * 50, "z" * 300 + " a"]
    for limit in (quality.MEMO, 3):
        monkeypatch.setattr(quality, "MEMO", limit)
        found = model.scores(texts)
        for text, score in zip(texts, found):
            tokens = quality.tokens_of(text)
            parts = {w: quality.features_of([w])[0] for w in tokens}
            total = sum(k * model.logits[parts[w]].sum() for w, k in tokens.items())
            n = sum(k * len(parts[w]) for w, k in tokens.items())
            assert abs(score - 1 / (1 + np.exp(-(total / max(n, 1) + 0.2)))) < 1e-12
        other = quality.Model(-model.logits, -0.2)  # another model in the same process has words of its own
        assert np.allclose(np.add(other.scores(texts), found), 1)
    assert model.scores(["b a c d"]) == model.scores(["d c a b"])


def test_a_task_trains_and_not_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(4, "some words"), (6, "other words")], "doc_id long, text string")
    labels = spark.createDataFrame([(4, 1), (6, 0)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "train", lambda rows, **settings: quality.Model(np.full(4, float(len(rows))), float(os.getpid())))
    model = quality.fit(docs, labels)
    assert model.bias != os.getpid() and model.logits.tolist() == [2.0] * 4


def test_agendas_look_at_new_neighbours_only():
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"))
    chunks = ["▁" + "international" * 3, "▁the", "▁unbelievable"]
    plain, looked, merge = encoder.agenda(chunks, [0, 0, 0], 0.0), [], encoder.table.merge
    encoder.table.merge = lambda left, right: looked.append(len(left)) or merge(left, right)
    taken = []
    assert encoder.agenda(chunks, [0, 0, 0], 0.0, taken) == plain
    merges = sum(len(rows) for rows, _ in taken)
    assert merges > 20 and sum(looked) <= sum(len(c) - 1 for c in chunks) + 2 * merges


def test_byte_pieces_decode_from_a_table():
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), 0.0)
    t, text = encoder.table, "a▁b \U0001f600\n\0 日本"
    ids = np.frombuffer(encoder.encode([1], [text])[0], "<u4")
    assert encoder.decode(ids) == text and b"".join(t.raw[ids]).decode() == " " + text
    odd = sorted(t.empty) + [t.byte[0xFF], t.byte[0x41]]  # control pieces give nothing, a stray byte a replacement character
    assert encoder.decode(np.array(odd)) == "\ufffdA"


def test_op1_runs_one_worker_a_task(spark, sf):
    plan = pieces.op1_query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    rows = [(1, "a▁b \U0001f600\n\0 日本"), (2, None), (3, ""), (None, " x  y "), (2, "same id, other text"), (-5, "word " * 3000), (7, "z" * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in pieces.round_trip(docs, rate=0.3, seed=11).collect()]
    assert found == [tuple(r) for r in pieces.decode(pieces.encode(docs, rate=0.3, seed=11)).collect()]
    assert [(r[0], r[3]) for r in found] == [(d, t or "") for d, t in rows]


def test_chunks_met_once_are_not_kept():
    texts = [" ".join(f"{k}x{i}" for i in range(4000)) for k in range(10)]
    encoder, other = (pieces.PieceEncoder(vocabulary("piece_bpe_32k.model")) for _ in range(2))
    encoder.encode([0], ["a"])
    tracemalloc.start()
    ids = [encoder.encode([k], [text])[0] for k, text in enumerate(texts)]
    kept = tracemalloc.get_traced_memory()[0] - sum(map(len, ids))
    tracemalloc.stop()
    assert kept < 1_000_000
    assert ids == other.encode(list(range(10)), texts)  # in one block
    other.once[:] = True  # every chunk is learned at once
    assert ids == other.encode(list(range(10)), texts) and encoder.encode(list(range(10)), texts) == ids


def whole_lattice(channel, token):
    """Viterbi from the first to the last character."""
    states = {0: (0.0, "")}
    for options in [*channel.readings(token), [(" ", 0.0)]]:
        after = {}
        for state, (score, text) in states.items():
            for c, cost in options:
                s = toxicity.symbol(c) if c else -1
                if s < 0 or (s == 0 and state % toxicity.SYMBOLS == 0):
                    to, new = state, (score + cost, text)
                else:
                    at = state * toxicity.SYMBOLS + s
                    to, new = at % toxicity.SYMBOLS**3, (score + cost + channel.flat[at], text + c)
                after[to] = max(after.get(to, new), new)
        states = after
    return max(states.values())[1].strip()


def test_only_the_unsure_part_of_a_token_is_decoded(monkeypatch):
    rng, texts = random.Random(5), ["the stupid idiot runs a committee of happy fools"] * 3
    channel = toxicity.Channel(toxicity.smooth(toxicity.sequences(texts).astype("f8")))
    tokens = ["committee", "happy", "st1d", "s t u p i d", "plain", "", "²²a", "_x_", "xx"]
    tokens += ["".join(rng.choices("abdeiloppst  15$@!.-é²µ日", k=rng.randint(1, 14))) for _ in range(2000)]
    found = [channel.decode(t) for t in tokens]
    assert found == [whole_lattice(channel, t) for t in tokens]
    seen, readings = [], channel.readings
    monkeypatch.setattr(channel, "readings", lambda token: seen.append(token) or readings(token))
    assert [channel.decode(t) for t in ("stupidd", "happily", "plain")] == [whole_lattice(toxicity.Channel(channel.model), t) for t in ("stupidd", "happily", "plain")]
    assert seen == ["dd", "ppily", ""]


def test_evidence_of_texts_beyond_the_memos(monkeypatch):
    channel = toxicity.Channel(toxicity.smooth(toxicity.sequences(["some words of a text"]).astype("f8")))
    scorer = toxicity.Scorer(channel, {"grim$": 2.0, "worse$": 3.0}, -1.0)
    monkeypatch.setattr(toxicity, "MEMO", 2)
    for _ in range(2):
        assert [scorer.evidence(t) for t in ("some grim text that goes onwards", "worse than grim", "", "fine words only here")] == [2.0, 5.0, 0.0, 0.0]
        assert len(scorer.memo) < 12


def test_new_pre_tokens_go_to_the_library_together():
    encoder = IdEncoder(vocabulary("byte_bpe_50k.json"))
    words = {f" word{k}" for k in range(600)} | {"'s", "\n\n", " ÿ", "ÿÿ", "é", " 12", "\0", " " * 40}
    alone = {w: np.array(encoder.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words}
    assert encoder._encoded(words) == alone
    separator, encoder.separator = encoder.separator, None  # a vocabulary that could join across it
    assert separator is not None and encoder._encoded(words) == alone
    text = " it's we'll I'd they've 12½ÿ ɏx\n\n  y'z 'S'"
    assert encoder.encode([text])[0] == np.array(encoder.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
