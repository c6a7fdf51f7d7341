"""The registered queries against brute force over the smallest tables, through the contracts' own words."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash

from tidewright.llm import binary, counts, packing, pieces, queries, rules, simhash, suffixes, vectors
from tidewright.llm.common import vocabulary
from tidewright.llm.ids import encoder

WORD = re.compile("[^ \t-\r]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def ids(docs):
    library = encoder(vocabulary("byte_bpe_50k.json")).library
    return {d: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in docs}


def rows(spark, sf, name):
    return queries.QUERIES[name](spark, sf).toPandas()


def test_op1_decodes_losslessly(spark, sf, docs):
    found = rows(spark, sf, "op1_sentencepiece_dropout").set_index("doc_id")
    assert len(found) == len(docs)
    for d, t in docs:
        assert found.text_crc32[d] == zlib.crc32(t.encode())
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    assert sum(found.n_ids[d] > len(library.encode(t)) for d, t in docs) > len(docs) * 0.9  # dropout cuts finer


def test_op2_and_op5_held_out(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    for name, column, least in (("op2_quality_embeddings", "quality", 0.85), ("op5_toxicity_channel", "toxic", 0.8)):
        found = rows(spark, sf, name).set_index("doc_id")
        assert found.score.between(0, 1).all()
        assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in found.held_out.items())
        threshold = 0.7 if column == "quality" else 0.3
        assert (found.predicted == (found.score >= threshold)).all()
        held = found[found.held_out].join(labels, how="inner")
        assert (held.predicted == held[column]).mean() >= least


def test_op3_packs_every_id_once(spark, sf, docs, ids):
    found = rows(spark, sf, "op3_tiered_packing")
    seen = {d: np.zeros(len(x), int) for d, x in ids.items()}
    for r in found.itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
        seen[r.doc_id][r.start : r.start + r.length] += 1
    assert all((x == 1).all() for x in seen.values())
    sizes = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, g in sizes:
        assert (g.offset.to_numpy() == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all()
    total = sizes.length.sum()
    assert total.max() <= 1024
    assert sum(0 if n & (n - 1) == 0 else 1024 - n for n in total) <= 1023 * 8


def test_op4_equals_brute_force(spark, sf, docs):
    found = rows(spark, sf, "op4_simhash_byte_index").set_index("doc_id")
    prints = {}
    for d, t in docs:
        words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert found.fingerprint[d] == f"{prints[d]:016x}"
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(prints)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert all(found.component_id[d] == find(d) for d in order)


def brute_removal(docs, length=100):
    seen, out = set(), {}
    for d, t in docs:
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        kept = np.frombuffer(data, "u1")[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_op6_equals_brute_force(spark, sf, docs):
    found = queries.QUERIES["op6_suffix_array_dedup"](spark, sf).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == brute_removal(docs)


def test_op7_files_give_the_ids_back(spark, sf, docs, ids, tmp_path):
    found = rows(spark, sf, "op7_token_id_files").set_index("doc_id")
    start = 0
    for d, _ in docs:
        assert (found.start[d], found.n_tokens[d], found.ids_crc32[d]) == (start, len(ids[d]), zlib.crc32(ids[d].tobytes()))
        start += len(ids[d])
    binary.write_ids(spark.read.parquet(f"{sf}/documents.parquet"), f"{tmp_path}/ids", shards=3)
    assert binary.read_document(spark, f"{tmp_path}/ids", docs[7][0]) == [ids[docs[7][0]].tolist()]
    assert binary.read_document(spark, f"{tmp_path}/ids", -5) == []


def test_op8_equals_longest_match(spark, sf, docs):
    found = rows(spark, sf, "op8_longest_match_counts").set_index("doc_id")
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    known = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    longest, memo = max(map(len, known)), {}

    def count(word):
        n = i = 0
        while i < len(word):
            size = next((k for k in range(min(longest, len(word) - i), 0, -1) if word[i : i + k] in known), 0)
            n += 1 if size else len(word[i].encode())
            i += size or 1
        return n

    for d, t in docs:
        words = WORD.findall(t)
        assert found.n_words[d] == len(words)
        assert found.n_tokens[d] == sum(memo[w] if w in memo else memo.setdefault(w, count("▁" + w)) for w in words)


def test_op9_equals_sql(spark, sf):
    con = duckdb.connect()
    p = f"{sf}/documents.parquet"
    con.execute(f"create view documents as select * from read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    expected = con.execute(rules.OP9_SQL).df().sort_values("doc_id").reset_index(drop=True)
    found = rows(spark, sf, "op9_weak_supervision_rules").sort_values("doc_id").reset_index(drop=True)
    assert (found[expected.columns] == expected).all().all()


def test_op10_equals_brute_force(spark, sf):
    found = rows(spark, sf, "op10_collision_projections").set_index("vec_id")
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    assert_links(found, table)


def assert_links(found, table, cosine=0.98):
    root = {v: v for v in table.vec_id}
    links = dict.fromkeys(table.vec_id, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for _, g in table[table.label.notna()].groupby("label"):
        x = vectors.unit(np.array(g.embedding.tolist(), "f8"))
        for i, j in np.argwhere(np.triu(x @ x.T >= cosine, 1)):
            a, b = int(g.vec_id.iloc[i]), int(g.vec_id.iloc[j])
            links[a] += 1
            links[b] += 1
            p, q = sorted((find(a), find(b)))
            root[q] = p
    for v in table.vec_id:
        assert (found.n_links[v], found.component_id[v], found.kept[v]) == (links[v], find(v), find(v) == v)


def test_pipeline_stages(spark, sf, docs):
    import corpus_pipeline as p

    frame, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in p.STAGES[:-1]:
        before = frame
        frame = p.materialize(stage(spark, before, sf), "t")
        assert frame.columns == before.columns
        kept[name] = {r["doc_id"]: r["text"] for r in frame.collect()}
    scores = rows(spark, sf, "op2_quality_embeddings").set_index("doc_id").score
    assert set(kept["quality_classifier"]) == {d for d, _ in docs if scores[d] >= 0.7}
    assert set(kept["quality_rules"]) <= set(kept["quality_classifier"])
    left = kept["quality_rules"]
    prints = {d: simhash.fingerprint(t) for d, t in left.items()}
    for d in set(left) - set(kept["simhash_dedup"]):
        assert any((prints[d] ^ prints[o]).bit_count() <= 3 for o in left if o != d)
    removed = brute_removal(sorted(kept["simhash_dedup"].items()))
    for d, t in kept["passage_dedup"].items():
        size, gone, _, digest = removed[d]
        assert len(t.encode()) <= size - gone and (size - gone - len(t.encode()) > 0 or hashlib.sha256(t.encode()).hexdigest() == digest)
    packed = p.STAGES[-1][1](spark, frame, sf).toPandas()
    assert packed.groupby("doc_id").length.sum().to_dict() == packed.groupby("doc_id").doc_tokens.first().to_dict()
    assert set(packed.doc_id) == set(kept["passage_dedup"])
