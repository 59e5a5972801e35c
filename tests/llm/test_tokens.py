"""Packing and token-id files against plain encoding."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plotweave.llm import id_files, packing
from plotweave.llm.token_ids import Encoder, default_path


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(default_path())
    return lambda text: list(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_encoder_equals_the_tokenizer(plain):
    pick = random.Random(3)
    alphabet = list("ab.'s,\n \t#é1  \0|½́-  ")
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", "a   b", "a \n b", "it's we'll", "end\n", "<|endoftext|> x", "a <|endoftext|>b  c", "<|endoftext|>" * 3, "<|endoftext| >", "x . y ,z", "don't. 'S", "###a###"]
    found = Encoder(default_path()).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain(t) for t in texts]


def test_encoder_of_a_slice(plain):
    texts = pa.array([f"word{k} Éx, more" for k in range(50)])
    found = Encoder(default_path()).encode(texts.slice(20, 10))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain(t) for t in texts.slice(20, 10).to_pylist()]


def test_encoder_forgets_and_stays_right(plain, monkeypatch):
    from plotweave.llm import token_ids

    monkeypatch.setattr(token_ids, "KNOWN_UNITS", 5)
    encoder = Encoder(default_path())
    for k in range(30):
        text = f"some words{k} and others{k % 3}, then {'long' * 20}"
        assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u4").tolist() == plain(text)


def brute_best(lengths, capacity):
    reach = {0}
    longest = max(lengths)
    rest = list(lengths)
    rest.remove(longest)
    for x in rest:
        reach |= {r + x for r in reach if r + x <= capacity - longest}
    return longest + max(reach)


def test_least_slack_is_the_best_sum():
    pick = random.Random(5)
    for _ in range(200):
        lengths = [pick.randint(1, 60) for _ in range(pick.randint(1, 14))]
        counts = np.bincount(lengths, minlength=101)
        chosen = packing.least_slack(counts, 100)
        assert sum(chosen) == brute_best(lengths, 100)
        assert all(chosen.count(x) <= lengths.count(x) for x in chosen)


def test_pieces_cover_each_document_once(corpus, plain):
    rows = packing.pack(corpus).collect()
    docs = [r for r in corpus.collect()]
    wanted = sorted((d.doc_id or -1, np.array(plain(d.text) + [0], "<u4").tobytes()) for d in docs)
    pieces = {}
    for r in sorted(rows, key=lambda r: r.start):
        pieces.setdefault((r.doc_id or -1, r.doc_tokens), []).append(r)
    total = sum(r.length for r in rows)
    assert total == sum(len(x) // 4 for _, x in wanted)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        assert any(i == (r.doc_id or -1) and x[4 * r.start : 4 * (r.start + r.length)] == r.ids for i, x in wanted)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024


def test_packing_fills_sequences(spark, sf_dir):
    rows = packing.op1_packing(spark, sf_dir).groupBy("sequence_id").sum("length").collect()
    assert all(r[1] & (r[1] - 1) == 0 and r[1] <= 1024 for r in rows)
    assert sum(r[1] < 1024 for r in rows) <= 10 * 8


def test_nothing_in_nothing_out(empty):
    assert packing.pack(empty).count() == 0
    files = id_files.write_ids(empty)
    assert id_files.read_ids(files, id_files.keys_of(empty)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 500, 3000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype("uint64")
    pilots = id_files.build_pilots(keys)
    assert sorted(id_files.slots_of(keys, pilots, n)) == list(range(n))


def test_files_round_trip(corpus, plain):
    files = id_files.write_ids(corpus, shard_ids=2000)
    assert files.shards.count() > 3
    rows = id_files.read_ids(files, id_files.keys_of(corpus)).collect()
    docs = sorted(corpus.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text or ""))
    at = 0
    found = {(r.doc_id, r.repeat): r for r in rows}
    repeat, last = 0, object()
    for d in docs:
        repeat = repeat + 1 if d.doc_id == last else 0
        last = d.doc_id
        ids = np.array(plain(d.text) + [2], "<u4").tobytes()
        r = found.pop((d.doc_id, repeat))
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids) // 4, ids)
        at += len(ids) // 4
    assert not found


def test_unknown_keys_are_not_found(spark, corpus):
    files = id_files.write_ids(corpus)
    keys = spark.range(10**6, 10**6 + 2000).selectExpr("id AS doc_id", "0L AS repeat")
    assert id_files.find(files, keys).count() == 0


def test_op7_equals_plain_encoding(spark, sf_dir, plain):
    rows = {r.doc_id: r for r in id_files.op7_id_files(spark, sf_dir).collect()}
    at = 0
    for d in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda d: d.doc_id):
        ids = np.array(plain(d.text) + [2], "<u4").tobytes()
        r = rows.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert not rows


def test_keys_with_one_hash_are_hashed_again(monkeypatch):
    """A bucket whose keys share a hash by its first seeds."""
    plain, tried = id_files.key_hashes, []

    def narrow(doc_ids, repeats, seed):
        tried.append(seed)
        return plain(doc_ids, repeats, seed) >> np.uint64(62 if seed < 2 else 0)

    monkeypatch.setattr(id_files, "key_hashes", narrow)
    ids, repeats = pa.array([5, 5, 7, None, None, 0]), np.array([0, 1, 0, 0, 1, 0])
    seed, hashes = id_files.distinct_hashes(ids, repeats)
    assert seed == 2 and tried == [0, 1, 2] and len(set(hashes.tolist())) == 6


def test_lookup_of_few_keys_reads_their_files_only(spark, corpus, plain):
    docs = corpus.select("doc_id", "text").unionByName(spark.range(1000, 1400).selectExpr("id AS doc_id", "repeat('some words ', int(id)) AS text"))
    files = id_files.write_ids(docs, shard_ids=2000)
    keys = spark.createDataFrame([(1001, 0), (1203, 0), (99999, 0), (11, 1)], "doc_id long, repeat long")
    rows = id_files.read_ids(files, keys)
    found = {(r.doc_id, r.repeat): np.frombuffer(r.ids, "<u4").tolist() for r in rows.collect()}
    assert set(found) == {(1001, 0), (1203, 0), (11, 1)}
    assert found[(1001, 0)] == plain("some words " * 1001) + [2]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    parts = re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", plan)
    assert len(parts) >= 2 and all(int(some) < int(every) for some, every in parts)


def test_a_key_with_anothers_fingerprint_is_not_read(spark, monkeypatch):
    """Places that the index gives for keys that were never stored."""
    docs = spark.createDataFrame([(1, "one"), (2, "two words")], "doc_id long, text string")
    files = id_files.write_ids(docs)
    place = id_files.find(files, id_files.keys_of(docs)).where("doc_id = 1").toPandas().assign(doc_id=77)
    wrong = spark.createDataFrame(place)
    monkeypatch.setattr(id_files, "find", lambda files, keys: wrong)
    assert id_files.read_ids(files, id_files.keys_of(docs)).collect() == []


def test_units_are_encoded_side_by_side(plain, monkeypatch):
    """Few calls for many units, the same ids, and one by one where bytes do not tell them apart."""
    words = ["a", "Ġb", "中文", "½", "é" * 90, "'s", "don't", "--x", "1990", "<|endof", "text|>", "\ud7ff", "x\u200by"]
    units = [f" {w}{k}" for w in words for k in range(40)] + ["no space", "", " ", "\n", " two words", " \x1cq"]
    encoder, calls = Encoder(default_path()), []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return Encoder(default_path()).tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    expected = [encoder._bytes(plain(u)) for u in units]
    assert encoder._encoded(units) == expected
    assert sum(calls) < 20
    encoder.n_bytes = encoder.n_bytes + 1
    assert encoder._encoded(units) == expected
