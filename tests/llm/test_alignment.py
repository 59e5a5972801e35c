"""Alignment of two tokenizers against a plain reading of the rule."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plotweave.llm import alignment
from plotweave.llm.token_ids import default_path

ODD = [
    "a  b", "   a", " a ", "x▁y", "▁", "a\0b", "tab\tand\r\nline", "<|endoftext|> and <s> </s> <unk>", "é́ ½ ﬁ　x",
    "日本語の文 \U0001f600\U0001f600", "<0x41>", "0123456789 " * 5, "word" * 300, "\n\n\n", "don't we'll I'M", "a b   c", ".,;:!? ...", "x",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=alignment.piece_path())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def tokens(text):
        if not text:
            return [], []
        of_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(x for _, x in of_a) == whole == b"".join(x for _, x in of_b)
        return (of_a, of_b) if same else ([], [])

    return tokens


def spans(tokens):
    ends = np.cumsum([len(x) for _, x in tokens]).tolist()
    return list(zip([i for i, _ in tokens], [0, *ends], ends))


def brute(docs, tokens):
    """One pass per text with two pointers."""
    found = []
    count = collections.Counter()
    for doc_id, text in docs:
        a, b = map(spans, tokens(text))
        links, groups, left, right, i, j = [], [], [], [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            end_a, end_b = a[i][2], b[j][2]
            if end_a <= end_b:
                left.append(a[i][0])
                i += 1
            if end_b <= end_a:
                right.append(b[j][0])
                j += 1
            if end_a == end_b:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        count.update(set(links))
        found.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, text in found:
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        n_best = sum(count[k] == best[k[0]] for k in links)
        out.append((str(doc_id), n_a, n_b, n_groups, len(links), n_best, sum(count[k] for k in links), digest))
    return sorted(out)


def found(rows):
    return sorted((str(r[0]), *r[1:]) for r in rows.collect())


@pytest.mark.parametrize("budget", [alignment.BUDGET, 4000, 0])
def test_odd_rows_and_budgets(spark, corpus, plain, budget):
    odd = spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD * 2)], "doc_id long, text string")
    docs = corpus.unionByName(odd, allowMissingColumns=True)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], plain)
    assert found(alignment.align(docs, budget=budget)) == expected


def test_query(spark, sf_dir, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = alignment.op11_alignment(spark, sf_dir)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found(rows) == brute(docs, plain)


def test_empty(empty):
    assert alignment.align(empty).collect() == []


def test_encoder_equals_the_model():
    pick = random.Random(3)
    alphabet = list("ab.'s,\n \t#é1  \0▁中Zß($-") + ["the", "ing", "...", "://", "é", " "]
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(1, 30))) for _ in range(3000)]
    plain = SentencePieceProcessor(model_file=alignment.piece_path())
    parts = alignment.PieceEncoder(alignment.piece_path()).encode(pa.array([" " + t for t in texts], pa.large_string()))
    assert [np.frombuffer(p, "<u4").tolist() for p in parts] == plain.encode(texts)


def test_encoder_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 5)
    encoder, plain = alignment.PieceEncoder(alignment.piece_path()), SentencePieceProcessor(model_file=alignment.piece_path())
    for k in range(20):
        text = f"some words{k} and others{k % 3}, then {'long' * 20}"
        (ids,) = encoder.encode(pa.array([" " + text], pa.large_string()))
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text)


@pytest.mark.parametrize("seed", range(4))
def test_divide_and_conquer(seed):
    """Shared cuts that are many, few or none but the last."""
    pick = random.Random(seed)
    ends_a, ends_b, sizes, expected, base = [], [], [], [], 0
    for _ in range(60):
        length = pick.choice([1, 2, 50, 3000])
        share = pick.choice([0.02, 0.3, 0.9])
        a = sorted({x for x in range(1, length) if pick.random() < share} | {length})
        b = sorted({x for x in range(1, length) if pick.random() < pick.choice([0.01, 0.5])} | {length})
        expected += [len(ends_a) + k for k, x in enumerate(a) if x in set(b)]
        ends_a, ends_b, sizes = ends_a + [base + x for x in a], ends_b + [base + x for x in b], sizes + [len(a)]
        base += length
    got = alignment.groups(np.array(ends_a), np.array(ends_b), np.array(sizes))
    assert got.tolist() == expected
