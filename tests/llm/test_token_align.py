"""Alignment of tokens: groups, links and counts against a plain version over whole texts."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import pytest

from dealscope.llm import token_align
from dealscope.llm.queries import TOKENIZERS

PATHS = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
ODD = ["", " ", "  ", "a", " a ", "a  ", "\n", "a \n b", "▁", "a▁ b", "x ▁▁ y", "<|endoftext|> hi", "<s> </s> <unk> <0x41>",
       "ﬁ ½ é é", "日本語 テキスト", "🙂🙂 a🙂", " a  b", "\x1c a\x1d b", "a\x00b c", "don't 's 'll 123 12 3", "tab\t\tx  y   z ",
       "a" * 5000, "ab" * 3000 + " " + "é" * 100, "\u0085 x\u0085", "x​ y", "Ａ ｂ", "\r\n\r\n x", None]


@pytest.fixture(scope="module")
def pair():
    return token_align.Pair(*PATHS)


def plain_groups(pair, text):
    """Groups of ids, from encodings of the whole text."""
    if not text:
        return []
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    raw = [[table[i] for i in own] for table, own in zip((pair.a_bytes, pair.b_bytes), ids)]
    if any(b"".join(r) != f" {text}".encode() for r in raw):
        return []
    ends = [list(accumulate(map(len, r))) for r in raw]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in cuts]
    for side in (0, 1):
        for i, end in zip(ids[side], ends[side]):
            groups[bisect.bisect_left(cuts, end)][side].append(i)
    return groups


def plain(pair, docs):
    held, groups = Counter(), [plain_groups(pair, t) for _, t in docs]
    links = [Counter((a, b) for left, right in g for a in left for b in right) for g in groups]
    for own in links:
        held.update(own.keys())
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for (doc_id, _), g, own in zip(docs, groups, links):
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        yield (doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
               sum(n for p, n in own.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in own.items()),
               hashlib.sha256(text.encode()).hexdigest() if text else "")


def key(row):
    return (row[0] is None, *row)


def test_odd_texts(spark, pair):
    dice = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "▁", "'s", "1", "the", " the", "\t", "ﬁ", " ", "🙂"]
    texts = ODD + ["".join(dice.choice(parts) for _ in range(dice.randint(1, 20))) for _ in range(300)]
    rows = [(i % 290 or None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS chunk", "2 AS n", "'p' AS pair")
    got = sorted(map(tuple, token_align.document_alignment(frame, *PATHS).collect()), key=key)
    assert got == sorted(plain(pair, rows), key=key)


def test_documents(spark, sf_dir, pair, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, token_align.document_alignment(docs, *PATHS).collect()), key=key)
    assert got == sorted(plain(pair, rows), key=key)
    groups = {r.doc_id: r.groups for r in token_align.token_groups(docs, *PATHS).collect()}
    assert all((hashlib.sha256(groups[r[0]].encode()).hexdigest() if r[1] else "") == r[7] for r in got)


def test_several_chunks_and_whole_texts_as_units(pair, monkeypatch):
    texts = [t for t in ODD if t] * 3
    whole = token_align._Chunk(pair)
    for text in texts:
        whole.add(0, text)
    cut = whole.links()
    monkeypatch.setattr(pair, "splits", False)
    monkeypatch.setattr(pair, "fast", None)
    monkeypatch.setattr(token_align, "CALL_CHARS", 10)
    monkeypatch.setattr(token_align, "LOOKUP_UNITS", 3)
    other = token_align._Chunk(pair)
    for text in texts:
        other.add(0, text)
    plainly = other.links()
    for (_, a), (_, b) in zip(whole.docs, other.docs):
        assert token_align._groups_text(a, cut.text) == token_align._groups_text(b, plainly.text)


def test_ranks_give_the_tokenizers_ids(pair, spark, sf_dir):
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert pair.fast.encode_ordinary(" " + row.text) == pair.a.encode(" " + row.text, add_special_tokens=False).ids


def test_empty_table(no_docs):
    assert token_align.document_alignment(no_docs, *PATHS).collect() == []
