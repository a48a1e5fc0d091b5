"""Packing: exact round trip of every token, gapless sequences, no padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(docs):
    pieces = packing.pack(docs, PATH).collect()
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(r.text)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    tokenizer = Tokenizer.from_file(PATH)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        if len(texts[doc_id]) > 1:
            continue
        ids = np.array(tokenizer.encode(texts[doc_id][0] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == own[0].tier <= 2048 and at & (at - 1) == 0
    return pieces


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = check(docs.repartition(3, "doc_id"))
    tokens = sum(p.length for p in pieces)
    assert sum(p.length for p in pieces if p.tier == 2048) > 0.5 * tokens
    assert len({p.sequence_id for p in pieces if p.tier < 256}) <= 3 * 8
    steps = defaultdict(set)
    for p in pieces:
        steps[p.step_id].add((p.sequence_id, p.tier))
    full = [sum(t for _, t in s) for s in steps.values()]
    assert max(full) <= packing.STEP_TOKENS
    none = packing.padding(packing.pack(docs, PATH)).first()
    assert none.padding == 0 and none.tokens == tokens


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 3000)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1))


def test_odd_texts(spark):
    texts = [None, "", " \n\t ", "a", "Ünï­code ÀÉ É é ΟΔΟΣ ὈΔΥΣΣΕΎΣ. İstanbul ſ K", "it's we'll IT'S 1234 a1b2 x.y,z .,. ...", "<|endoftext|> <|ENDOFTEXT|>a<|startoftext|>",
             "tab\tand\r\nnbsp em sep\x1cend\x85", "漢字かな 한국어 ไทย हिन्दी", "x" * 5000, "word " * 6000, "$$$%%%. a$b!? --- (c)", "가 ᾳ Ǆ ŉ"]
    docs = spark.createDataFrame([(i, t, "en", i) for i, t in enumerate(texts)], "doc_id long, text string, lang string, tier long")
    check(docs)
    assert {p.doc_id: p.length for p in check(docs.limit(3))} == {0: 1, 1: 1, 2: 1}
    again = check(docs.union(docs))
    assert sum(p.length for p in again) == 2 * sum(p.length for p in packing.pack(docs, PATH).collect())
    nulls = packing.pack(docs.withColumn("doc_id", F.lit(None).cast("long")), PATH)
    assert nulls.where("doc_id is null").count() == nulls.count() > 0
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_every_character_beside_stops_and_commas():
    import sys
    import unicodedata
    tokenizer, words = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    assigned = (chr(i) for i in range(min(sys.maxunicode, 0x2FFFF)) if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co"))
    different = []
    for c in assigned:
        for text in (f"a {c}. b {c}, d", f"a .{c} b ,{c} d"):
            if words.text(text) != np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes():
                different.append((hex(ord(c)), text))
    assert different == []
