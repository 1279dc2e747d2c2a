import random
import struct
import zlib
from functools import cache

import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing as P
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def odd_texts():
    rng = random.Random(5)
    alphabet = list("aZ09 \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 '.,!?*|<>$éÉßΣςİıǰJ̌́ﬁ가각가क़字🙂ñ_-%&#") + \
        ["'s", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " the ", "Hello", "don't", "x² ", "I'LL"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(600)]


def test_word_tokens_equal_the_tokenizer():
    mine, plain = P.WordTokens(PATH), tokenizer()
    for text in odd_texts():
        ids = plain.encode(text, add_special_tokens=False).ids
        assert mine.encode(text.encode()) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 3)
    mine = P.WordTokens(PATH)
    for text in ("a b c d e", "the cat sat, the CAT", "a b"):
        assert list(struct.unpack(f"<{len(mine.encode(text.encode())) // 4}I", mine.encode(text.encode()))) == direct(text)[:-1]


def test_pieces_cover_documents(spark):
    rows = [(1, "the cat " * 5000, 1), (2, None, 2), (3, "", 3), (4, "a", 4), (None, "b c", 5), (4, "a", 6), (5, "x! " * 2047 + "y", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int")
    pieces = P.decompose(docs, PATH).collect()
    by_doc = {}
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 4096 and len(p.ids) == 4 * p.length and p.offset == 0
        by_doc.setdefault(p.id, []).append(p)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for key, text in [(1, "the cat " * 5000), (2, ""), (3, ""), (None, "b c"), (5, "x! " * 2047 + "y")]:
        own = sorted(by_doc[key], key=lambda p: p.start)
        ids = b"".join(p.ids for p in own)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == direct(text)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
    assert len(by_doc[4]) == 2 * len(P.cuts(2))
    assert P.decompose(docs.limit(0), PATH).count() == 0


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {}
    for r in QUERIES["op9_power_of_two_packing"](spark, sf).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert found.keys() == docs.keys()
    for key, text in docs.items():
        ids = direct(text)
        for p in found[key]:
            part = ids[p.start:p.start + p.length]
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        assert sum(p.length for p in found[key]) == len(ids)
