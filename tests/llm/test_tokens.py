from __future__ import annotations

import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from catchframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(library):
    r = random.Random(3)
    letters = "abstremdlvSTR''''  \n\t\r\x0b!?12é  ЖZ日😀½_\x1c\x85"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(4_000)]
    texts += ["", None, "a" * 3_000, "'" * 200, "ab" * 2_000 + " " * 300 + "x", "'s 's a's\n's 'll 'l 'rx I'VE I've", "x  ", "  x"]
    enc = bpe.encoder(PATH)
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text or "")
        assert enc.decode(ids, enc.offsets(ids)) == (text or "").encode()


def test_every_code_point(library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 11 == 0)]
    texts = [f"a{chr(c)} {chr(c)}1{chr(c)}{chr(c)}b" for c in codes]
    got = bpe.encoder(PATH).encode(texts)
    assert all(a.tolist() == b for a, b in zip(got, library.encode_ordinary_batch(texts), strict=True))


def test_scan_does_not_depend_on_blocks():
    codes = np.frombuffer(("I'm here  now\n " * 500).encode("utf-32-le"), dtype=np.uint32)
    starts = bpe.word_starts(codes)
    state, want = bpe.FREE, []
    for kind in bpe._classes(codes):
        state, start = bpe._step(state, int(kind))
        want.append(start)
    assert starts.tolist() == want


def test_long_merges_equal_short_ones():
    ranks = bpe.encoder(PATH).ranks
    for word in (b"antidisestablishment", "ûñïçödé".encode(), b"aaaaaaaaaaaaaaaa", b"\xff\xfe\x00"):
        parts = [word[i:i + 1] for i in range(len(word))]
        assert bpe._merge_short(list(parts), ranks) == bpe._merge_long(list(parts), ranks)


def test_round_trip(odd, nothing, library):
    done = bpe.decode(bpe.encode(odd, PATH), PATH)
    assert done.columns[:5] == odd.columns[:5] and done.columns.count("token_ids") == 1
    rows = done.select("text", "decoded", bpe.unpack(F.col("token_ids")).alias("ids"), F.length("token_ids").alias("n")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode()
        if 0 < r.n < 1_000:
            assert r.ids == library.encode_ordinary(r.text)
    assert bpe.digests(nothing, PATH).count() == 0


def test_digests(prose, library):
    for r in bpe.digests(prose(40), PATH).join(prose(40), "doc_id").collect():
        ids = library.encode_ordinary(r.text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
