from __future__ import annotations

import random
import re
from itertools import combinations

import xxhash

from catchframe.llm import simhash
from catchframe.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(odd, prose):
    for df in (odd.where("doc_id != 5 or doc_id is null"), prose(30)):
        for r in simhash.fingerprints(df).collect():
            assert r.fp == signed(fingerprint(r.text))
    assert fingerprint(None) == 0 and simhash.fingerprint(" \n", 4, 42) == 0


def test_every_link_is_found(spark):
    """Random clusters: all pairs within four bits, by brute force."""
    r = random.Random(2)
    prints = set()
    for _ in range(60):
        centre = r.getrandbits(64)
        for _ in range(r.randrange(1, 12)):
            x = centre
            for b in r.sample(range(64), r.randrange(0, 6)):
                x ^= 1 << b
            prints.add(x)
    near = {tuple(sorted((signed(a), signed(b)))) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4}
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    for most_short in (simhash.MOST_SHORT, 0):
        got = {tuple(sorted((x.a, x.b))) for x in simhash.links(df, 1_000, most_short).collect()}
        assert got == near and len(near) > 50


def test_crowded_keys_lose_no_component(spark):
    r = random.Random(4)
    prints = {r.getrandbits(64) for _ in range(30)}
    for centre in list(prints)[:3]:
        for _ in range(60):
            x = centre
            for b in r.sample(range(64), r.randrange(0, 5)):
                x ^= 1 << b
            prints.add(x)
    nodes = [signed(x) for x in prints]
    near = [(signed(a), signed(b)) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
    df = spark.createDataFrame([(x,) for x in nodes], "fp long")
    for most_short in (simhash.MOST_SHORT, 0):
        links = simhash.links(df, 3, most_short)
        pairs = [(x.a, x.b) for x in links.collect()]
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in pairs)
        assert groups(pairs, nodes) == groups(near, nodes)


def test_every_difference_shares_a_key(spark):
    """A word and each other word within four bits share a key of either length."""
    words = [(0,)] + [(signed(sum(1 << b for b in bits)),) for k in (1, 2, 3) for bits in combinations(range(0, 64, 3), k)]
    words += [(signed(sum(1 << b for b in bits)),) for bits in combinations(range(1, 64, 5), 4)]
    df = spark.createDataFrame(words, "fp long")
    for length in (2, 3):
        shared = df.select(simhash.probe_keys("0L", length).alias("p"), simhash.index_keys("fp", length).alias("i"))
        assert shared.where("NOT arrays_overlap(p, i)").isEmpty()


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(r.randrange(500, 900), r.randrange(500, 900)) for _ in range(300)]
    nodes = {x for link in links for x in link if link[0] != link[1]}
    want = groups(links, nodes)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(odd, prose, nothing):
    docs = prose(120).collect()
    prints = {r.doc_id: fingerprint(r.text) for r in docs}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = groups(near, prints)
    found = simhash.near_duplicates(prose(120)).collect()
    assert {r.doc_id: r.component_id for r in found} == want and len(set(want.values())) < 110
    kept = simhash.keep_one(prose(120))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == prose(120).columns
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_odd_rows(odd):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert {r.component_id for r in found if r.fp == 0} == {2}
    assert [r.component_id for r in found if r.doc_id is None] == [1]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    # The repeated row and the row without an id go; of the texts without words one stays.
    assert sorted(ids) == [1, 2, 5, 6, 7]
