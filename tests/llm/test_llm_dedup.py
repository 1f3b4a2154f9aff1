"""SimHash: fingerprints, covering, components and what is kept."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from clicksieve.llm import queries, simhash
from samples import SF_SMALL, documents, no_documents, odd_documents, prose


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints):
    """{row: smallest row reachable}."""
    above = list(range(len(fingerprints)))
    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= 3:
                low, high = sorted((above[i], above[j]))
                above = [low if x == high else x for x in above]
    return above


def test_query_against_brute_force(spark):
    found = queries.op2_simhash(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    ids = sorted(texts)
    expected = [brute_fingerprint(texts[i]) for i in ids]
    roots = brute_components(expected)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == [
        (i, f"{f:016x}", ids[root]) for i, f, root in zip(ids, expected, roots, strict=True)
    ]


def test_every_half_has_its_anchors():
    draw = np.random.default_rng(1)
    halves = draw.integers(0, 1 << 32, 300, dtype=np.uint32)
    rows, anchor = simhash.anchors(halves)
    assert (simhash._syndromes(anchor) == 0).all()
    assert (np.bitwise_count(halves[rows] ^ anchor) <= 2).all()
    near = {i: set(anchor[rows == i].tolist()) for i in range(300)}
    for i, half in enumerate(halves):
        assert any((int(half) ^ a).bit_count() <= 1 for a in near[i])
        for bit in range(32):  # a half one bit away has an anchor in common
            _, other = simhash.anchors(np.array([int(half) ^ 1 << bit], np.uint32))
            assert near[i] & set(other.tolist())


@pytest.mark.parametrize("slice_rows", [1024, 5])
def test_links_and_components_of_clusters(spark, slice_rows):
    draw = random.Random(slice_rows)
    centres = [draw.getrandbits(64) for _ in range(12)]
    nodes = set()
    for centre in centres:
        at = centre
        for _ in range(25):  # chains and clouds
            at = at ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) if draw.random() < 0.5 else centre
            nodes.add(at ^ 1 << draw.randrange(64))
    nodes = sorted(n - (1 << 64) if n >> 63 else n for n in nodes)
    frame = spark.createDataFrame([(n,) for n in nodes], "node long").repartition(4)
    links = simhash.link(frame, slice_rows=slice_rows)
    roots = dict(simhash.components(links).collect())
    unsigned = [n & (1 << 64) - 1 for n in nodes]
    expected = brute_components(unsigned)
    assert [roots.get(n, n) for n in nodes] == [nodes[i] for i in expected]
    assert links.count() <= 40 * len(nodes)


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert simhash.components(links).select("root").distinct().collect() == [(0,)]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = simhash.cluster(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    component = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in found}
    assert component[2, "0" * 16] == component[None, "0" * 16] == 0
    assert {c for (i, _), c in component.items() if i in (5, 6)} == {5}
    assert simhash.cluster(no_documents(spark)).collect() == []


def test_one_of_each_group_stays(spark):
    text = prose(300, 1)
    near = text.replace(text.split()[150], "other", 1)
    frame = documents(spark, [text, prose(300, 2), text, near, prose(300, 3)])
    kept = simhash.keep_first(frame)
    linked = (brute_fingerprint(text) ^ brute_fingerprint(near)).bit_count() <= 3
    assert sorted(r["doc_id"] for r in kept.collect()) == ([0, 1, 4] if linked else [0, 1, 3, 4])
    odd = odd_documents(spark)
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[5] == 1 and ids[6] == ids[1] == 0 and ids[0] == 1
    assert ids[None] == 1  # "no id" once; the null text has a row with an id to stand for it
    assert simhash.keep_first(no_documents(spark)).collect() == []
