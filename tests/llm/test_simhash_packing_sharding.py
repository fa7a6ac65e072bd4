import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from textmill.llm import components, packing, sharding, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= radius:
            parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for k, i in enumerate(ids):
        r = find(k)
        if i is not None:
            least[r] = i if least[r] is None else min(least[r], i)
    return [least[find(k)] for k in range(len(ids))]


def test_covering_family_misses_no_pair_within_the_radius():
    for bits, radius in ((list(range(16)), 3), (list(range(5, 14)), 3), (list(range(64)), 1)):
        masks = simhash.covering_masks(bits, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for positions in combinations(bits, radius):
            flipped = sum(1 << b for b in positions)
            assert any(not m & flipped for m in masks)


def test_fingerprints_and_components_match_brute_force(spark, odd):
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(odd).collect()]
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd.collect()]
    want = brute_components([r[0] for r in rows], [r[1] for r in rows])
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] or 0)
    assert sorted(got, key=key) == sorted([(i, p, c) for (i, p), c in zip(rows, want)], key=key)


@pytest.mark.parametrize("bucket", [2048, 2])
def test_links_join_what_brute_force_joins_also_when_buckets_are_split(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):  # a chain: each differs from the last in up to 4 bits
            prints.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    prints = sorted(simhash._signed(p) for p in prints)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.links(nodes)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for p, c in zip(prints, brute_components(prints, prints)):
        got[roots.get(p, p)].add(p)
        want[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5, 5), (77, 78), (78, 77)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0}
    assert {got[1000 + k] for k in range(60)} == {1000}
    assert (got[77], got[78]) == (77, 77)


def test_simhash_of_an_empty_table(spark, none):
    assert simhash.near_duplicates(none).count() == 0


def test_ids_are_the_tokenizers(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, words = Tokenizer.from_file(path), packing.WordIds(path)
    rng = random.Random(5)
    alphabet = "aAbBzZéÉß'.,!-%&  \n\t09²①é̸<=>İΣσς…—你好\x1c\x85’\"_<|>endoftext"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["<|endoftext|> x<|startoftext|>, <|ENDOFTEXT|>", "", *[r.text for r in odd.collect() if r.text]]
    for text in texts:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert words(text) == b"".join(i.to_bytes(4, "little") for i in ids), text


def test_packing_places_every_piece_once(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path).collect()
    plain, want = Tokenizer.from_file(path), Counter()
    for r in odd.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[r.doc_id, k // 4096, k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096


def test_packing_an_empty_table(spark, none):
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("kind", ["short", "mixed", "one", "full", "halves"])
def test_plans_are_gapless_and_near_the_bound(kind):
    rng = random.Random(kind)
    counts = {
        "short": {n: rng.randint(0, 40) for n in range(1, 400)},
        "mixed": {n: rng.randint(0, 9) for n in range(1, 4097)},
        "one": {1365: 100_000},
        "full": {4096: 10, 4095: 3, 1: 3},
        "halves": {2048: 7, 2049: 5},
    }[kind]
    runs = packing.plan_runs(counts)
    fill, ranks = defaultdict(list), defaultdict(list)
    for r in runs:
        ranks[r.length].append((r.rank, r.rank + r.n))
        if kind != "one":
            for k in range(r.n):
                fill[r.seq + k].append((r.offset, r.length))
    for length, n in counts.items():
        at = 0
        for a, b in sorted(ranks[length]):
            assert a == at
            at = b
        assert at == n
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    if kind in ("short", "mixed"):
        assert len(fill) <= 1.01 * sum(k * v for k, v in counts.items()) / 4096 + 1
    assert len(runs) < 20_000


def test_nnls_fit_beats_doing_nothing():
    import numpy as np

    patterns = packing.few_piece_patterns(32)
    assert all(p.sum() == 32 and p[0] >= p[1] >= p[2] >= 0 for p in patterns)
    histogram = np.zeros(33)
    histogram[[20, 12]] = 50  # only 20 + 12 fills a sequence
    x = packing.fit_repeats(patterns, histogram)
    best = patterns[int(np.argmax(x))]
    assert list(best) == [20, 12, 0] and abs(x.max() - 50) < 0.5


def test_differencing_is_tighter_than_greedy_and_keeps_groups():
    rng = random.Random(1)
    weights = sorted((int(rng.paretovariate(1.3) * 100) for _ in range(800)), reverse=True)
    labels, sums = sharding.differencing([(w,) for w in weights], 16)
    totals = Counter()
    for (label,), w in zip(labels, weights):
        totals[label] += w
    assert sorted(totals.values(), reverse=True) == sorted((s for s in sums if s), reverse=True)
    greedy = [0] * 16
    for w in weights:
        greedy[greedy.index(min(greedy))] += w
    assert max(sums) <= max(greedy)


def test_sharding(spark, odd, none):
    rows = sharding.shard_by_bytes(odd, 4).collect()
    assert len(rows) == odd.count()
    texts = defaultdict(set)
    by_id = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        text = by_id[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        texts[text].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(none, 4).count() == 0


def test_sharding_query_balances_bytes(spark):
    rows = sharding.op4_sharding(spark, "/root/testdata/sf0.001").collect()
    totals = Counter()
    for r in rows:
        totals[r.shard] += r["size"]
    assert set(totals) == set(range(16)) and max(totals.values()) <= 1.2 * sum(totals.values()) / 16 + max(r["size"] for r in rows)


def test_sharding_goes_through_levels_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FAN_IN", 3)  # 200 texts need several levels
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.shard_by_bytes(docs, 4).collect()
    assert len(rows) == docs.count()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
