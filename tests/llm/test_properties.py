"""Properties of the parts that run in one process, over drawn inputs."""

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from textmill.llm import html_text, packing, sharding, simhash


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=40))
def test_a_plan_places_every_piece_once_within_capacity(counts):
    runs = packing.plan_runs(counts, capacity=64, bin_width=4)
    fill, placed = defaultdict(list), defaultdict(int)
    for r in runs:
        assert r.rank == placed[r.length]
        placed[r.length] += r.n
        for k in range(r.n):
            fill[r.seq + k].append((r.offset, r.length))
    assert dict(placed) == counts and sorted(fill) == list(range(len(fill)))
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 10**6), min_size=1, max_size=4), max_size=60), st.integers(4, 16))
def test_differencing_keeps_every_weight_in_one_shard(vectors, shards):
    labels, sums = sharding.differencing(vectors, shards)
    totals = [0] * shards
    for own, vector in zip(labels, vectors):
        assert len(set(own)) == len(own)  # the parts of one partial partition stay apart
        for label, weight in zip(own, vector):
            totals[label] += weight
    assert totals == (sums or [0] * shards)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3), st.integers(0, 14))
def test_pairs_within_three_bits_share_a_table(x, bits, _):
    y = x
    for b in set(bits):
        y ^= 1 << b
    assert any(x & m == y & m for m in simhash.covering_masks(list(range(64)), 3))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap!-\"'= &;x", max_size=60))
def test_any_markup_parses(source):
    page = html_text.parse(source)
    assert len(page.lines) == len(page.marks) == len(page.links)
    assert all(line and line == " ".join(line.split()) for line in page.lines)
    assert len(page.parts) == len(page.lines)
    html_text.main_text(page, html_text.parse(source[::-1]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=30, unique=True), st.integers(0, 63))
def test_local_links_span_the_near_pairs(values, bit):
    values = sorted({simhash._signed(v) for v in values} | {simhash._signed(v ^ (1 << bit)) for v in values[:10]})
    if len(values) < 2:
        return
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    links = simhash._local_links(values, 3)
    for u, v in links:
        parent[find(u)] = find(v)
    assert len(links) == len(values) - len({find(v) for v in values})
    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                assert find(a) == find(b)
