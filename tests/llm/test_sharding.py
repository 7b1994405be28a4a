"""Dealing by size classes against the plain heap."""

import heapq
import random

from marquee.llm import sharding


def plain_heap(sizes, shards):
    heap = [(0, k) for k in range(shards)]
    for size in sorted(sizes, reverse=True):
        at, k = heapq.heappop(heap)
        heapq.heappush(heap, (at + size, k))
    return sorted(at for at, _ in heap)


def dealt(sizes, shards):
    counts = {}
    for size in sizes:
        counts[size] = counts.get(size, 0) + 1
    table = sharding.longest_first([(c, n, c * n) for c, n in counts.items()], shards)
    loads = [0] * shards
    for at, (cls, rank, k) in enumerate(table.tolist()):
        end = table[at + 1][1] if at + 1 < len(table) and table[at + 1][0] == cls else counts[cls]
        loads[k] += cls * int(end - rank)
    return sorted(loads)


def test_a_shard_far_above_the_level():
    """A group of a third, and one of a tenth, of all bytes beside classes of far more than 4 * 24 groups."""
    rng = random.Random(3)
    for part in (3, 10):
        sizes = [rng.choice((40, 64, 100, 513, 1024, 1500, 1999)) for _ in range(20_000)]
        sizes.append(sum(sizes) // (part - 1))
        assert dealt(sizes, 24) == plain_heap(sizes, 24)


def test_few_groups_and_several_hot_ones():
    rng = random.Random(4)
    for n in (1, 23, 24, 25, 96, 97, 300):
        sizes = [rng.choice((9, 10, 12)) for _ in range(n)] + [5000, 700, 90]
        assert dealt(sizes, 24) == plain_heap(sizes, 24)
