"""The grammar of token shards is run to its end."""

import numpy as np
import pytest

from reshard.llm.token_shards import Body, _chosen, compress, expand, make_body, rule_lengths


def occurrences(symbols):
    """How often each pair occurs without overlapping itself."""
    counts, last = {}, {}
    for at, pair in enumerate(zip(symbols.tolist(), symbols[1:].tolist())):
        if last.get(pair) != at - 1 or pair[0] != pair[1]:
            counts[pair] = counts.get(pair, 0) + 1
            last[pair] = at
    return counts


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("least", [None, 2, 5, 8])
def test_no_pair_repeats_at_the_end(seed, least):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.zipf(1.3, 30_000), 3000).astype(np.uint32)
    if seed == 0:
        ids = np.repeat(ids[:4000], rng.integers(1, 9, 4000))
    first, rules, symbols = compress(ids) if least is None else compress(ids, least)
    assert max(occurrences(symbols).values(), default=0) < (least or 2)
    assert expand(first, rules, rule_lengths(first, rules), symbols).tolist() == ids.tolist()
    body = Body(make_body(ids, np.array([len(ids)])))
    assert body.ids().tolist() == ids.tolist() and body.ids(777, 2222).tolist() == ids[777:2222].tolist()


def test_the_more_frequent_of_two_neighbours_is_replaced():
    assert _chosen(np.array([3, 4, 9]), np.array([2, 1, 5])).tolist() == [False, True, True]
    assert _chosen(np.array([3, 4, 5, 6]), np.array([2, 2, 2, 3])).tolist() == [True, False, True, False]
