"""How a task of the index build hands over a shard."""

import numpy as np
import pyarrow as pa

from emberlake.llm import ranked_search


def test_a_shard_is_handed_over_in_parts():
    rng = np.random.default_rng(5)
    texts = pa.array([" ".join(f"t{x}" for x in rng.integers(0, 3000, 200)) for _ in range(50)])
    ids = pa.array(rng.permutation(50))

    def rows(settings):
        made = list(ranked_search._shard("s", [texts], ids, 50, 10_000, settings))
        return [b.num_rows for b in made], pa.Table.from_batches(made).to_pylist()

    parts, found = rows(ranked_search.SearchSettings(batch_terms=100))
    whole, same = rows(ranked_search.SearchSettings(batch_terms=10**6))
    assert found == same and len(whole) == 2
    assert parts[0] == 1 and max(parts) == 100 and sum(parts) == sum(whole)
