"""Large groups of distinct near copies."""

from __future__ import annotations

import numpy as np
import pytest

from quarrystone.llm import forest


@pytest.mark.parametrize(("n", "how"), [(2000, {}), (3000, {"leaf": 256, "sample": 1500, "large": 1024, "chunk": 512})])
def test_links_of_a_dense_group_are_counted(spark, n, how):
    rng = np.random.default_rng(n)
    x = rng.normal(size=64)
    x = (x / np.linalg.norm(x) + rng.normal(size=(n, 64)) * np.sqrt((1 / 0.97 - 1) / 64)).astype(np.float32)
    data = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = int((u @ u.T >= forest.COSINE).sum()) - n
    got = forest.near_vectors(data, **how).collect()
    assert sum(r.n_links for r in got) >= 0.99 * want and {r.component for r in got} == {0}
