import pytest

from lectern.operators.vectors import mean_pool
from lectern.operators.encode import HashedBagOfWords, check_vectors
import numpy as np


def test_mean_pool_across_shards(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (1, [3.0, 4.0, 5.0])], "article_id long, embedding array<float>")
    out = mean_pool(df).collect()
    assert out[0].embedding == pytest.approx([2.0, 3.0, 4.0])


def test_hashed_encoder_unit_norm():
    v = HashedBagOfWords(16).encode(["the cat the hat", ""])
    assert np.linalg.norm(v[0]) == pytest.approx(1.0, rel=1e-6)
    assert not v[1].any()
    check_vectors(v, 2, 16)
    with pytest.raises(ValueError):
        check_vectors(v, 3, 16)
