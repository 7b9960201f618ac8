import random

import pytest
from pyspark.sql import functions as F

from scenequarry.operators import codebooks as CB

FEW = [(i, [float(i % 6), 1.0]) for i in range(44)]
HOT = [(i, [0.0, 0.0] if i < 900 else [float(x) for x in random.Random(i).choices(range(50), k=2)]) for i in range(1000)]


@pytest.mark.parametrize(("rows", "k", "limit"), [(FEW, 5, 256), (FEW, 6, 256), (FEW, 9, 256), (FEW, 5, 2), (HOT, 40, 256), (HOT, 40, 4), ([], 3, 256), ([(1, None), (2, [1.0, 2.0])], 3, 256)])
def test_codes_of_palettes(spark, rows, k, limit):
    """As many codes as asked for or as there are different vectors; each is used, and each row has its nearest one."""
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("code", F.lit("old")).withColumn("w", F.lit("old"))
    centres, labels = CB.kmeans(df, "id", "v", k, 4, direct_limit=limit)
    centre = {r.code: r.centre for r in centres.collect()}
    label = {r.id: r.code for r in labels.collect()}
    vectors = {i: v for i, v in rows if v is not None}
    assert len(centre) == min(k, len({tuple(v) for v in vectors.values()}))
    assert set(label) == set(vectors) and set(label.values()) == set(centre)
    for i, v in vectors.items():
        far = {c: sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for c, m in centre.items()}
        if limit >= k:
            assert far[label[i]] <= min(far.values()) + 1e-9
