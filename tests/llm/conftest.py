import numpy as np
import pytest

from scenequarry.llm import deobfuscation as X


@pytest.fixture(scope="session")
def letters(spark):
    words = "the idiot went to see a moron with some stupid scum and the loser was worthless trash said the clown in the pathetic disgusting house of the river and the other boat " * 40
    return X.letter_model(X.letter_counts(spark.createDataFrame([(words,), (None,), ("",)], "notes string")))


@pytest.fixture
def rng():
    return np.random.default_rng(5)
