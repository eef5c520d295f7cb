"""SA1, SA2: keyed, layout-independent sampling and train/test split.

``df.sample`` and ``randomSplit`` draw per partition, so the rows chosen
change when the same data arrives in another layout. Here a row's draw is
a hash of its key and a salt: the same rows are chosen for any partition
count and on every rerun, with no shuffle, and any SQL engine with ``md5``
can reproduce the choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEY_COLUMNS, SAMPLE_FRACTION, SEED, TRAIN_FRACTION

_TWO_32 = float(2 ** 32)


def hash_unit(keys=KEY_COLUMNS, salt: str = "") -> Column:
    """A number in [0, 1) from the first 32 bits of md5(salt|key1|key2...)."""
    text = F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") for k in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return bits / F.lit(_TWO_32)


def hash_sample(df: DataFrame, fraction: float = SAMPLE_FRACTION, keys=KEY_COLUMNS,
                seed: int = SEED) -> DataFrame:
    """SA1: about ``fraction`` of the rows, without replacement."""
    return df.filter(hash_unit(keys, f"sample:{seed}") < F.lit(float(fraction)))


def hash_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION, keys=KEY_COLUMNS,
               seed: int = SEED, out: str = "IS_TRAIN") -> DataFrame:
    """SA2: tag each row train (True) or test; disjoint and complete."""
    return df.withColumn(out, hash_unit(keys, f"split:{seed}") < F.lit(float(train_fraction)))
