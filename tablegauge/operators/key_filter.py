"""A Bloom filter over the keys of a reference, as a small table of words.

A key has three bits in one word of 64, both chosen by its hash. Words are made by `bit_or`, which combines on
the map side, and are as many as their number allows, whatever the reference holds: a full filter lets keys
pass and changes no result. The keys it holds back are certainly not in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Eight MB of bits; as rows of a hash table about 100 bytes each, 100 MB at most.
MOST_WORDS = 1 << 20
#: Bits for each key.
BITS_PER_KEY = 12

#: Types whose equal values have equal hashes.
_HASHED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def words_for(keys: int) -> int:
    """How many words a filter for that many keys takes: a power of two."""
    wanted = max(1, keys * BITS_PER_KEY // 64)
    return min(MOST_WORDS, 1 << (wanted - 1).bit_length())


def check_types(key: T.DataType, reference: T.DataType) -> None:
    if key != reference or not isinstance(key, _HASHED):
        raise ValueError(f"keys of type {key.simpleString()} and {reference.simpleString()} cannot be filtered")


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """Word and bits of a key."""
    one = F.lit(1).cast("bigint")
    h = F.xxhash64(F.lit(41), key)
    bits = F.lit(0).cast("bigint")
    for i in range(3):
        at = F.shiftrightunsigned(h, 58 - 6 * i).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", one, at.bitwiseAND(F.lit(63))))
    return F.pmod(h, F.lit(words)), bits


def filter_words(reference: DataFrame, column: str, words: int) -> DataFrame:
    """_word, _bits of the non-NULL keys of a reference."""
    key = F.col(column)
    word, bits = _place(key, words)
    rows = reference.filter(key.isNotNull()).select(word.alias("_word"), bits.alias("_bits"))
    return rows.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def with_possible(df: DataFrame, key: Column, filled: DataFrame, words: int, name: str) -> DataFrame:
    """`df` with the key where the filter lets it pass, else NULL, in the column `name`. No row moves."""
    word, bits = _place(key, words)
    held = F.coalesce("_bits", F.lit(0).cast("bigint")).bitwiseAND(F.col("_wanted")) == F.col("_wanted")
    keyed = df.withColumns({"_key_of_row": key, "_word": word, "_wanted": bits})
    joined = keyed.join(F.broadcast(filled), "_word", "left")
    return joined.withColumn(name, F.when(held, F.col("_key_of_row"))).drop("_key_of_row", "_word", "_wanted", "_bits")
