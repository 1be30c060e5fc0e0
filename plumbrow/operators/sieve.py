"""Keeping rows out of a shuffle that none of them would be joined in.

A join with staged hashes that are too many to be broadcast shuffles every row of the mart with all its
columns, though few have one of the hashes. So the hashes also set bits, two each, in a bounded number
of words, which every task gets. A row whose bits are not set has none of the hashes and goes no
further; for the others the join decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.sources.staging import release_shuffles, stage

# So few hashes are about to be broadcast themselves.
_FEW_HASHES = 20_000

# With 16 bits a hash, one or two in a hundred other rows pass; with 8, five or six. 2^26 bits are 8 MB.
_BITS_PER_HASH = 16
_MOST_BITS = 2**26

_WORDS_PER_BLOCK = 1024


def _low(value: Column, n: int) -> Column:
    """The value modulo a power of two."""
    return value.bitwiseAND(F.lit(n - 1).cast("bigint"))


def _mask(value: Column) -> Column:
    """The bits of its word that a hash sets, from the end of the hash that does not choose the word."""
    first, second = (F.shiftrightunsigned(value, n).bitwiseAND(F.lit(63).cast("bigint")) for n in (52, 58))
    one = F.lit(1).cast("bigint")
    left = [F.call_function("shiftleft", one, bit.cast("int")) for bit in (first, second)]
    return left[0].bitwiseOR(left[1])


def _block(word: Column) -> Column:
    return F.shiftright(word, _WORDS_PER_BLOCK.bit_length() - 1)


def _words(hashes: DataFrame, name: str, n_words: int) -> DataFrame:
    """All words, in blocks: `_block` and the array `_words`."""
    spark = hashes.sparkSession
    set_bits = hashes.select(_low(F.col(name), n_words).alias("_word"), _mask(F.col(name)).alias("_bits"))
    zeros = spark.range(n_words).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    words = set_bits.unionByName(zeros).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    in_order = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    bits = F.transform(in_order, lambda word: word["_bits"])
    return words.groupBy(_block(F.col("_word")).alias("_block")).agg(bits.alias("_words"))


def sifted(rows: DataFrame, hashes: DataFrame, name: str) -> DataFrame:
    """All rows whose 64-bit hash `name` is among the staged, distinct `hashes`, and few others.

    Of few hashes, all rows: the join with them needs no shuffle.
    """
    n_hashes = hashes.count()
    if n_hashes <= _FEW_HASHES:
        return rows
    release_shuffles(hashes.sparkSession)
    least = 64 * _WORDS_PER_BLOCK
    n_bits = min(_MOST_BITS, max(least, 1 << (n_hashes * _BITS_PER_HASH - 1).bit_length()))
    n_words = n_bits // 64
    words = stage(_words(hashes, name, n_words), "sieve")
    word, mask = _low(F.col(name), n_words), _mask(F.col(name))
    place = _low(word, _WORDS_PER_BLOCK).cast("int") + 1
    may_be_there = F.element_at("_words", place).bitwiseAND(mask) == mask
    # An inner join: a semi-join would be moved below the projection that forms the hash, and form it anew
    # for each of these terms. A block occurs once.
    found = rows.join(F.broadcast(words), (_block(word) == F.col("_block")) & may_be_there)
    return found.select(*rows.columns)
