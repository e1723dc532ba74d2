"""A blocked Bloom filter: each key sets bits within one block of 256 bits, so that a probe touches one cache line.

Its size is a parameter, hence a proven bound on what is broadcast; an overfull filter only passes more keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.words import mixed
from gridloom.llm.workers import tidied

#: 64-bit words in a block, and bits a key sets (two in each word).
WORDS, BITS = 4, 8


def log_blocks(keys: int, bits_per_key: int = 16, most: int = 18) -> int:
    """Power of two of blocks for so many keys, at most 2**18 blocks (8 MB)."""
    return min(most, max(0, int(np.ceil(np.log2(max(1, keys * bits_per_key / (64 * WORDS)))))))


def key_bits(hashes: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each key's block, and the bits of each of its words (keys × WORDS)."""
    block = (hashes >> np.uint64(64 - power)).astype(np.int64) if power else np.zeros(len(hashes), np.int64)
    spread = mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))
    masks = np.zeros((len(hashes), WORDS), np.uint64)
    for k in range(BITS):
        masks[:, k % WORDS] |= np.uint64(1) << ((spread >> np.uint64(6 * k)) & np.uint64(63))
    return block * WORDS, masks


def build_bits(frame: DataFrame, power: int) -> np.ndarray:
    """The filter of column ``h`` (long, well mixed): each task makes a part, parts are merged word by word.

    What comes to the driver is the filter, of fixed size: at most 32 * 2**power bytes. Null keys are left out.
    """

    def parts(batches):
        bits = np.zeros(WORDS << power, np.uint64)
        for batch in batches:
            h = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            at, masks = key_bits(h, power)
            for k in range(WORDS):
                np.bitwise_or.at(bits, at + k, masks[:, k])
        slots = np.flatnonzero(bits)
        yield pa.record_batch([pa.array(slots, pa.int64()), pa.array(bits[slots].view(np.int64))], ["slot", "bits"])

    merged = frame.select("h").mapInArrow(tidied(parts), "slot long, bits long").groupBy("slot").agg({"bits": "bit_or"})
    table = merged.toArrow()
    bits = np.zeros(WORDS << power, np.uint64)
    bits[table.column(0).to_numpy()] = table.column(1).to_numpy().view(np.uint64)
    return bits


def probe(bits: np.ndarray, power: int, hashes: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter; never false for a key that is."""
    at, masks = key_bits(hashes, power)
    found = np.ones(len(hashes), bool)
    for k in range(WORDS):
        found &= (bits[at + k] & masks[:, k]) == masks[:, k]
    return found
