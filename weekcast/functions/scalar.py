"""Scalar helpers: canonical text, hashes, deterministic uniforms, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MIX_MOD = 1000003
_MIX_PRIMES = (7919, 104729, 31, 13, 17)


def canonical_text(c) -> Column:
    """Text of a value with null spelled ``null`` (booleans are already
    ``true``/``false`` when cast)."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def value_hash(c) -> Column:
    """Non-negative Murmur3 hash of a value's canonical text (BIGINT, so the
    absolute value of the smallest INT cannot overflow)."""
    return F.abs(F.hash(canonical_text(c)).cast("bigint"))


def mix_bucket(cols, buckets: int, seed: int = 0) -> Column:
    """Deterministic bucket of non-negative integer key columns.

    Plain modular arithmetic with bounded intermediates, so any SQL engine
    computes the same bucket (used where an oracle must agree) and it does
    not depend on partitioning the way ``rand``/``sample`` do.  ``seed``
    shifts the mix (another seed gives another sample of the same size).
    """
    acc = F.lit(seed % _MIX_MOD).cast("bigint") * F.lit(15485863)
    for c, prime in zip(cols, _MIX_PRIMES):
        acc = acc + (F.col(c).cast("bigint") % _MIX_MOD) * F.lit(prime)
    return acc % F.lit(buckets)


def hash_uniform(cols, seed: int) -> Column:
    """Uniform [0, 1) from the first 52 bits of md5 over the seed and the key
    columns' text: a reproducible ``rand`` that any SQL engine can compute."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def clean_name(c) -> Column:
    """Blanks replaced by ``-`` and lower-cased (file-name safe metric names)."""
    return F.lower(F.regexp_replace(c, " ", "-"))


def run_uri(run_id, leaf) -> Column:
    return F.format_string("runs:/%s/%s", run_id.cast("string"), leaf.cast("string"))
