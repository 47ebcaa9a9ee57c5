"""Content hashes: identities that make every step idempotent. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUL = "\x00"


def _u64(text: Column) -> Column:
    """The first 8 bytes of sha-256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def _or_empty(*cs: Column) -> list[Column]:
    return [F.coalesce(c, F.lit("")) for c in cs]


def synth_key(generator: Column, strategy: Column, effort: Column, prompt_id: Column, context: Column, target: Column, replicate: Column | None = None) -> Column:
    """16 hex digits over six parts, each ended by NUL, and the replicate if there is one."""
    base = F.concat(F.concat_ws(_NUL, *_or_empty(generator, strategy, effort, prompt_id, context, target)), F.lit(_NUL))
    if replicate is not None:
        base = F.concat(base, F.when(F.coalesce(replicate, F.lit("")) != "", F.concat(replicate, F.lit(_NUL))).otherwise(F.lit("")))
    return F.substring(F.sha2(base, 256), 1, 16)


def capture_id(source: Column, generator: Column, strategy: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(_NUL, *_or_empty(source, generator, strategy)), 256), 1, 8)


def prompt_id(system: Column) -> Column:
    return F.substring(F.sha2(system, 256), 1, 12)


def role_unit(salt: str, source: Column) -> Column:
    """A number in [0, 1) fixed by salt and source."""
    return _u64(F.concat(F.lit(f"{salt}:"), source)).cast("double") / F.lit(18446744073709551616.0)


def hash_unit(salt: str, source: Column, text: Column) -> Column:
    return _u64(F.concat_ws(_NUL, F.lit(salt), *_or_empty(source, text))).cast("double") / F.lit(18446744073709551616.0)


def arm_index(seed: int, text: Column, arms: int) -> Column:
    return (_u64(F.concat_ws(_NUL, F.lit(str(seed)), *_or_empty(text))) % F.lit(arms)).cast("int")


def dropout_bucket(text: Column) -> Column:
    """The whole 256-bit hash modulo 1000, by Horner's rule on eight 32-bit pieces (2^32 mod 1000 = 296)."""
    h = F.sha2(text, 256)
    piece = lambda i: F.conv(F.substr(h, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(7)), piece), F.lit(0).cast("bigint"), lambda a, x: (a * 296 + x) % 1000).cast("int")


def record_id(synth: Column, capture: Column, chunk_index: Column, source: Column) -> Column:
    """The synthetic key, else capture and chunk, else a hash; missing parts print as None."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    by_capture = F.when(F.coalesce(capture, F.lit("")) != "", F.concat(capture, F.lit(":"), text(chunk_index)))
    return F.coalesce(F.nullif(synth, F.lit("")), by_capture, F.substring(F.sha2(F.concat(text(source), F.lit(_NUL), text(chunk_index)), 256), 1, 16))
