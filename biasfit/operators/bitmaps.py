"""Key bitmaps: which keys occur in a reference, without moving the rows asked about.

A bitmap has one bit per key value.  Its 64-bit words are built by partial
aggregates (``bit_or`` per word in every task, merged by one small shuffle) and
put together in segments of 64 words; a table of at most ``max_bits`` / 4096
segments, so it may be broadcast whatever the size of the reference.

Integer keys whose range fits ``max_bits`` have a bit of their own: the bitmap
settles every row, both ways, and the rows asked about meet no shuffle.  Keys
of other types or of a wider range share bits by hash: a clear bit still says
that the key is absent, and only rows whose bits are all set go on to the exact
join (:func:`known_keys`).  NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, key_counts, keyed_join
from biasfit.session import materialize

#: 2^27 bits: 16 MB of words, at most 32,768 segments.
MAX_BITS = 1 << 27
SEGMENT_WORDS = 64
_SEGMENT_BITS = 12          # 64 words of 64 bits
_TMP = "__bits_"
INTEGERS = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class Layout:
    """Where a key's bit is: ``low`` is the least key of an exact bitmap, None if hashed."""
    key: str
    low: int | None
    bits: int

    @property
    def exact(self) -> bool:
        return self.low is not None

    def place(self) -> str:
        """The key's bit; NULL has the last one of segment -1."""
        if self.exact:
            # keys beyond the reference's range have no bit
            at = f"CAST(`{self.key}` AS BIGINT)"
            return (f"CASE WHEN `{self.key}` IS NULL THEN -1L WHEN {at} BETWEEN {self.low}L AND {self.low + self.bits - 1}L "
                    f"THEN {at} - {self.low}L ELSE -{1 << 13}L END")
        return f"CASE WHEN `{self.key}` IS NULL THEN -1L ELSE pmod(xxhash64(`{self.key}`), {self.bits}L) END"


def layouts(extents: Mapping[str, tuple], schema, max_bits: int = MAX_BITS) -> dict[str, Layout]:
    """``extents``: least and largest value of each key (None: unknown or no integer)."""
    out = {}
    for k, (lo, hi) in extents.items():
        whole = isinstance(schema[k].dataType, INTEGERS) and lo is not None
        if whole and hi - lo < max_bits:
            out[k] = Layout(k, int(lo), int(hi - lo + 1))
        else:
            out[k] = Layout(k, None, max_bits)
    return out


def key_extents(reference: DataFrame, keys: Sequence[str]) -> dict[str, tuple]:
    """Least and largest value of the integer keys, in one narrow aggregate."""
    whole = [k for k in keys if isinstance(reference.schema[k].dataType, INTEGERS)]
    r = reference.agg(F.count(F.lit(1)), *[f(k) for k in whole for f in (F.min, F.max)]).first()
    return {k: (r[1 + 2 * whole.index(k)], r[2 + 2 * whole.index(k)]) if k in whole else (None, None) for k in keys}


def segments(reference: DataFrame | Mapping[str, DataFrame], layout: Mapping[str, Layout]) -> DataFrame:
    """``_at, _words``: the bitmaps of all keys, one row per non-empty segment;
    segment ``s`` of the i-th of ``n`` keys is at ``s * n + i``."""
    keys = list(layout)
    if isinstance(reference, Mapping):
        parts = [reference[k].select(F.lit(i).alias("_k"), F.expr(layout[k].place()).alias("_p")) for i, k in enumerate(keys)]
        places = parts[0]
        for p in parts[1:]:
            places = places.unionByName(p)
    else:
        places = reference.select(F.expr("stack({}, {}) AS (_k, _p)".format(
            len(keys), ", ".join(f"{i}, {layout[k].place()}" for i, k in enumerate(keys)))))
    words = (places.groupBy("_k", F.shiftright("_p", 6).alias("_w"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(_p & 63 AS INT)))").alias("_bits")))
    each = [F.expr(f"coalesce(bit_or(CASE WHEN (_w & 63) = {i} THEN _bits END), 0L)").alias(f"_w{i}") for i in range(SEGMENT_WORDS)]
    return (words.groupBy((F.shiftright("_w", 6) * len(keys) + F.col("_k")).alias("_at")).agg(*each)
            .select("_at", F.array(*[f"_w{i}" for i in range(SEGMENT_WORDS)]).alias("_words")))


def with_bits(df: DataFrame, table: DataFrame, layout: Mapping[str, Layout], flag: str = "_bit") -> DataFrame:
    """Add ``flag``: the bits of all keys are set.  Broadcast joins of one
    bounded table, the same for each key; no shuffle of ``df``."""
    out = df
    bits = []
    for i, (k, lay) in enumerate(layout.items()):
        p, at, words = (f"{_TMP}{c}{i}" for c in ("place", "at", "words"))
        part = table.select(F.col("_at").alias(at), F.col("_words").alias(words))
        out = out.withColumn(p, F.expr(lay.place()))
        out = out.join(F.broadcast(part), F.shiftright(p, _SEGMENT_BITS) * len(layout) + i == F.col(at), "left")
        bits.append(F.expr(f"coalesce(bit_get(get({words}, CAST(shiftright({p}, 6) & 63 AS INT)), CAST({p} & 63 AS INT)) = 1, false)"))
    cond = bits[0]
    for b in bits[1:]:
        cond = cond & b
    return out.withColumn(flag, cond).drop(*[f"{_TMP}{c}{i}" for i in range(len(layout)) for c in ("place", "at", "words")])


def known_keys(df: DataFrame, reference: DataFrame | Mapping[str, DataFrame], keys: Sequence[str], flag: str = "_known", *,
               total: int | None = None, policy: JoinPolicy = DEFAULT_POLICY, max_bits: int = MAX_BITS,
               written: bool = False, extents: Mapping[str, tuple] | None = None) -> DataFrame:
    """Add boolean ``flag``: every key of the row occurs in ``reference`` (NULL matches NULL).

    ``reference`` is one table, or a table per key.  Planning runs one narrow
    aggregate for the ranges of the keys, unless ``extents`` has them (or wider
    ones); ``written`` writes the bitmaps first, for a result that is evaluated
    more than once."""
    per_key = dict(reference) if isinstance(reference, Mapping) else None
    schema = {k: (reference if per_key is None else per_key[k]).schema for k in keys}
    if extents is None:
        extents = key_extents(reference, keys) if per_key is None else {k: key_extents(per_key[k], [k])[k] for k in keys}
    layout = {k: layouts({k: extents[k]}, schema[k], max_bits)[k] for k in keys}
    table = segments(reference, layout)
    if written:
        table = materialize(table, "table", "bitmaps", lean=True)
    hashed = [k for k in keys if not layout[k].exact]
    out = with_bits(df, table, layout, flag)
    if not hashed:
        return out
    # set bits may be another key's: those rows, and no others, are joined exactly
    maybe = out.where(flag).drop(flag)
    marks: list[Column] = []
    for k in hashed:
        counts = key_counts(reference if per_key is None else per_key[k], k).withColumn(f"_in_{k}", F.lit(True))
        maybe = keyed_join(maybe, counts, k, "left", count_col="_n", total=total, null_safe=True, policy=policy).drop("_n")
        marks.append(F.coalesce(F.col(f"_in_{k}"), F.lit(False)))
    cond = marks[0]
    for m in marks[1:]:
        cond = cond & m
    maybe = maybe.withColumn(flag, cond).drop(*[f"_in_{k}" for k in hashed])
    return out.where(~F.col(flag)).unionByName(maybe)
