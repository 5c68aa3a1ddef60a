"""Column functions for matrices (ARRAY<ARRAY<FLOAT>>) and vectors, by higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.functions.scalars import col

FLOOR, RANGE_DB = 1e-10, 80.0


def decibels(matrix, floor: float = FLOOR) -> Column:
    return F.transform(col(matrix), lambda row: F.transform(row, lambda x: F.lit(10.0) * F.log10(F.greatest(x.cast("double"), F.lit(floor)))))


def with_dynamic_range(matrix_db, span: float = RANGE_DB) -> Column:
    """Values clipped at ``span`` below the largest; give it a materialised column."""
    least = F.array_max(F.flatten(col(matrix_db))) - span
    return F.transform(col(matrix_db), lambda row: F.transform(row, lambda x: F.greatest(x, least)))


def has_values(matrix) -> Column:
    """Neither null nor all NaN."""
    return col(matrix).isNotNull() & ~F.forall(F.flatten(col(matrix)), lambda x: F.isnan(x))


def has_nan(matrix) -> Column:
    return F.coalesce(F.exists(F.flatten(col(matrix)), lambda x: F.isnan(x)), F.lit(False))


def half(matrix) -> Column:
    """Values rounded as half-precision floats hold them (11 significant bits, half to even), kept as floats."""
    from pyspark.sql import functions as F_

    def one(x):
        d = x.cast("double")
        size = F_.abs(d)
        step = F_.pow(F_.lit(2.0), F_.greatest(F_.floor(F_.log2(F_.greatest(size, F_.lit(1e-30)))), F_.lit(-14)) - 10)
        value = F_.rint(d / step) * step
        return F_.when(F_.isnan(d) | (size == float("inf")), d).when(F_.abs(value) > 65504.0, F_.signum(d) * float("inf")).otherwise(value).cast("float")

    return F.transform(col(matrix), lambda row: F.transform(row, one))


def every(matrix, step: int = 2) -> Column:
    """Every ``step``-th time frame of each row."""
    return F.transform(col(matrix), lambda row: F.filter(row, lambda _, i: i % step == 0))


def squeezed(matrix) -> Column:
    """Rows of one value as one vector."""
    return F.transform(col(matrix), lambda row: row[0])


def n_frames(matrix) -> Column:
    return F.size(col(matrix)[0])


def transposed(matrix) -> Column:
    wide = F.size(F.element_at(col(matrix), 1))
    return F.transform(F.sequence(F.lit(0), wide - 1), lambda i: F.transform(col(matrix), lambda row: row[i]))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a) -> Column:
    size = norm(a)
    return F.transform(col(a), lambda x: x.cast("double") / size)


def mean_pooled(tokens, mask) -> Column:
    """Mean of the token vectors that the mask keeps."""
    kept = F.filter(F.zip_with(col(tokens), col(mask), lambda t, m: F.when(m > 0, t)), lambda t: t.isNotNull())
    size = F.size(kept[0])
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.aggregate(kept, F.lit(0.0), lambda s, t: s + t[i]) / F.size(kept))


def energy_bounds(samples, share: float = 0.1) -> Column:
    """First and last sample louder than a share of the peak, as start and end; null for silence."""
    loud = F.transform(col(samples), lambda x: F.abs(x))
    peak = F.array_max(loud)
    flags = F.transform(loud, lambda x: x > peak * share)
    start = F.array_position(flags, True) - 1
    end = F.size(flags) - F.array_position(F.reverse(flags), True)
    return F.when(peak > 0, F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))


def trim_decision(length, energy_start, energy_end, voiced_start, voiced_end, *, least_share: float = 0.2, slack: float = 0.5) -> Column:
    """Which bounds to trim a recording to (seconds): voice, else energy, else none; small changes don't count."""

    def usable(a, b):
        return col(a).isNotNull() & col(b).isNotNull() & ((col(b) - col(a)) >= col(length) * least_share)

    voiced, loud = usable(voiced_start, voiced_end), usable(energy_start, energy_end)
    start = F.when(voiced, col(voiced_start)).when(loud, col(energy_start)).otherwise(F.lit(0.0))
    end = F.when(voiced, col(voiced_end)).when(loud, col(energy_end)).otherwise(col(length))
    method = F.when(voiced, "voice").when(loud, "energy").otherwise("none")
    matters = (start > slack) | (end < col(length) - slack)
    return F.struct(
        ((method != "none") & matters).alias("trimmed"),
        start.alias("start"),
        end.alias("end"),
        F.round((F.lit(1.0) - (end - start) / col(length)) * 100, 3).alias("percent"),
        method.alias("method"),
    )
