"""Signal functions over arrays of samples, as higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gain(x: Column, level: Column | float) -> Column:
    return F.transform(x, lambda v: v.cast("double") * level)


def clip(x: Column) -> Column:
    return F.transform(x, lambda v: F.least(F.greatest(v, F.lit(-1.0)), F.lit(1.0)))


def reverb(x: Column, room: float, rate: int) -> Column:
    """One delayed copy added: d = int(rate * 0.1 * room) samples later, at 0.3 * room."""
    d = int(rate * 0.1 * room)
    return F.transform(x, lambda v, i: v.cast("double") + F.when(i >= d, F.get(x, i - d).cast("double") * (0.3 * room)).otherwise(0.0))


def echo(x: Column, delay: int, decay: float) -> Column:
    """Feedback delay in closed form: the sum of decay^k x[i - k delay]."""
    if delay < 1:
        raise ValueError("an echo needs a delay of one sample at least")
    return F.transform(x, lambda v, i: F.aggregate(F.sequence(F.lit(0), F.floor(i / delay).cast("int")), F.lit(0.0), lambda a, k: a + F.pow(F.lit(decay), k) * F.get(x, i - k * delay).cast("double")))


def fit_length(x: Column, n: int) -> Column:
    return F.when(F.size(x) >= n, F.slice(x, 1, n)).otherwise(F.concat(x, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(n) - F.size(x), F.lit(0)))))


def segment(x: Column, start: Column, end: Column, rate: int) -> Column:
    a = F.floor(start * rate).cast("int")
    return F.slice(x, a + 1, F.greatest(F.floor(end * rate).cast("int") - a, F.lit(0)))


def downmix(channels: list[Column]) -> Column:
    """Mean over channels of equal length."""
    out = F.transform(channels[0], lambda v: v.cast("double"))
    for c in channels[1:]:
        out = F.zip_with(out, c, lambda a, b: a + b.cast("double"))
    return F.transform(out, lambda v: v / len(channels))


def float_stats(x: Column, rate: int) -> Column:
    """peak, rms, clip_ratio, duration of a float signal; zeros if empty."""
    n = F.size(x)
    power = F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    share = F.size(F.filter(x, lambda v: F.abs(v.cast("double")) >= 0.999)) / n
    zero = F.lit(0.0)
    return F.struct(
        F.when(n > 0, F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))).otherwise(zero).alias("peak"),
        F.when(n > 0, F.sqrt(power / n)).otherwise(zero).alias("rms"),
        F.when(n > 0, share).otherwise(zero).alias("clip_ratio"),
        (n / F.lit(float(rate))).alias("duration"),
    )


def pcm_stats(x: Column, width: int = 2) -> Column:
    """rms (rounded down), peak, clip_ratio of integer samples."""
    top = 0.999 * (2 ** (8 * width - 1) - 1)
    n = F.size(x)
    power = F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return F.struct(F.floor(F.sqrt(power / n)).alias("rms"), F.array_max(F.transform(x, lambda v: F.abs(v))).alias("peak"), F.round(F.size(F.filter(x, lambda v: F.abs(v) >= top)) / n, 6).alias("clip_ratio"))
