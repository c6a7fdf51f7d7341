"""Signal operators beyond expressions, as Arrow UDFs over numpy: decoding, noise, spectral and loudness work, activity.

Signals are float arrays in -1 to 1; audio files are RIFF bytes. Randomness is seeded by the row's own key.
"""

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims

DECODED = "sample_rate int, channels int, width int, frames long, samples array<float>, error string"


# --- plain numpy ----------------------------------------------------------------------------------------------------------


def decode_wav(content: bytes | None) -> dict:
    """Header and samples (channels averaged) of 8- to 32-bit PCM; an error text instead if it cannot be read."""
    none = {"sample_rate": None, "channels": None, "width": None, "frames": None, "samples": None}
    try:
        with wave.open(io.BytesIO(content or b"")) as w:
            rate, channels, width, frames = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()
            raw = w.readframes(frames)
        if width == 1:
            x = (np.frombuffer(raw, "u1").astype("f4") - 128) / 128
        elif width == 3:
            b = np.frombuffer(raw, "u1").reshape(-1, 3).astype("i4")
            x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype("f4") / (1 << 23)
        else:
            x = np.frombuffer(raw, f"<i{width}").astype("f4") / (1 << (8 * width - 1))
        return {"sample_rate": rate, "channels": channels, "width": width, "frames": frames, "samples": x.reshape(-1, channels).mean(axis=1), "error": None}
    except (wave.Error, EOFError, ValueError) as e:
        return none | {"error": f"audio-read-failed:{e}"}


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(int(rate))
        w.writeframes(np.round(np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def resample(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """Linear resampling behind a moving average where the rate falls."""
    if source == target or not len(x):
        return x
    if target < source:
        k = max(1, round(source / target))
        x = np.convolve(x, np.ones(k) / k, "same")
    n = max(1, round(len(x) * target / source))
    return np.interp(np.arange(n) * source / target, np.arange(len(x)), x)


# Poles and gains of the pink filter, the delayed tap, the direct tap, and the final gain.
PINK_POLES = (0.99886, 0.99332, 0.96900, 0.86650, 0.55000, -0.7616)
PINK_GAINS = (0.0555179, 0.0750759, 0.1538520, 0.3104856, 0.5329522, -0.0168980)
PINK_DELAYED, PINK_DIRECT, PINK_SCALE = 0.115926, 0.5362, 0.11


def one_pole(x: np.ndarray, pole: float, block: int = 256) -> np.ndarray:
    """y[n] = pole y[n - 1] + x[n], blocks at a time: a triangular product inside, one carried value between."""
    rows = np.concatenate([x, np.zeros(-len(x) % block)]).reshape(-1, block)
    powers = pole ** np.arange(block + 1)
    lag = np.arange(block)[:, None] - np.arange(block)[None, :]
    out = rows @ np.where(lag >= 0, powers[np.maximum(lag, 0)], 0.0).T
    carried = 0.0
    for row in out:
        row += powers[1:] * carried
        carried = row[-1]
    return out.ravel()[: len(x)]


def noise(x: np.ndarray, kind: str, level: float, seed: int) -> np.ndarray:
    """x with noise added. white: deviation `level`; pink: a filter bank, peak `level`; brown: a running sum, peak level * samples / 100."""
    white = np.random.default_rng(seed).standard_normal(len(x))
    if kind == "white" or not len(x):
        return x + white * level
    if kind == "brown":
        made, peak = np.cumsum(white), level * len(x) * 0.01
    else:
        made, peak = sum(one_pole(white * g, p) for p, g in zip(PINK_POLES, PINK_GAINS)), level
        made = (made + PINK_DELAYED * np.concatenate([[0.0], white[:-1]]) + PINK_DIRECT * white) * PINK_SCALE
    return x + made * (peak / max(float(np.abs(made).max()), 1e-300))


def reverb(x: np.ndarray, room: float, rate: int) -> np.ndarray:
    """One delayed copy added."""
    d, out = int(rate * 0.1 * room), x.astype("f8").copy()
    if 0 < d < len(x):
        out[d:] += 0.3 * room * x[:-d]
    elif d == 0:
        out *= 1 + 0.3 * room
    return out


def echo(x: np.ndarray, delay: float, decay: float, rate: int) -> np.ndarray:
    """A feedback delay of delay seconds: y[i] = x[i] + decay y[i - d], a block of one delay at a time."""
    d, out = int(rate * delay), x.astype("f8").copy()
    if d < 1:
        raise ValueError("an echo needs a delay of one sample at least")
    for at in range(d, len(out), d):
        out[at : at + d] += decay * out[at - d : at][: len(out[at : at + d])]
    return out


#: Signal functions of the augmentation registry by name: (samples, parameters by name, rate, seed).
AUGMENTERS = {
    "pitch_shift": lambda x, p, rate, seed: pitch_shift(x, p["n_steps"]),
    "time_stretch": lambda x, p, rate, seed: stretch(x, p["rate"]),
    "white_noise": lambda x, p, rate, seed: noise(x, "white", p["level"], seed),
    "brown_noise": lambda x, p, rate, seed: noise(x, "brown", p["level"], seed),
    "pink_noise": lambda x, p, rate, seed: noise(x, "pink", p["level"], seed),
    "reverb": lambda x, p, rate, seed: reverb(x, p["room_size"], rate),
    "echo": lambda x, p, rate, seed: echo(x, p["delay_sec"], p["decay"], rate),
    "gain": lambda x, p, rate, seed: x * p["level"],
}


def ranges_of(kind: str, override: dict[str, tuple[float, float]] | None = None) -> tuple[str, dict[str, tuple[float, float]]]:
    """Function and parameter ranges of a registered augmentation; given ranges replace the registry's own."""
    rows = [r for r in dims.AUGMENTATIONS if r[0] == kind]
    if not rows:
        raise ValueError(f"unknown augmentation {kind}")
    return rows[0][1], {r[2]: (r[3], r[4]) for r in rows} | (override or {})


def derived_ranges(pitch: tuple[float, float] | None = None, speed: tuple[float, float] | None = None, volume: tuple[float, float] | None = None, noise: tuple[float, float] | None = None) -> dict[str, dict[str, tuple[float, float]]]:
    """Ranges of the counterparts from one range each: down is the mirror of up, coloured noise ten times the white."""
    out: dict[str, dict[str, tuple[float, float]]] = {}
    if pitch:
        out |= {"pitch_up": {"n_steps": pitch}, "pitch_down": {"n_steps": (-pitch[1], -pitch[0])}}
    for name, given, key in (("speed", speed, "rate"), ("volume", volume, "level")):
        if given:
            out |= {f"{name}_up": {key: given}, f"{name}_down": {key: (2 - given[1], 2 - given[0])}}
    if noise:
        out |= {"noise_white": {"level": noise}} | {f"noise_{c}": {"level": (10 * noise[0], 10 * noise[1])} for c in ("brown", "pink")}
    return out


def augment(x: np.ndarray, kind: str, rate: int, seed: int, override: dict[str, tuple[float, float]] | None = None) -> np.ndarray:
    """A registered augmentation with parameters drawn from their ranges by the seed, clipped to -1..1."""
    function, ranges = ranges_of(kind, override)
    rng = np.random.default_rng([seed, 1])
    drawn = {k: float(rng.uniform(low, high)) for k, (low, high) in sorted(ranges.items())}
    return np.clip(AUGMENTERS[function](x, drawn, rate, seed), -1.0, 1.0)


def stretch(x: np.ndarray, rate: float, size: int = 512) -> np.ndarray:
    """Phase vocoder: duration over rate, pitch kept."""
    if not len(x):
        return x
    size = min(size, max(16, 1 << (len(x).bit_length() - 2)))
    hop, window = size // 4, np.hanning(size)
    padded = np.concatenate([np.zeros(size // 2), x, np.zeros(size + size // 2)])
    frames = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] * window, axis=1)
    at = np.arange(0, len(frames) - 1, rate)
    low = at.astype(int)
    part = (at - low)[:, None]
    magnitude = (1 - part) * np.abs(frames[low]) + part * np.abs(frames[low + 1])
    expected = 2 * np.pi * hop * np.arange(frames.shape[1]) / size
    step = np.angle(frames[low + 1]) - np.angle(frames[low]) - expected
    step = step - 2 * np.pi * np.round(step / (2 * np.pi)) + expected
    phase = np.angle(frames[0]) + np.concatenate([np.zeros((1, frames.shape[1])), np.cumsum(step[:-1], axis=0)])
    pieces = np.fft.irfft(magnitude * np.exp(1j * phase), size, axis=1) * window
    out, weight = np.zeros(len(pieces) * hop + size), np.zeros(len(pieces) * hop + size)
    for k, piece in enumerate(pieces):
        out[k * hop : k * hop + size] += piece
        weight[k * hop : k * hop + size] += window**2
    out /= np.maximum(weight, 1e-3)
    n = max(1, round(len(x) / rate))
    out = out[size // 2 : size // 2 + n]
    return np.concatenate([out, np.zeros(n - len(out))])


def pitch_shift(x: np.ndarray, steps: float) -> np.ndarray:
    """Semitones up or down, length kept."""
    if not len(x):
        return x
    rate = 2 ** (steps / 12)
    longer = stretch(x, 1 / rate)
    return np.interp(np.linspace(0, len(longer) - 1, len(x)), np.arange(len(longer)), longer)


def trim_silence(x: np.ndarray, rate: int, threshold_db: float = -40.0, least: float = 0.3) -> np.ndarray:
    """Cuts silence off both ends where it lasts `least` seconds or more."""
    loud = np.flatnonzero(np.abs(x) > 10 ** (threshold_db / 20))
    if not len(loud):
        return x[:0]
    n = int(least * rate)
    start = loud[0] if loud[0] >= n else 0
    stop = loud[-1] + 1 if len(x) - loud[-1] - 1 >= n else len(x)
    return x[start:stop]


def _biquad(x: np.ndarray, b: tuple, a: tuple) -> np.ndarray:
    """A second-order filter through its impulse response in the frequency domain."""
    n = 1 << (2 * len(x) + 64).bit_length()
    z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
    return np.fft.irfft(np.fft.rfft(x, n) * ((b[0] + b[1] * z + b[2] * z * z) / (a[0] + a[1] * z + a[2] * z * z)), n)[: len(x)]


def loudness(x: np.ndarray, rate: int) -> float:
    """Gated loudness of a mono signal in LUFS after ITU-R BS.1770; minus infinity for silence."""
    def shelf(f0: float, gain: float, q: float) -> tuple:
        k, v = np.tan(np.pi * f0 / rate), 10 ** (gain / 20)
        m = v**0.4996667741545416
        a0 = 1 + k / q + k * k
        return ((v + m * k / q + k * k) / a0, 2 * (k * k - v) / a0, (v - m * k / q + k * k) / a0), (1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)

    def highpass(f0: float, q: float) -> tuple:
        k = np.tan(np.pi * f0 / rate)
        a0 = 1 + k / q + k * k
        return (1.0, -2.0, 1.0), (1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)

    if not len(x):
        return -np.inf
    y = x
    if rate > 4000:
        y = _biquad(_biquad(x, *shelf(1681.974450955533, 3.999843853973347, 0.7071752369554196)), *highpass(38.13547087602444, 0.5003270373238773))
    size, hop = max(1, int(0.4 * rate)), max(1, int(0.1 * rate))
    blocks = np.lib.stride_tricks.sliding_window_view(y, size)[::hop] if len(y) >= size else y[None, :]
    power = (blocks**2).mean(axis=1)
    with np.errstate(divide="ignore"):
        level = -0.691 + 10 * np.log10(power)
        power = power[level > -70]
        if not len(power):
            return -np.inf
        gate = -0.691 + 10 * np.log10(power.mean()) - 10
        kept = power[-0.691 + 10 * np.log10(power) > gate]
        return float(-0.691 + 10 * np.log10(kept.mean())) if len(kept) else -np.inf


def normalize_loudness(x: np.ndarray, rate: int, target: float = -16.0, peak_db: float = -1.5) -> np.ndarray:
    """One gain to the target loudness, lowered where the peak would pass the ceiling."""
    now = loudness(x, rate)
    if not np.isfinite(now):
        return x
    return x * min(10 ** ((target - now) / 20), 10 ** (peak_db / 20) / max(float(np.abs(x).max()), 1e-12))


def denoise(x: np.ndarray, floor_db: float = -25.0, size: int = 512) -> np.ndarray:
    """Spectral gate: bins near the quietest frames' level are lowered by floor_db."""
    if len(x) < size:
        return x
    hop, window = size // 4, np.hanning(size)
    padded = np.concatenate([np.zeros(size), x, np.zeros(2 * size)])
    frames = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] * window, axis=1)
    magnitude = np.abs(frames)
    frames *= np.where(magnitude > 2 * np.quantile(magnitude, 0.1, axis=0), 1.0, 10 ** (floor_db / 20))
    out, weight = np.zeros(len(frames) * hop + size), np.zeros(len(frames) * hop + size)
    for k, piece in enumerate(np.fft.irfft(frames, size, axis=1) * window):
        out[k * hop : k * hop + size] += piece
        weight[k * hop : k * hop + size] += window**2
    return (out / np.maximum(weight, 1e-3))[size : size + len(x)]


def speech_segments(x: np.ndarray, rate: int, frame: float = 0.03, ratio: float = 0.1, gap: float = 0.3, least: float = 0.1) -> list[dict]:
    """Activity by energy: frames above a share of the loud frames' level, joined over short gaps."""
    n = max(1, int(frame * rate))
    m = -(-len(x) // n)
    if not m:
        return []
    level = np.sqrt((np.concatenate([x, np.zeros(m * n - len(x))]).reshape(m, n) ** 2).mean(axis=1))
    active = np.flatnonzero(level > max(ratio * np.quantile(level, 0.95), 1e-4))
    if not len(active):
        return []
    cuts = np.flatnonzero(np.diff(active) * n > gap * rate) + 1
    parts = [(p[0] * n / rate, min((p[-1] + 1) * n, len(x)) / rate) for p in np.split(active, cuts)]
    return [{"start": float(a), "end": float(b)} for a, b in parts if b - a >= least]


def process(x: np.ndarray, rate: int, target_rate: int | None = None, trim: bool = False, target_lufs: float | None = None, reduce_noise: bool = False, target_seconds: float | None = None) -> tuple[np.ndarray, int]:
    """The cleaning chain in its fixed order; any stage implies one standard rate."""
    if target_rate or trim or target_lufs is not None or reduce_noise or target_seconds:
        x, rate = resample(x, rate, target_rate or 16_000), target_rate or 16_000
    if trim:
        x = trim_silence(x, rate)
    if target_lufs is not None:
        x = normalize_loudness(x, rate, target_lufs)
    if reduce_noise:
        x = denoise(x)
    if target_seconds:
        n = int(target_seconds * rate)
        x = x[:n] if len(x) >= n else np.concatenate([x, np.zeros(n - len(x))])
    return x, rate


# --- Columns ----------------------------------------------------------------------------------------------------------------


def wav_decode(content: Column | str) -> Column:
    def run(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_wav(c) for c in content])

    return F.pandas_udf(run, DECODED)(content)


def wav_encode(samples: Column | str, rate: Column | str) -> Column:
    def run(samples: pd.Series, rate: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else encode_wav(np.asarray(x, "f8"), r) for x, r in zip(samples, rate)])

    return F.pandas_udf(run, "binary")(samples, rate)


def transform(samples: Column, kind: str, *arguments: Column) -> Column:
    """A signal through one of the functions above, by its augmentation name; arguments are columns."""
    made = {
        "noise_white": lambda x, level, seed: noise(x, "white", level, int(seed)),
        "noise_brown": lambda x, level, seed: noise(x, "brown", level, int(seed)),
        "noise_pink": lambda x, level, seed: noise(x, "pink", level, int(seed)),
        "time_stretch": stretch,
        "pitch_shift": pitch_shift,
        "trim": lambda x, rate: trim_silence(x, int(rate)),
        "loudness": lambda x, rate: normalize_loudness(x, int(rate)),
        "denoise": denoise,
        "echo": lambda x, samples, decay: echo(x, 1.0, decay, int(samples)),
        "resample": lambda x, a, b: resample(x, int(a), int(b)),
    }[kind]

    def run(x: pd.Series, *rest: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else made(np.asarray(v, "f8"), *args) for v, *args in zip(x, *rest)])

    return F.pandas_udf(run, "array<double>")(samples, *arguments)


def voice_activity(samples: Column | str, rate: Column | str) -> Column:
    def run(samples: pd.Series, rate: pd.Series) -> pd.Series:
        return pd.Series([[] if x is None else speech_segments(np.asarray(x, "f8"), int(r)) for x, r in zip(samples, rate)])

    return F.pandas_udf(run, "array<struct<start:double,end:double>>")(samples, rate)


def augmented(versions: DataFrame, overrides: dict[str, dict[str, tuple[float, float]]] | None = None) -> DataFrame:
    """Adds audio (WAV bytes) and error to rows of (samples, sample_rate, kind, seed): every version of a file in one pass of Arrow batches."""

    def run(x: pd.Series, rate: pd.Series, kind: pd.Series, seed: pd.Series) -> pd.DataFrame:
        out = []
        for v, r, k, s in zip(x, rate, kind, seed):
            try:
                out.append((encode_wav(augment(np.asarray(v, "f8"), k, int(r), int(s), (overrides or {}).get(k)), int(r)), None))
            except (ValueError, TypeError) as e:
                out.append((None, f"augment-failed:{e}"))
        return pd.DataFrame(out, columns=["audio", "error"])

    made = F.pandas_udf(run, "audio binary, error string")("samples", "sample_rate", "kind", "seed")
    return versions.withColumn("_made", made).select("*", "_made.audio", "_made.error").drop("_made", "samples")


def cleaned(content: Column | str, **stages) -> Column:  # noqa: ANN003
    """The cleaning chain over WAV bytes: (audio, sample_rate, error). Without a stage the bytes pass as they are."""

    def run(content: pd.Series) -> pd.DataFrame:
        out = []
        for c in content:
            w = decode_wav(c)
            if w["error"] or not stages:
                out.append((None if w["error"] else c, w["sample_rate"], w["error"]))
                continue
            x, rate = process(np.asarray(w["samples"], "f8"), w["sample_rate"], **stages)
            out.append((encode_wav(x, rate), rate, None))
        return pd.DataFrame(out, columns=["audio", "sample_rate", "error"])

    return F.pandas_udf(run, "audio binary, sample_rate int, error string")(content)


def chunk_audio(samples: Column | str, rate: Column | str, start: Column | str, end: Column | str, target: int = 16_000) -> Column:
    """WAV bytes of the seconds from start to end, at the target rate, mono."""

    def run(x: pd.Series, rate: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
        cut = (None if v is None else np.asarray(v, "f8")[int(a * r) : int(b * r)] for v, r, a, b in zip(x, rate, start, end))
        return pd.Series([None if v is None else encode_wav(resample(v, int(r), target), target) for v, r in zip(cut, rate)])

    return F.pandas_udf(run, "binary")(samples, rate, start, end)
