"""Signal measures on one recording's samples, for use inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructField, StructType


def mono(samples: np.ndarray) -> np.ndarray:
    return samples if samples.ndim == 1 else samples.mean(axis=1)


def flatness(frames: np.ndarray, eps: float = 1e-10) -> np.ndarray:
    """Geometric over arithmetic mean of each row's windowed magnitude spectrum; 1 for rows too short to tell."""
    frames = np.atleast_2d(frames)
    if frames.shape[1] < 8:
        return np.ones(len(frames))
    magnitude = np.abs(np.fft.rfft(frames * np.hanning(frames.shape[1]), axis=1)) + eps
    return np.exp(np.log(magnitude).mean(axis=1)) / magnitude.mean(axis=1)


def level_db(frames: np.ndarray) -> np.ndarray:
    power = np.square(np.atleast_2d(frames), dtype=np.float64).mean(axis=1)
    return 20 * np.log10(np.maximum(np.sqrt(power + 1e-12), 1e-9))


def frame_levels(samples: np.ndarray, rate: int, frame_ms: float = 25.0, hop_ms: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """Start times and levels of overlapping frames."""
    size, hop = int(rate * frame_ms / 1000), int(rate * hop_ms / 1000)
    n = 1 + (len(samples) - size) // hop if len(samples) >= size else 0
    if n <= 0:
        return np.zeros(0), np.zeros(0)
    total = np.concatenate([[0.0], np.cumsum(np.square(samples, dtype=np.float64))])
    at = np.arange(n) * hop
    power = np.maximum(0, total[at + size] - total[at]) / size
    return at / rate, 20 * np.log10(np.maximum(np.sqrt(power + 1e-12), 1e-9))


def clip_background(samples: np.ndarray, rate: int, frame_ms: float = 32.0) -> tuple[float, float, float]:
    """Speech level (p75), own floor (p10) and mean flatness over frames that don't overlap.

    What is left over after the last whole frame is not heard; a clip shorter than a frame is one, if it has half of one.
    """
    size = max(256, int(rate * frame_ms / 1000))
    n = len(samples) // size
    frames = samples[: n * size].reshape(n, size) if n else samples[None, :]
    if frames.shape[1] < size // 2:
        return -20.0, -60.0, 1.0
    levels = level_db(frames)
    return float(np.percentile(levels, 75)), float(np.percentile(levels, 10)), float(flatness(frames).mean())


def _biquad(b: tuple, a: tuple, x: np.ndarray) -> np.ndarray:
    """A second-order filter, sample by sample in two running states."""
    out = np.empty(len(x))
    s1 = s2 = 0.0
    b0, b1, b2 = (v / a[0] for v in b)
    a1, a2 = a[1] / a[0], a[2] / a[0]
    for k, v in enumerate(x.tolist()):
        y = b0 * v + s1
        s1, s2 = b1 * v - a1 * y + s2, b2 * v - a2 * y
        out[k] = y
    return out


def k_weighted(samples: np.ndarray, rate: int) -> np.ndarray:
    """The two filters of ITU-R BS.1770 (a high shelf, a high pass), designed for the sample rate."""
    gain, q, centre = 3.999843853973347, 0.7071752369554196, 1681.974450955533
    k, vh = np.tan(np.pi * centre / rate), 10 ** (gain / 20)
    vb = vh**0.4996667741545416
    shelf = ((vh + vb * k / q + k * k, 2 * (k * k - vh), vh - vb * k / q + k * k), (1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k))
    q, centre = 0.5003270373238773, 38.13547087602444
    k = np.tan(np.pi * centre / rate)
    high = ((1.0, -2.0, 1.0), (1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k))
    first = _biquad(shelf[0], shelf[1], samples)
    return _biquad(high[0], high[1], first)


def loudness(samples: np.ndarray, rate: int) -> float | None:
    """Integrated loudness of one channel in LUFS: gated blocks of 400 ms, three quarters overlapping.

    None if shorter than a block; -inf for silence.
    """
    size, hop = int(0.4 * rate), int(0.1 * rate)
    if len(samples) < size:
        return None
    y = k_weighted(np.asarray(samples, np.float64), rate)
    total = np.concatenate([[0.0], np.cumsum(y * y)])
    at = np.arange(1 + (len(y) - size) // hop) * hop
    power = (total[at + size] - total[at]) / size
    with np.errstate(divide="ignore"):
        levels = -0.691 + 10 * np.log10(power)
        kept = power[levels >= -70]
        if not len(kept):
            return float("-inf")
        gate = -0.691 + 10 * np.log10(kept.mean()) - 10
        kept = power[(levels > gate) & (levels >= -70)]
        return float(-0.691 + 10 * np.log10(kept.mean())) if len(kept) else float("-inf")


def padded(samples: np.ndarray, rate: int, left: float, right: float) -> np.ndarray:
    return np.concatenate([np.zeros(int(left * rate), samples.dtype), samples, np.zeros(int(right * rate), samples.dtype)])


def tiled(samples: np.ndarray, size: int) -> np.ndarray:
    """Repeated until so long, for models that need a fixed length."""
    return samples if len(samples) >= size or not len(samples) else np.tile(samples, -(-size // len(samples)))


def resampled(samples: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Linear resampling for analysis copies."""
    if rate == wanted or not len(samples):
        return samples
    n = int(len(samples) * wanted / rate)
    return np.interp(np.arange(n) * rate / wanted, np.arange(len(samples)), samples)


def _mel(hz: np.ndarray) -> np.ndarray:
    """Mel scale that is linear below 1000 Hz and logarithmic above."""
    hz = np.asarray(hz, np.float64)
    return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1000) / 1000) / np.log(6.4))


def _hz(mel: np.ndarray) -> np.ndarray:
    return np.where(mel < 15, mel * 200 / 3, 1000 * np.exp(np.log(6.4) * (np.maximum(mel, 15) - 15) / 27))


def fingerprint(samples: np.ndarray, rate: int, wanted: int = 16_000, size: int = 2048, hop: int = 512, bands: int = 128, kept: int = 13) -> np.ndarray:
    """Mean mel-frequency cepstrum of a clip: 13 numbers that say what it sounds like as a whole."""
    x = np.pad(resampled(samples, rate, wanted), size // 2)
    frames = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    edges = _hz(np.linspace(0, _mel(wanted / 2), bands + 2))
    at = np.arange(size // 2 + 1) * wanted / size
    rise, fall = (at - edges[:-2, None]) / np.diff(edges)[:-1, None], (edges[2:, None] - at) / np.diff(edges)[1:, None]
    filters = np.maximum(0, np.minimum(rise, fall)) * (2 / (edges[2:] - edges[:-2]))[:, None]
    level = np.concatenate([10 * np.log10(np.maximum(1e-10, np.abs(np.fft.rfft(frames[k : k + 256] * window, axis=1)) ** 2 @ filters.T)) for k in range(0, len(frames), 256)])
    level = np.maximum(level, level.max() - 80)
    turn = np.cos(np.pi * np.arange(kept)[:, None] * (2 * np.arange(bands) + 1) / (2 * bands)) * np.sqrt(2 / bands)
    turn[0] /= np.sqrt(2)
    return (level @ turn.T).mean(axis=0)


_BACKGROUND = StructType([*(StructField(name, DoubleType()) for name in ("speech_level_dbfs", "clip_floor_dbfs", "flatness")), StructField("empty", BooleanType())])


@pandas_udf(_BACKGROUND)
def background_of(samples: pd.Series, rate: pd.Series) -> pd.DataFrame:
    """Levels and flatness of a clip; null or no samples give the lowest levels and empty = true."""
    silent = (-80.0, -80.0, 1.0, True)
    rows = [(*clip_background(np.asarray(x, np.float64), int(r)), False) if x is not None and len(x) else silent for x, r in zip(samples, rate, strict=True)]
    return pd.DataFrame(rows, columns=[f.name for f in _BACKGROUND.fields])


@pandas_udf(ArrayType(StructType([StructField("t", DoubleType()), StructField("dbfs", DoubleType())])))
def frames_of(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """Start times and levels of a recording's overlapping frames, of 25 ms every 10 ms."""
    return pd.Series([[] if x is None else [{"t": t, "dbfs": v} for t, v in zip(*(a.tolist() for a in frame_levels(np.asarray(x, np.float64), int(r))), strict=True)] for x, r in zip(samples, rate, strict=True)])


@pandas_udf(ArrayType(DoubleType()))
def fingerprint_of(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """Mean of the mel-frequency cepstrum over a clip's frames; null without samples."""
    return pd.Series([None if x is None or not len(x) else fingerprint(np.asarray(x, np.float64), int(r)).tolist() for x, r in zip(samples, rate, strict=True)])


@pandas_udf(DoubleType())
def loudness_of(samples: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else loudness(np.asarray(x, np.float64), int(r)) for x, r in zip(samples, rate, strict=True)], dtype="float64")
