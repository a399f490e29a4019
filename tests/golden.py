"""Plain loops over the formulas, written without the engine, and a seeded scan to run them on."""

import hashlib
import math

import numpy as np

RAW = "scan_x256_y256.raw"


def make_calibration(pixels, seed=1):
    rng = np.random.default_rng(seed)
    return {
        p: {
            "g1": (1 + rng.random(pixels)).astype("f4"),
            "g2": (0.2 + rng.random(pixels) / 10).astype("f4"),
            "off": (90 + 20 * rng.random(pixels)).astype("f4"),
            "flat": (0.9 + rng.random(pixels) / 5).astype("f4"),
        }
        for p in (0, 1)
    }


def make_words(n_frames, pixels, seed, shift=0):
    rng = np.random.default_rng(seed)
    analog = (300 + shift + rng.normal(0, 8, (n_frames, pixels))).clip(0, 16383).astype("u4")
    digital = rng.integers(0, 40, (n_frames, pixels), dtype="u4")
    gain = (rng.random((n_frames, pixels)) < 0.1).astype("u4")
    unused = rng.integers(0, 2, (n_frames, pixels), dtype="u4")
    return analog | (digital << 14) | (unused << 30) | (gain << 31)


def decode_word(w, g1, g2, off):
    analog, digital, gain = w & 16383, (w & 1073725440) // 16384, (w & 2147483648) // 65536 // 16384 // 2
    return (analog * (1 - gain) + (float(g1) * (analog - float(off))) * gain) + float(g2) * digital


def decode(words, calibration):
    out = np.zeros(words.shape)
    for f in range(len(words)):
        m = calibration[f % 2]
        for i in range(words.shape[1]):
            out[f, i] = decode_word(int(words[f, i]), m["g1"][i], m["g2"][i], m["off"][i])
    return out


def means(frames):
    pairs = len(frames) // 2
    even = frames[0 : 2 * pairs : 2].sum(axis=0) / pairs if pairs else np.full(frames.shape[1], np.nan)
    odd = frames[1 : 2 * pairs : 2].sum(axis=0) / pairs if pairs else np.zeros(frames.shape[1])
    return even, odd


def offset(values):
    edges = [-205 + 10 * i for i in range(43)]
    hist = [0] * 42
    for v in values:
        for i in range(42):
            if edges[i] <= v < edges[i + 1]:
                hist[i] += 1
    arg = hist.index(max(hist))
    if hist[arg] <= 40:
        return hist[arg], arg, 0.0
    part = hist[max(arg - 3, 0) : min(arg + 4, 42)]
    weights = [-3 + i for i in range(len(part))]
    sy = sum(part)
    sxy = sum(w * y for w, y in zip(weights, part))
    sx2y = sum(w * w * y for w, y in zip(weights, part))
    sx2, sx4 = sum(w**2 for w in weights), sum(w**4 for w in weights)
    b, a = sxy / sx2, (7 * sx2y - sx2 * sy) / (7 * sx4 - sx2 * sx2)
    comx = -b / (2 * a) if abs(a) > 0.0001 else 0.0
    value = edges[arg] + 5 + comx * 10
    return hist[arg], arg, 0.0 if abs(value) > 200 or math.isnan(value) else value


def correct(signal, noise, calibration):
    """(float32 frames, [(hist_max, hist_arg, offset)])"""
    frames = decode(signal, calibration)
    mean = means(decode(noise, calibration))
    stats, out = [], np.zeros(frames.shape, "f4")
    for f in range(len(frames)):
        values = frames[f] - mean[f % 2]
        peak, arg, shift = offset(values)
        stats.append((peak, arg + 1, shift))
        values = values - shift
        if f < len(frames) // 2 * 2:
            values = values * calibration[f % 2]["flat"].astype("f8")
        out[f] = values.astype("f4")
    return out, stats


def packet(subdir, chunk_i, total, data, arrival, filename=RAW, experiment="lab", digest=None):
    digest = hashlib.sha512(data).digest() if digest is None else digest
    return (experiment, subdir, filename, "", chunk_i, total, digest, data, arrival)


def operation(subdir, experiment="lab", suffix=".xml"):
    return packet(subdir, 1, 1, b"<x/>", 0, subdir + suffix, experiment)


def scan_packets(subdir, words, sizes, arrival=0, experiment="lab"):
    """Raw packets of chunks with the given frame counts, plus the operation file."""
    rows, at = [], 0
    for i, size in enumerate(sizes, 1):
        rows.append(packet(subdir, i, len(sizes), words[at : at + size].tobytes(), arrival + i, experiment=experiment))
        at += size
    assert at == len(words)
    return [*rows, operation(subdir, experiment)]
