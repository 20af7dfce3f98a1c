"""The scoring seam for models that users bring, and scores derived from embeddings and pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.columns import first_message


def score_images(df: DataFrame, make_scorer: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, only_open: bool = True) -> DataFrame:
    """Adds the columns of schema, computed batch by batch by a scorer that each task makes once. With only_open
    rows whose outcome is set are passed over (their scores are null); a UDF under when() would be run on all rows."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    whole = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", " + schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for pdf in batches:
            todo = pdf["outcome"].isna() if only_open and "outcome" in pdf else pd.Series(True, index=pdf.index)
            if todo.any():
                got = scorer(pdf[todo])[names]
                got.index = pdf.index[todo]
                yield pdf.join(got)
            else:
                yield pdf.assign(**dict.fromkeys(names))

    return df.mapInPandas(run, whole)


def prompt_scores(images: DataFrame, prompts: DataFrame, scale: float = 100.0) -> DataFrame:
    """Softmax over one prompt list of scale times the cosine: (id, prompt_idx, grp, score). images (id, embedding),
    prompts (prompt_idx, grp, embedding); the list is short."""
    unit = lambda c: F.transform(c, lambda x: x.cast("double") / F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double"))))
    a = images.select("id", unit(F.col("embedding")).alias("u"))
    b = prompts.select("prompt_idx", "grp", unit(F.col("embedding")).alias("p"))
    dot = F.aggregate(F.zip_with("u", "p", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    raw = a.crossJoin(F.broadcast(b)).select("id", "prompt_idx", "grp", (dot * scale).alias("z"))
    w = Window.partitionBy("id")
    shifted = raw.withColumn("e", F.exp(F.col("z") - F.max("z").over(w)))
    return shifted.select("id", "prompt_idx", "grp", (F.col("e") / F.sum("e").over(w)).alias("score"))


def best_score(scores: DataFrame, name: str) -> DataFrame:
    """G9's input: the best score of a list per image."""
    return scores.groupBy("id").agg(F.max("score").alias(name))


def classify_groups(scores: DataFrame, fallback: str | None = None, least: float = 0.55, least_margin: float = 0.08) -> DataFrame:
    """Summed score per group, the best group with its margin; ties go to the group that sorts last. With fallback,
    an unsure image gets it as its view."""
    sums = scores.groupBy("id", "grp").agg(F.sum("score").alias("s"))
    ranked = sums.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("s", "grp")), asc=False).alias("r"))  # a row a group
    out = ranked.select("id", F.col("r")[0]["grp"].alias("view"), F.col("r")[0]["s"].alias("confidence"), (F.col("r")[0]["s"] - F.coalesce(F.try_element_at("r", F.lit(2))["s"], F.lit(0.0))).alias("margin"))
    if fallback is None:
        return out
    unsure = (F.col("confidence") < least) | (F.col("margin") < least_margin)
    return out.withColumn("view", F.when(unsure, fallback).otherwise(F.col("view")))


def grey(rgb: np.ndarray) -> np.ndarray:
    """Luma of RGB pixels, rounded to whole numbers."""
    return np.rint(rgb[..., 0] * 0.299 + rgb[..., 1] * 0.587 + rgb[..., 2] * 0.114)


def laplacian_variance(g: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian, the border mirrored without its edge."""
    p = np.pad(g.astype("f8"), 1, mode="reflect") if min(g.shape) > 1 else np.pad(g.astype("f8"), 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def _resample(n_in: int, n_out: int, a: float = 3.0) -> np.ndarray:
    """Matrix of Lanczos resampling weights, widened when it shrinks."""
    scale = max(n_in / n_out, 1.0)
    centre = (np.arange(n_out) + 0.5) * n_in / n_out
    x = (np.arange(n_in)[None, :] + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < a, np.sinc(x) * np.sinc(x / a), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resize(img: np.ndarray, height: int, width: int) -> np.ndarray:
    out = np.einsum("ij,jk...->ik...", _resample(img.shape[0], height), img.astype("f8"))
    return np.clip(np.rint(np.einsum("ij,kj...->ki...", _resample(img.shape[1], width), out)), 0, 255)


def phash(g: np.ndarray) -> int:
    """64-bit perceptual hash: 32 x 32 grey pixels, two-dimensional cosine transform, its low 8 x 8 above their median; signed."""
    n = np.arange(32)
    basis = np.cos(np.pi * (2 * n[None, :] + 1) * n[:, None] / 64) * 2
    low = (basis @ resize(g, 32, 32) @ basis.T)[:8, :8]
    bits = (low > np.median(low)).ravel()
    value = int("".join("1" if b else "0" for b in bits), 2)
    return value - (1 << 64) if value >= 1 << 63 else value


def pixel_metrics(images: DataFrame) -> DataFrame:
    """G3's measures and X6 of decoded images (struct image): blur_score, color_diversity, mean_brightness, phash. An image that
    could not be decoded has nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"], strict=True):
                if h is None or h <= 0:
                    out.append((None, None, None, None))
                    continue
                px = np.frombuffer(data, "u1").reshape(h, w, c)
                rgb = np.repeat(px, 3, axis=2) if c == 1 else px[..., 2::-1]
                g = grey(rgb)
                small = resize(rgb, 64, 64).reshape(-1, 3)
                out.append((laplacian_variance(g), len(np.unique(small, axis=0)), float(g.mean()), phash(g)))
            cols = ["blur_score", "color_diversity", "mean_brightness", "phash"]
            yield pdf[["path", "width", "height"]].join(pd.DataFrame(out, columns=cols, index=pdf.index).astype({"color_diversity": "Int64", "phash": "Int64"}))

    flat = images.select(F.col("image.origin").alias("path"), "image.width", "image.height", "image.nChannels", "image.data")
    return flat.mapInPandas(run, "path string, width int, height int, blur_score double, color_diversity long, mean_brightness double, phash long")


def pixel_verdict(metrics: DataFrame, rules: P.PixelRules = P.PixelRules()) -> DataFrame:
    """Action and reason by the first failing check; measures behind the failing check are 0."""
    long_edge, short = F.greatest("width", "height"), F.least("width", "height")
    aspect = F.when(short > 0, long_edge / short).otherwise(999.0)
    reason = first_message(
        (F.coalesce(F.col("width"), F.lit(-1)) < 0, "corrupt_file"), (long_edge < rules.min_long_edge, "low_resolution"), (aspect > rules.max_aspect, "extreme_aspect_ratio"),
        (F.col("blur_score") < rules.min_blur, "excessive_blur"), (F.col("color_diversity") < rules.min_colors, "low_color_diversity"),
        (F.col("mean_brightness") < rules.min_brightness, "too_dark"), (F.col("mean_brightness") > rules.max_brightness, "too_bright"),
    )
    step = F.array_position(F.array(*map(F.lit, ("corrupt_file", "low_resolution", "extreme_aspect_ratio", "excessive_blur", "low_color_diversity"))), reason)
    seen = lambda c, at, zero: F.when((step == 0) | step.isNull() | (step >= at), c).otherwise(F.lit(zero))
    return metrics.select(
        "path", F.coalesce(reason, F.lit("pass")).alias("reason"), F.when(reason.isNull(), "keep").otherwise("discard").alias("action"),
        seen(long_edge, 2, 0).alias("long_edge_px"), seen(aspect, 3, 0.0).alias("aspect_ratio"), seen(F.col("blur_score"), 4, 0.0).alias("blur_score"),
        seen(F.col("color_diversity"), 5, 0).alias("color_diversity"), seen(F.col("mean_brightness"), 6, 0.0).alias("mean_brightness"),
    )
