"""Embeddings and pixels: normalisation, similarity, histograms, keyframe selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.operators.enrich import built_once


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalise(v: Column) -> Column:
    """Unit vector in double precision; a zero vector gives NaN entries."""
    n = l2_norm(v)
    return F.transform(v, lambda x: F.when(n == 0, F.lit(float("nan"))).otherwise(F.try_divide(x.cast("double"), n)))


def similar_in_shot(features: DataFrame, threshold: float, keys: list[str], at: str = "frame_idx", vector: str = "embedding") -> DataFrame:
    """Pairs (a < b) of a shot's frames whose dot product exceeds the threshold.  Decimate first: a shot then holds under 2 * max frames."""
    one = features.select(*keys, F.col(at).alias("a"), F.col(vector).alias("va"))
    two = features.select(*keys, F.col(at).alias("b"), F.col(vector).alias("vb"))
    return one.join(two, keys).filter("a < b").withColumn("sim", dot(F.col("va"), F.col("vb"))).filter(F.col("sim") > threshold).select(*keys, "a", "b", "sim")


def band_similarity(features: DataFrame, reach: int, key: str, at: str = "frame_idx", vector: str = "embedding") -> DataFrame:
    """Dot products of each frame with those at most `reach` away, as a hash join on blocks of `reach` frames."""
    one = features.select(key, F.col(at).alias("t"), F.col(vector).alias("v"), F.explode(F.array(*[F.floor(F.col(at) / reach) + d for d in (-1, 0, 1)])).alias("block"))
    two = features.select(key, F.col(at).alias("u"), F.col(vector).alias("w"), F.floor(F.col(at) / reach).alias("block"))
    near = one.join(two, [key, "block"]).filter(F.abs(F.col("t") - F.col("u")) <= reach)
    return near.select(key, "t", (F.col("u") - F.col("t")).alias("lag"), dot(F.col("v"), F.col("w")).alias("sim"))


def band_vectors(features: DataFrame, key: str, at: str = "frame_idx", vector: str = "embedding", stride: int = 50, halo: int = 25, reach: int = 50) -> DataFrame:
    """(key, at, band): for each frame its cosines with the frames from reach before to reach behind it, within its window; zero outside.

    A window is a block of `stride` frames with `halo` more on either side; at the ends of a series, whose frames are numbered from
    0 without gaps, the first and the last frame are repeated.  A block is one group and one matrix product: each frame is shuffled to its
    own block and to the neighbours whose halo it is in, and gives one row.  A zero vector has cosine 0 with all.
    """
    spread = F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col(at) - halo) / stride)), F.floor((F.col(at) + halo) / stride)))
    rows = features.select(key, at, vector, spread.alias("_block"))
    kinds = f"{key} {features.schema[key].dataType.simpleString()}, {at} {features.schema[at].dataType.simpleString()}, band array<double>"

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by(at)
        frame, no = group.column(at).to_numpy(), group.column("_block")[0].as_py()
        x = np.array(group.column(vector).to_pylist(), float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        raw = np.arange(no * stride - halo, (no + 1) * stride + halo)
        slot = np.clip(raw, frame[0], frame[-1]) - frame[0]
        x = x[slot]
        own = np.arange(halo, halo + min(stride, max(0, int(frame[-1]) - no * stride + 1)))
        padded = np.pad(x[own] @ x.T, ((0, 0), (reach, reach)))
        band = padded[np.arange(len(own))[:, None], own[:, None] + np.arange(2 * reach + 1)]
        kept = np.searchsorted(frame, raw[own])
        offsets = pa.array(np.arange(len(own) + 1) * (2 * reach + 1), pa.int32())
        return pa.table([group.column(key).take(kept), group.column(at).take(kept), pa.ListArray.from_arrays(offsets, pa.array(band.ravel()))], [key, at, "band"])

    return rows.groupBy(key, "_block").applyInArrow(one, kinds)


def colour_histogram(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Share of each of 512 colour bins of a frame, L2-normalised."""
    bin_of = F.shiftleft(F.shiftright("r", 5), 6) + F.shiftleft(F.shiftright("g", 5), 3) + F.shiftright("b", 5)
    counts = pixels.groupBy(*keys, bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    norm = F.sqrt(F.sum((F.col("n") * F.col("n")).cast("double")).over(Window.partitionBy(*keys)))
    return counts.withColumn("share", F.col("n") / norm)


def spatial_mean(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of each channel of a frame over its cells."""
    return cells.groupBy(*keys, "channel").agg(F.avg("value").alias("mean"))


def mean_vectors(members: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """(keys, mean): the mean vector of each group.  A task sums the vectors of its groups batch by batch; one row a group and batch is shuffled."""
    kinds = ", ".join(f"{k} {members.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            own = pa.table(b).append_column("_i", pa.array(np.arange(b.num_rows))).sort_by([(k, "ascending") for k in keys])
            lists = own.column(vector).combine_chunks()
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)
            new = np.zeros(len(x), bool)
            new[0] = True
            for k in keys:
                code = own.column(k).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
                new[1:] |= code[1:] != code[:-1]
            first = np.flatnonzero(new)
            sums = np.add.reduceat(x, first, axis=0)
            offsets = pa.array(np.arange(len(first) + 1) * x.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*(own.column(k).combine_chunks().take(pa.array(first)) for k in keys), pa.array(np.diff(np.append(first, len(x)))), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], [*keys, "n", "total"])

    parts = members.select(*keys, vector).filter(F.col(vector).isNotNull()).mapInArrow(run, f"{kinds}, n long, total array<double>")
    width = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.collect_list("total").alias("totals"))
    total = F.aggregate(F.slice("totals", 2, F.size("totals")), F.element_at("totals", 1), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    return width.select(*keys, F.transform(total, lambda x: x / F.col("n")).alias("mean"))


def medoids(members: DataFrame, keys: list[str], at: str = "frame_idx", vector: str = "embedding") -> DataFrame:
    """The member nearest its group's mean vector; the first on a tie."""
    apart = F.aggregate(F.zip_with("mean", vector, lambda m, x: (m - x.cast("double")) * (m - x.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return members.join(mean_vectors(members, keys, vector), keys).withColumn("_d", F.round(apart, 9)).groupBy(*keys).agg(F.min(F.struct("_d", at))[at].alias(at))


def greedy_dedup(features: DataFrame, threshold: float, keys: list[str], at: str = "frame_idx", vector: str = "embedding") -> DataFrame:
    """Rows kept by a scan in order that drops a row whose dot product with an earlier kept row exceeds the threshold.

    Rows of a shot come to a task in order and are compared with what it has kept of the shot, a matrix that grows by halves; decimation
    bounds a shot.
    """
    kinds = ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in [*keys, at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, n = None, np.empty((0, 0)), 0
        for b in batches:
            groups, chosen = list(zip(*(b.column(k).to_pylist() for k in keys))), []
            for i, v in enumerate(b.column(len(keys) + 1).to_pylist()):
                x = np.array(v, float)
                if groups[i] != now:
                    now, kept, n = groups[i], np.empty((16, len(x))), 0
                if n and (kept[:n] @ x).max() > threshold:
                    continue
                if n == len(kept):
                    kept = np.concatenate((kept, np.empty((n // 2, len(x)))))
                kept[n] = x
                n += 1
                chosen.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(chosen, pa.int64())) for c in b.columns[: len(keys) + 1]], [*keys, at])

    dealt = features.select(*keys, at, vector).repartition(*keys).sortWithinPartitions(*keys, at)
    return dealt.mapInArrow(run, kinds)


# ---------------------------------------------------------------- k-means with silhouette

def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T))


def kmeans(x: np.ndarray, k: int, seed: int = 42, rounds: int = 100) -> np.ndarray:
    """Labels by Lloyd's rounds from a k-means++ start; deterministic for a seed."""
    r = np.random.default_rng(seed)
    centres = [x[r.integers(len(x))]]
    while len(centres) < k:
        d = (_distances(x, np.array(centres)) ** 2).min(1)
        centres.append(x[r.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[len(centres) % len(x)])
    c = np.array(centres)
    labels = _distances(x, c).argmin(1)
    for _ in range(rounds):
        c = np.array([x[labels == j].mean(0) if (labels == j).any() else c[j] for j in range(k)])
        new = _distances(x, c).argmin(1)
        if (new == labels).all():
            break
        labels = new
    return labels


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Mean Euclidean silhouette; a cluster of one counts 0."""
    d, kinds = _distances(x, x), np.unique(labels)
    means = np.stack([d[:, labels == k].sum(1) for k in kinds], 1)
    sizes = np.array([(labels == k).sum() for k in kinds])
    own = np.searchsorted(kinds, labels)
    rows = np.arange(len(x))
    a = means[rows, own] / np.maximum(1, sizes[own] - 1)
    others = means / sizes
    others[rows, own] = np.inf
    b = others.min(1)
    s = np.where(sizes[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-12), 0.0)
    return float(s.mean())


def best_clusters(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """Labels for the k of 2 to min(int(sqrt(n)), 10) with the best silhouette; the least k on a tie; up to three rows stand alone."""
    n = len(x)
    if n <= 3:
        return np.arange(n)
    best, score = np.zeros(n, int), -np.inf
    for k in range(2, min(int(np.sqrt(n)), 10) + 1):
        labels = kmeans(x, k, seed)
        if len(np.unique(labels)) > 1 and (s := silhouette(x, labels)) > score:
            best, score = labels, s
    return best


def keyframes_of_shots(features: DataFrame, keys: list[str], at: str = "frame_idx", vector: str = "embedding", threshold: float = 0.94, seed: int = 42) -> DataFrame:
    """keys, k_in_shot and at of each shot's keyframes: clusters, their medoids, then greedy de-duplication.

    A shot of up to three frames keeps all of them.  Decimated shots are small, so a group fits in a task.
    """
    kinds = ", ".join(f"{k} {features.schema[k].dataType.simpleString()}" for k in keys)

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(at)
        x = np.stack(frame[vector].to_numpy()).astype(float)
        if len(x) > 3:
            labels = best_clusters(x, seed)
            chosen = []
            for k in np.unique(labels):
                own = np.flatnonzero(labels == k)
                chosen.append(int(own[((x[own] - x[own].mean(0)) ** 2).sum(1).argmin()]))
            kept: list[int] = []
            for i in chosen:
                if not any(x[i] @ x[j] > threshold for j in kept):
                    kept.append(i)
        else:
            kept = list(range(len(x)))
        out = frame.iloc[kept][[*keys, at]].copy()
        out.insert(len(keys), "k_in_shot", range(1, len(out) + 1))
        return out

    return features.select(*keys, at, vector).groupBy(*keys).applyInPandas(pick, f"{kinds}, k_in_shot int, {at} {features.schema[at].dataType.simpleString()}")


def embed(frames: DataFrame, model, batch: int = 16, image: str = "pixels") -> DataFrame:
    """frames with an embedding of `image`: model() is built once in each worker and maps a list of images to vectors."""
    get = built_once(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = get()
        for b in batches:
            made = []
            for i in range(0, len(b), batch):
                made += [np.asarray(v, float).tolist() for v in f(b[image].iloc[i : i + batch].tolist())]
            b["embedding"] = made
            yield b

    return frames.mapInPandas(run, _with_embedding(frames))


def _with_embedding(frames: DataFrame):
    return T.StructType([*frames.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))])
