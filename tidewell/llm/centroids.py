"""Centroid clustering in whole numbers over dictionary-encoded subvectors.

Vectors are gathered into chunks. In a chunk every block of neighbouring dimensions is dictionary-encoded without
loss: its distinct subvectors are kept once, and each vector has their codes. In a round the exact squared distance
of every distinct subvector to every centroid's part is computed once per chunk; a vector's distance is the sum of
its codes' partial distances. Counting codes per cluster gives the sums of the new centroids in the same way. A
block is as wide as its dictionary stays small: `WIDTHS` are tried from the widest.

Chunks are written once to the shared folder; a round reads them and returns at most one row per chunk and cluster,
summed up by Spark. Only the centroids, a number of rows that is a parameter, pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.storage import write_once

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
WIDTHS = (4, 2, 1)
#: A dictionary may have one entry per so many vectors of its chunk; blocks of one dimension may have any number.
VECTORS_PER_ENTRY = 4
CHUNK_ROWS = 65_536
#: Components beyond are taken as this, so that distances and sums fit into 64 bits.
LARGEST = 1 << 24
SLICE = 4096


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """id and values (whole numbers, floor(scale * x)) of the vectors with all components present and finite."""
    vector = F.col(f"`{vector_col}`")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(
        vector, lambda x: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * scale)))
    )
    kept = vectors.filter((F.size(vector) == dimensions) & good)
    return kept.select(F.col(f"`{id_col}`").alias("id"), scaled.cast("array<bigint>").alias("values"))


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `seed:id`; equal ones by their components, those without id last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    first = rows.orderBy(order, "values").limit(clusters).collect()
    return np.array([r["values"] for r in first], np.int64)


def encode_block(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a block of whole numbers, and each row's code."""
    low = block.min(axis=0)
    spans = (block.max(axis=0) - low + 1).tolist()
    if np.prod([float(s) for s in spans]) > 2.0**62:
        return np.unique(block, axis=0, return_inverse=True)
    key = np.zeros(len(block), np.int64)
    for i, span in enumerate(spans):
        key = key * span + (block[:, i] - low[i])
    _, first, codes = np.unique(key, return_index=True, return_inverse=True)
    return block[first], codes


def encode(values: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(first dimension, dictionary, codes) of every block."""
    out, at = [], 0
    while at < values.shape[1]:
        for width in WIDTHS:
            block = values[:, at:at + width]
            entries, codes = encode_block(block)
            if width == 1 or len(entries) * VECTORS_PER_ENTRY <= len(values):
                break
        kind = np.uint8 if len(entries) <= 1 << 8 else np.uint16 if len(entries) <= 1 << 16 else np.uint32
        out.append((at, entries, codes.reshape(-1).astype(kind)))
        at += block.shape[1]
    return out


def distances(blocks: list[tuple[int, np.ndarray, np.ndarray]], centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector to every centroid."""
    total = np.zeros((len(blocks[0][2]), len(centroids)), np.int64)
    for at, entries, codes in blocks:
        apart = entries[:, None, :] - centroids[None, :, at:at + entries.shape[1]]
        table = (apart * apart).sum(axis=2)
        for i in range(0, len(codes), SLICE):
            total[i:i + SLICE] += table[codes[i:i + SLICE]]
    return total


def sums(blocks: list[tuple[int, np.ndarray, np.ndarray]], nearest: np.ndarray, clusters: int) -> np.ndarray:
    """The sum of every cluster's vectors, from the number of times each code occurs in it."""
    parts = []
    for _, entries, codes in blocks:
        n = len(entries)
        counts = np.bincount(nearest * n + codes, minlength=clusters * n).reshape(clusters, n)
        parts.append(counts @ entries)
    return np.concatenate(parts, axis=1)


def _packed(ids: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    blocks = encode(values)
    column = lambda items, kind: pa.array([items], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            column([e.shape[1] for _, e, _ in blocks], pa.int32()),
            column([e.astype("<i8").tobytes() for _, e, _ in blocks], pa.binary()),
            column([c.dtype.itemsize for _, _, c in blocks], pa.int32()),
            column([c.tobytes() for _, _, c in blocks], pa.binary()),
        ],
        names=["ids", "widths", "entries", "code_bytes", "codes"],
    )


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[tuple[int, np.ndarray, np.ndarray]]]]:
    for i in range(batch.num_rows):
        widths, entries, sizes, codes = (batch.column(c)[i].as_py() for c in ("widths", "entries", "code_bytes", "codes"))
        blocks, at = [], 0
        for width, raw, size, code in zip(widths, entries, sizes, codes):
            blocks.append((at, np.frombuffer(raw, "<i8").reshape(-1, width), np.frombuffer(code, f"<u{size}")))
            at += width
        yield batch.column("ids")[i].values, blocks


def chunks(rows: DataFrame, dimensions: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The rows of `whole_vectors` in encoded chunks, one row each; a chunk never spans two tasks."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        values: list[np.ndarray] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column("id"))
            values.append(batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions))
            held += batch.num_rows
            if held >= chunk_rows:
                yield _packed(pa.concat_arrays(ids), np.concatenate(values))
                ids, values, held = [], [], 0
        if held:
            yield _packed(pa.concat_arrays(ids), np.concatenate(values))

    return rows.mapInArrow(
        run, f"ids array<{kind}>, widths array<int>, entries array<binary>, code_bytes array<int>, codes array<binary>"
    )


def moved(coded: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of each cluster's mean; empty clusters stay."""
    clusters, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, blocks in _unpacked(batch):
                nearest = distances(blocks, centroids).argmin(axis=1)
                counts = np.bincount(nearest, minlength=clusters)
                total = sums(blocks, nearest, clusters)
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(there, pa.int32()), pa.array(counts[there], pa.int64()),
                     pa.array(total[there].tolist(), pa.list_(pa.int64()))],
                    names=["cluster", "n", "total"],
                )

    parts = coded.mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    whole = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"d{i}") for i in range(dimensions)]
    )
    after = centroids.copy()
    for row in whole.collect():  # a row per cluster
        after[row["cluster"]] = [row[f"d{i}"] // row["n"] for i in range(dimensions)]
    return after


def assigned(coded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster and distance of every vector."""
    kind = coded.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, blocks in _unpacked(batch):
                far = distances(blocks, centroids)
                nearest = far.argmin(axis=1)
                least = far[np.arange(len(far)), nearest]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(nearest, pa.int32()), pa.array(least, pa.int64())], names=["id", "cluster", "distance"]
                )

    return coded.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """id, cluster and distance of every kept vector, and the centroids (whole numbers, one row each).

    Left out are vectors that are null, of another length, or have a null, NaN or infinite component. Ties go to the
    smaller cluster. With fewer vectors than clusters there are as many clusters as vectors, and an empty table
    gives an empty result. Ids may be null or repeated; every row counts. Other columns are not read.
    """
    rows = write_once(whole_vectors(vectors, id_col, vector_col, dimensions, scale), "vectors")
    centroids = first_centroids(rows, clusters, seed)
    if not len(centroids):
        kind = rows.schema["id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance bigint"), centroids
    coded = write_once(chunks(rows, dimensions, chunk_rows), "vector-chunks")
    for _ in range(rounds):
        centroids = moved(coded, centroids)
    return assigned(coded, centroids), centroids


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **settings) -> DataFrame:
    """As `cluster`, with cluster_inertia, inertia and centroid_sha256 of each row's cluster.

    A sum of distances that does not fit into 64 bits is null.
    """
    found, centroids = cluster(vectors, id_col, vector_col, **settings)
    found = write_once(found, "vector-clusters")
    kind = "decimal(38, 0)"
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast(kind)).cast(kind).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in per}  # a row per cluster
    long = lambda n: n if n < 2**63 else None
    names = [
        (c, long(inertia[c]), long(sum(inertia.values())), ",".join(map(str, row.tolist())))
        for c, row in enumerate(centroids) if c in inertia
    ]
    about = found.sparkSession.createDataFrame(names, "cluster int, cluster_inertia bigint, inertia bigint, centroid string")
    # At most one small row per cluster.
    return found.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("centroid", 256).alias("centroid_sha256"),
    )
