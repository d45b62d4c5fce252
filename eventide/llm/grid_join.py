"""Embedding near-duplicates: the epsilon grid order similarity join.

Vectors of one label are scaled to unit length, where cosine >= c means a
distance of at most eps = sqrt(2 - 2c). They are turned to the leading principal
dimensions of all vectors, cut into grid cells of side eps, and sorted in grid
order (cell by cell, first dimension first). The sorted sequence is cut into
blocks. Intervals of blocks are joined recursively: a pair of intervals is
dropped when the boxes around them lie more than eps apart, otherwise
it is split into pairs of smaller intervals, down to pairs of blocks. Only
these meet, and there every cosine is computed in double precision. A block
pair returns counts of links and a spanning forest of its links, never the
links themselves, so a dense group costs no more rows than it has vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import components, grouped_arrow, map_arrow, stored, table

COSINE = 0.93
LEADING = 8
BLOCK_ROWS = 512
FANOUT = 4


def usable(v: Column) -> Column:
    """A vector that can have a direction: not null or zero, and every
    component a finite number."""
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(v, lambda x: x != 0))


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of an Arrow list column as unit rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """Per dimension count, the ``leading`` principal axes of all unit vectors.
    Tasks return sums and outer products (one row each, dim^2 numbers), which
    are added pairwise in Spark; the driver gets one row per dimension count."""
    def sums(batches):
        total: dict[int, list] = {}
        for b in batches:
            col = b.column(0)
            sizes = np.diff(col.offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                x = unit_rows(col.filter(pa.array(sizes == dim)), dim)
                t = total.setdefault(dim, [0, np.zeros(dim), np.zeros((dim, dim))])
                t[0] += len(x)
                t[1] += x.sum(axis=0)
                t[2] += x.T @ x
        for dim, (n, s, m) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([float(n)]), pa.array([np.concatenate([s, m.ravel()]).tolist()])],
                names=["dim", "n", "m"])

    moments = map_arrow(vectors.select("v"), sums, "dim int, n double, m array<double>")
    added = (moments.select("dim", "n", F.posexplode("m").alias("at", "x")).groupBy("dim", "at")
             .agg(F.sum("n").alias("n"), F.sum("x").alias("x")).groupBy("dim")
             .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "x"))).alias("m")))
    axes = {}
    for row in added.collect():
        m = np.array([e["x"] for e in row["m"]])
        d, n = row["dim"], row["n"]
        mean, second = m[:d] / n, m[d:].reshape(d, d) / n
        _, vec = np.linalg.eigh(second - np.outer(mean, mean))
        axes[d] = np.ascontiguousarray(vec[:, ::-1][:, :leading])
    return axes


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, leading: int = LEADING, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per input row: ``id``, ``n_links`` (other vectors of its label at
    ``cosine`` or more), ``component_id`` (smallest id it reaches over links,
    itself included) and ``kept`` (it is that one).

    Rows with a null label, or a vector that is null, zero or holds a null,
    NaN or infinite component, link with nothing; vectors link only within
    one dimension count. Exact copies count as links of each other, but are joined
    as one vector. Ids are taken as unique; a repeated id gives a row for
    each of its rows, which share the component. Other columns are not read.
    """
    eps = float(np.sqrt(2 - 2 * cosine)) * (1 + 1e-9) + 1e-9
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(label_col).alias("label"))
    good = rows.filter(F.col("label").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))
    # a copy's key: Spark groups arrays by value
    classes = stored(good.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    axes = principal_axes(classes, leading)

    def to_cells(batches):
        for b in batches:
            col = b.column("v")
            sizes = np.diff(col.offsets.to_numpy())
            lead: list = [None] * len(col)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = unit_rows(col.take(pa.array(at)), dim) @ axes[dim]
                for i, p in zip(at.tolist(), x.tolist()):
                    lead[i] = p
            cell = [np.floor(np.array(p) / eps).astype(int).tolist() for p in lead]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(sizes.astype(np.int32)), pa.array(lead, pa.list_(pa.float64())),
                 pa.array(cell, pa.list_(pa.int32()))], names=[*b.schema.names, "dim", "lead", "cell"])

    label_type = rows.schema["label"].dataType.simpleString()
    celled = map_arrow(classes, to_cells, f"label {label_type}, v array<double>, rep long, copies long, dim int, "
                                          "lead array<double>, cell array<int>")
    # grid order over everything: ranges are dealt by (label, dim, cell), each range is cut into blocks
    dealt = stored(celled.repartitionByRange("label", "dim", "cell", "rep")
                   .withColumn("part", F.spark_partition_id()))
    place = Window.partitionBy("part", "label", "dim").orderBy("cell", "rep")
    blocked = dealt.withColumn("cut", F.floor((F.row_number().over(place) - 1) / block_rows).cast("long"))

    def to_block(key, t: pa.Table):
        t = t.combine_chunks()
        lead = np.array(t.column("lead").to_pylist())
        return pa.Table.from_arrays(
            [pa.array([x.as_py()], c.type) for x, c in zip(key, [t.column(k) for k in ("label", "dim", "part", "cut")])]
            + [pa.array([t.column("rep").combine_chunks().to_pylist()], pa.list_(pa.int64())),
               pa.array([t.column("copies").to_pylist()], pa.list_(pa.int64())),
               pa.array([unit_rows(t.column("v").combine_chunks(), key[1].as_py()).tobytes()], pa.binary()),
               pa.array([lead.min(axis=0).tolist()], pa.list_(pa.float64())),
               pa.array([lead.max(axis=0).tolist()], pa.list_(pa.float64()))],
            names=["label", "dim", "part", "cut", "reps", "copies", "units", "lo", "hi"])

    blocks = grouped_arrow(blocked.select("label", "dim", "part", "cut", "rep", "copies", "v", "lead"),
                           ["label", "dim", "part", "cut"], to_block,
                           f"label {label_type}, dim int, part int, cut long, reps array<long>, copies array<long>, "
                           "units binary, lo array<double>, hi array<double>")
    blocks = stored(blocks)
    # number the blocks of a label in grid order; one short row per block
    order = Window.partitionBy("label", "dim").orderBy("part", "cut")
    short = stored(blocks.select("label", "dim", "part", "cut", "lo", "hi")
                   .withColumn("block", (F.row_number().over(order) - 1).cast("long")))
    pairs = _meeting_blocks(short, eps)
    numbered = blocks.join(short.select("label", "dim", "part", "cut", "block"), ["label", "dim", "part", "cut"])
    left = numbered.select("label", "dim", F.col("block").alias("i"), F.col("reps").alias("reps_i"),
                           F.col("copies").alias("copies_i"), F.col("units").alias("units_i"))
    right = numbered.select("label", "dim", F.col("block").alias("j"), F.col("reps").alias("reps_j"),
                            F.col("copies").alias("copies_j"), F.col("units").alias("units_j"))
    met = (pairs.join(left, ["label", "dim", "i"]).join(right, ["label", "dim", "j"])
           .select("dim", (F.col("i") == F.col("j")).alias("same"), "reps_i", "copies_i", "units_i",
                   "reps_j", "copies_j", "units_j"))
    found = stored(map_arrow(met, lambda batches: _links(batches, cosine), "a long, b long, n long"))
    # n > 0: links of a's class; otherwise a link that joins a and b
    counts = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(found.filter("n = 0"), "a", "b")
    per_class = (classes.select("label", "v", "rep", "copies").join(counts, "rep", "left")
                 .join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
                 .select("label", "v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"),
                         F.coalesce("component", "rep").alias("c")))
    out = good.join(per_class, ["label", "v"]).select("id", "n", "c")
    alone = (rows.filter(~(F.col("label").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False))))
             .select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("c")))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_links"),
                                         F.col("c").alias("component_id"), F.col("id").eqNullSafe(F.col("c")).alias("kept"))


def _boxes(short: DataFrame, width: int) -> DataFrame:
    """The box around every interval of ``width`` blocks."""
    corner = (short.select("label", "dim", F.floor(F.col("block") / width).alias("at"),
                           F.posexplode(F.arrays_zip("lo", "hi")).alias("d", "x"))
              .groupBy("label", "dim", "at", "d").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi")))
    return corner.groupBy("label", "dim", "at").agg(
        F.sort_array(F.collect_list(F.struct("d", "lo", "hi"))).alias("box"))


def _meeting_blocks(short: DataFrame, eps: float, fanout: int = FANOUT) -> DataFrame:
    """Pairs of blocks (i <= j) that the recursion can't tell apart: from the
    whole sequence down, a pair of intervals is dropped when the distance between
    their boxes is over ``eps``, else split ``fanout``-fold on either side."""
    most = short.agg(F.max("block")).first()[0]
    width = 1
    while most is not None and width <= most:
        width *= fanout
    pairs = short.select("label", "dim").distinct().select("label", "dim", F.lit(0).cast("long").alias("i"),
                                                           F.lit(0).cast("long").alias("j"))
    gap = F.aggregate(F.zip_with("box_i", "box_j", lambda p, q: F.greatest(
        p["lo"] - q["hi"], q["lo"] - p["hi"], F.lit(0.0))), F.lit(0.0), lambda s, g: s + g * g)
    while width > 1:
        width //= fanout
        boxes = stored(_boxes(short, width))
        step = F.sequence(F.lit(0).cast("long"), F.lit(fanout - 1).cast("long"))
        finer = (pairs.withColumn("a", F.explode(step)).withColumn("b", F.explode(step))
                 .select("label", "dim", (F.col("i") * fanout + F.col("a")).alias("i"),
                         (F.col("j") * fanout + F.col("b")).alias("j")).filter("i <= j"))
        pairs = stored(finer.join(boxes.select("label", "dim", F.col("at").alias("i"), F.col("box").alias("box_i")), ["label", "dim", "i"])
                       .join(boxes.select("label", "dim", F.col("at").alias("j"), F.col("box").alias("box_j")), ["label", "dim", "j"])
                       .filter(gap <= eps * eps).select("label", "dim", "i", "j"))
    return pairs


def _links(batches, cosine: float):
    """Per block pair: rows ``(a, null, n)`` with n > 0, the links of vector a
    found here (a link to a class counts its copies), and rows ``(a, b, 0)`` of
    a spanning forest of the links."""
    for batch in batches:
        for r in batch.to_pylist():
            x = np.frombuffer(r["units_i"]).reshape(-1, r["dim"])
            y = np.frombuffer(r["units_j"]).reshape(-1, r["dim"])
            near = x @ y.T >= cosine
            a, b = np.array(r["reps_i"]), np.array(r["reps_j"])
            if r["same"]:
                np.fill_diagonal(near, False)
            rows: dict = {}
            for who, links in ((a, near @ np.array(r["copies_j"], np.int64)),
                               (b, [] if r["same"] else near.T @ np.array(r["copies_i"], np.int64))):
                for k in np.flatnonzero(links):
                    rows[int(who[k])] = rows.get(int(who[k]), 0) + int(links[k])
            # breadth first over rows and columns: each joins the forest by the first link that reaches it
            forest, left, row_free = [], np.ones(len(b), bool), near.any(axis=1)
            while row_free.any():
                front = [int(np.flatnonzero(row_free)[0])]
                row_free[front[0]] = False
                while front:
                    i = front.pop()
                    for j in np.flatnonzero(near[i] & left).tolist():
                        left[j] = False
                        forest.append((int(a[i]), int(b[j])))
                        nxt = np.flatnonzero(near[:, j] & row_free)
                        row_free[nxt] = False
                        forest += [(int(a[k]), int(b[j])) for k in nxt.tolist()]
                        front += nxt.tolist()
            cols = list(zip(*([(k, None, n) for k, n in rows.items()] + [(p, q, 0) for p, q in forest]))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])


def op7_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id <> q.vec_id
    AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
