"""Skeletons: tracing within cells, merging fragments, lengths, smoothing, export."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.operators.ccl import contract
from stratavox.operators.select import AXES, cell
from stratavox.sources.shared import drop, materialise

TRACED = "label long, cx long, cy long, cz long, x long, y long, z long, px long, py long, pz long, radius double"
STEPS = np.array([(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) != (0, 0, 0)])


#: The most voxels in a cell that forge() takes: a group's arrays are in proportion to it.
MOST = 1 << 24

#: Edges of a label that one task takes as a whole; a larger label's edges go by cells of so many voxels first.
EDGES, CELL = 1 << 18, 64


class _Body:
    """Voxels of one label in one cell on a dense grid of their box, with a border of one voxel.

    bits, if given, has a bit for each of STEPS that a path may take from a voxel.
    """

    def __init__(self, points: np.ndarray, bits: np.ndarray | None = None):
        self.bits = bits
        self.low = points.min(axis=0) - 1
        self.shape = points.max(axis=0) - self.low + 2
        strides = np.array([1, self.shape[0], self.shape[0] * self.shape[1]])
        self.code = (points - self.low) @ strides
        self.at = np.full(int(self.shape.prod()), -1, np.int32)
        self.at[self.code] = np.arange(len(points), dtype=np.int32)
        self.steps = STEPS @ strides
        self.points = points

    def near(self, rows: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """For each of the rows those of its neighbours at these steps, or -1."""
        return self.at[self.code[rows][:, None] + steps]

    def onward(self, rows: np.ndarray) -> np.ndarray:
        """For each of the rows those of the neighbours that its bits lead to, or -1."""
        there = self.near(rows, self.steps)
        if self.bits is None:
            return there
        return np.where(self.bits[rows][:, None] >> np.arange(len(STEPS)) & 1, there, -1)

    def rows(self, points: np.ndarray) -> np.ndarray:
        """The rows of those of the points that are voxels of the label."""
        off = points - self.low
        inside = ((off >= 0) & (off < self.shape)).all(axis=1)
        found = self.at[off[inside] @ np.array([1, self.shape[0], self.shape[0] * self.shape[1]])]
        return found[found >= 0]

    def border(self) -> np.ndarray:
        """Rows with a face that no other voxel of the label shares."""
        flat = self.steps[np.abs(STEPS).sum(axis=1) == 1]
        bare = np.zeros(len(self.code), bool)
        for s in flat:
            bare |= self.at[self.code + s] < 0
        return np.flatnonzero(bare)

    def distances(self, start: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least path costs from the start rows, and the row before each; a step costs its length times its end's cost, of 1 at least.

        A step adds 1 at least, so all open rows less than 1 above the nearest are settled; they are expanded together.
        """
        far, before = np.full(len(self.code), np.inf), np.full(len(self.code), -1, np.int32)
        far[start] = 0
        length = np.sqrt((STEPS**2).sum(axis=1))
        waiting = start
        while len(waiting):
            ready = far[waiting] < far[waiting].min() + 1
            now, waiting = waiting[ready], waiting[~ready]
            there = self.onward(now)
            offer = far[now][:, None] + length[None, :] * cost[there]
            source = np.broadcast_to(now[:, None], there.shape)
            better = (there >= 0) & (offer < far[there] - 1e-9)
            there, offer, source = there[better], offer[better], source[better]
            np.minimum.at(far, there, offer)
            best = offer <= far[there]
            before[there[best]] = source[best]
            waiting = np.unique(np.concatenate([waiting, there]))
        return far, before

    def clear(self, open_: np.ndarray, row: int, reach: float) -> None:
        """Close the open rows whose coordinates are all within reach of those of a row."""
        middle = self.points[row] - self.low
        least = np.maximum(np.ceil(middle - reach), 0).astype(int)
        most = np.minimum(np.floor(middle + reach) + 1, self.shape).astype(int)
        box = self.at.reshape(self.shape[::-1])[least[2] : most[2], least[1] : most[1], least[0] : most[0]]
        open_[box[box >= 0]] = False


def step_bits(points: np.ndarray, node: np.ndarray, chunk: tuple[int, int, int]) -> np.ndarray:
    """A bit for each of STEPS that leads from a voxel (of one label) to one of its own node, or, from the sides of chunks, to any.

    Within a chunk parts of a label that merely touch are different nodes. Nodes of different chunks never are the same, so
    there the label itself, the root of both, says what belongs together.
    """
    body = _Body(points)
    side = ((points % chunk == 0) | (points % chunk == np.array(chunk) - 1)).any(axis=1)
    there = body.near(np.arange(len(points)), body.steps)
    open_ = (there >= 0) & (side[:, None] | (node[there] == node[:, None]))
    return (open_.astype(np.int64) << np.arange(len(STEPS))).sum(axis=1)


def graph_bits(vol: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """x, y, z and bits of every voxel (label, node, x, y, z), as step_bits() tells them: see STEPS for the order of bits.

    A group is a chunk with one voxel of its neighbours around it; only voxels on sides are sent more than once.
    """
    out = vol.select("label", "node", *AXES, *[F.floor(F.col(a) / s).cast("long").alias(f"c{a}") for a, s in zip(AXES, chunk, strict=True)], F.lit(True).alias("own"))
    for a, s in zip(AXES, chunk, strict=True):
        low, high = F.pmod(F.col(a), F.lit(s)) == 0, F.pmod(F.col(a), F.lit(s)) == s - 1
        away = F.concat(F.array(F.lit(0)), F.when(low, F.array(F.lit(-1))).otherwise(F.array().cast("array<int>")), F.when(high, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
        out = out.withColumn("_d", F.explode(away)).withColumn(f"c{a}", F.col(f"c{a}") + F.col("_d")).withColumn("own", F.col("own") & (F.col("_d") == 0)).drop("_d")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, g in group.groupby("label"):
            g = g.drop_duplicates(list(AXES))
            points = g[list(AXES)].to_numpy()
            parts.append(g.assign(bits=step_bits(points, g["node"].to_numpy(), chunk))[g["own"]])
        return pd.concat(parts)[[*AXES, "bits"]]

    return out.groupBy("cx", "cy", "cz").applyInPandas(one, "x long, y long, z long, bits long")


def trace(group: pd.DataFrame, scale: float = 4.0, const: float = 2.0, chunk: tuple[int, int, int] | None = None, soma: float | None = None, soma_scale: float = 1.0, soma_const: float = 2.0) -> pd.DataFrame:
    """TEASAR of one label in one cell: paths to the farthest points along the middle, clearing a ball around each path.

    Every traced voxel comes with the one before it (itself at a root) and its distance to the border. Voxels are taken
    in the order of z, y, x, so reruns agree; repeated ones count once. Memory is 4 bytes for each voxel of the label's
    box and some 200 for each of its own; each voxel is expanded once a path search. Rows with a true `target`, if there
    is such a column, name voxels that get a path in any case; they add no voxels. With the size of a graph volume's chunks
    and a column node, paths take only steps that step_bits() allows, so parts of a label that merely touch stay apart;
    the voxel before another is then the next one on its way to the root.

    A label that somewhere is `soma` or more from its border has a cell body: paths of the piece that holds it start from the
    one voxel farthest from the border, the first of several, and voxels within soma_scale times that distance plus soma_const
    of it get no path of their own and clear none. So a body adds no branches, and each arm is one from its middle.
    """
    wanted = group["target"].to_numpy(bool) if "target" in group else np.zeros(len(group), bool)
    points = np.unique(group.loc[~wanted, ["z", "y", "x"]].to_numpy(), axis=0)[:, ::-1]
    bits = None
    if chunk is not None:
        names = group.loc[~wanted].drop_duplicates(["z", "y", "x"]).sort_values(["z", "y", "x"])["node"].to_numpy()
        bits = step_bits(points, names, chunk)
    body, one = _Body(points, bits), np.ones(len(points))
    targets = body.rows(np.unique(group.loc[wanted, ["z", "y", "x"]].to_numpy(), axis=0)[:, ::-1])
    radius = _Body(points).distances(body.border(), one)[0] + 1  # the shape's, whatever joins it
    penalty = 1 + 100 * (1 - radius / radius.max()) ** 4
    left, rows = np.ones(len(points), bool), {}
    while left.any():
        reach, _ = body.distances(np.array([int(left.argmax())]), one)
        found = np.isfinite(reach)
        root = int(np.where(found, reach, -1).argmax())
        middle = int(radius.argmax())
        body_here = soma is not None and radius[middle] >= soma and found[middle]
        root = middle if body_here else root
        plain, _ = body.distances(np.array([root]), one)
        _, before = body.distances(np.array([root]), penalty)
        rows[root] = root
        open_ = found & left
        outside = np.ones(len(points), bool)
        if body_here:
            outside = ((points - points[middle]) ** 2).sum(axis=1) > (soma_scale * radius[middle] + soma_const) ** 2
            open_ &= outside
        farthest = np.flatnonzero(found)
        for at in farthest[np.argsort(-plain[farthest], kind="stable")].tolist():
            if not open_[at]:
                continue
            path = [at]
            while at not in rows:
                rows[at] = int(before[at])
                at = rows[at]
                path.append(at)
            for p in path:
                if outside[p]:
                    body.clear(open_, p, scale * radius[p] + const)
        for at in targets[found[targets]].tolist():
            while at not in rows:
                rows[at] = int(before[at])
                at = rows[at]
        left &= ~found
    at, to = np.array(list(rows)), np.array(list(rows.values()))
    out = pd.DataFrame({c: group[c].iloc[0] for c in ("label", "cx", "cy", "cz")}, index=range(len(at)))
    for k, a in enumerate(AXES):
        out[a], out[f"p{a}"] = points[at, k], points[to, k]
    out["radius"] = radius[at]
    return out[[x.split()[0] for x in TRACED.split(", ")]]


def forge(vol: DataFrame, size: tuple[int, int, int], dust: int = 0, targets: DataFrame | None = None, chunk: tuple[int, int, int] | None = None, soma: float | None = None) -> DataFrame:
    """Traced voxels of each label in each cell; cells overlap by one voxel, so that fragments meet.

    A group is one label in one cell, which the cell's size bounds; cells of more than MOST voxels are an error. Targets
    (label, x, y, z), such as nearest_voxels() gives, get a path each; those that are no voxels of their label don't count.
    For a graph volume, chunk is the size of its chunks and a column node has the voxels' nodes at layer 2; soma is the distance from its border that tells a cell body: see trace().
    """
    if (size[0] + 1) * (size[1] + 1) * (size[2] + 1) > MOST:
        raise ValueError(f"a cell has at most {MOST} voxels; take smaller ones, fragments meet when merged")
    low = [F.when((F.col(a) % s == 0) & (F.col(a) > 0), F.array(F.lit(0), F.lit(-1))).otherwise(F.array(F.lit(0))) for a, s in zip(AXES, size, strict=True)]
    node = ["node"] if chunk is not None else []
    marked = vol.select("label", *AXES, *node, F.lit(False).alias("target"))
    if targets is not None:
        marked = marked.unionByName(targets.select("label", *AXES, F.lit(True).alias("target")).distinct(), allowMissingColumns=True)
    sent = marked.withColumn("_i", F.explode(low[0])).withColumn("_j", F.explode(low[1])).withColumn("_k", F.explode(low[2]))
    own = cell(size)
    keyed = sent.select("label", *[(own[f"c{a}"] + F.col(k)).alias(f"c{a}") for a, k in zip(AXES, ("_i", "_j", "_k"), strict=True)], *AXES, *node, "target")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        return trace(group, chunk=chunk, soma=soma) if (~group["target"]).sum() >= max(dust, 1) else pd.DataFrame(columns=[x.split()[0] for x in TRACED.split(", ")])

    return keyed.groupBy("label", "cx", "cy", "cz").applyInPandas(one, TRACED)


def nearest_voxels(points: DataFrame, vol: DataFrame, radius: int) -> DataFrame:
    """For each point (label, x, y, z, kind) at most radius away from its label: the nearest voxel, the first by (z, y, x) of equal ones.

    Both meet in cells as wide as the radius, on the label and the cell; further columns of the points are left out. A place
    goes to 27 cells once, whatever kinds it has, and only if its label has voxels. Spark's size estimate knows nothing of
    the 27, so the join is told to sort: neither side is ever sent to the driver.
    """
    keyed = vol.select("label", *[F.col(a).alias(f"v{a}") for a in AXES], *[F.floor(F.col(a) / radius).alias(f"c{a}") for a in AXES])
    places = points.groupBy("label", *AXES).agg(F.collect_set(F.struct("kind")).alias("kinds"))
    spread = places.join(vol.select("label").distinct().hint("merge"), "label", "left_semi")
    for a in AXES:
        spread = spread.withColumn("_d", F.explode(F.sequence(F.lit(-1), F.lit(1)))).withColumn(f"c{a}", F.floor(F.col(a) / radius) + F.col("_d"))
    far = sum((F.col(f"v{a}") - F.col(a)) * (F.col(f"v{a}") - F.col(a)) for a in AXES)
    met = spread.drop("_d", "kinds").hint("merge").join(keyed, ["label", "cx", "cy", "cz"]).withColumn("_far", far).filter(F.col("_far") <= radius * radius)
    best = met.groupBy("label", *AXES).agg(F.min(F.struct("_far", "vz", "vy", "vx")).alias("b"))
    found = best.join(places.hint("merge"), ["label", *AXES]).select("label", F.col("b"), F.explode("kinds").alias("k"))
    return found.select("label", *[F.col(f"b.v{a}").alias(a) for a in AXES], "k.kind")


def typed(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Nodes with the kind of the target at their place, the least of several, 0 elsewhere."""
    kinds = targets.groupBy("label", *AXES).agg(F.min("kind").alias("kind"))
    return nodes.join(kinds, ["label", *AXES], "left").withColumn("kind", F.coalesce("kind", F.lit(0)))


def merge(traced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (label, x, y, z, radius) and edges of each label over all cells: equal vertices are one, equal edges too."""
    nodes = traced.groupBy("label", *AXES).agg(F.max("radius").alias("radius"))
    here, there = F.struct(*AXES), F.struct(*[F.col(f"p{a}").alias(a) for a in AXES])
    edges = traced.filter(here != there).select("label", F.least(here, there).alias("a"), F.greatest(here, there).alias("b")).distinct()
    return nodes, edges


def linked_nodes(traced: DataFrame) -> DataFrame:
    """The nodes of merge(), and whether an edge ends there."""
    moved = F.struct(*AXES) != F.struct(*[F.col(f"p{a}").alias(a) for a in AXES])
    own = F.struct(*AXES, "radius", F.lit(True).alias("own"), moved.alias("linked"))
    before = F.struct(*[F.col(f"p{a}").alias(a) for a in AXES], F.lit(None).cast("double").alias("radius"), F.lit(False).alias("own"), moved.alias("linked"))
    both = traced.select("label", F.explode(F.when(moved, F.array(own, before)).otherwise(F.array(own))).alias("n")).select("label", "n.*")
    return both.groupBy("label", *AXES).agg(F.max("radius").alias("radius"), F.max("own").alias("own"), F.max("linked").alias("linked")).filter("own").drop("own")


def cable_length(edges: DataFrame, resolution: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """The summed length of each label's edges."""
    square = sum((((F.col(f"a.{a}") - F.col(f"b.{a}")) * r) ** 2) for a, r in zip(AXES, resolution, strict=True))
    return edges.groupBy("label").agg(F.count("*").alias("edges"), F.sum(F.sqrt(square)).alias("length"))


def drop_short(nodes: DataFrame, edges: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Skeletons whose cable is at least so long."""
    keep = cable_length(edges).filter(F.col("length") >= least).select("label")
    return nodes.join(keep, "label", "left_semi"), edges.join(keep, "label", "left_semi")


def smoothed(paths: DataFrame, width: int = 3) -> DataFrame:
    """Directions along a path (label, step, x, y, z), each the mean of those of the nearest steps: normals of sections."""
    order = Window.partitionBy("label").orderBy("step")
    turned = paths.withColumns({f"d{a}": F.lead(a).over(order) - F.col(a) for a in AXES})
    around = order.rowsBetween(-(width // 2), width // 2)
    return turned.withColumns({f"n{a}": F.avg(f"d{a}").over(around) for a in AXES}).select("label", "step", *[f"n{a}" for a in AXES])


def without_ticks(edges: DataFrame, least: float, resolution: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """edges (label, a, b) without side branches shorter than `least`: paths from a tip to the first node of three edges or more.

    What lies between branching nodes are the components of the other nodes; each is measured by one grouping. Nodes
    go by a 64-bit hash. Paths without a branching node stay, and what becomes a tip by this is left for another call.
    """
    square = sum((((F.col(f"a.{x}") - F.col(f"b.{x}")) * r) ** 2) for x, r in zip(AXES, resolution, strict=True))
    each = edges.select("label", "a", "b", F.xxhash64("label", "a").alias("ia"), F.xxhash64("label", "b").alias("ib"), F.sqrt(square).alias("length"))
    degree = each.select(F.explode(F.array("ia", "ib")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    side = lambda x: degree.select(F.col("node").alias(f"i{x}"), F.col("degree").alias(f"d{x}"))
    both = materialise(each.join(side("a"), "ia").join(side("b"), "ib"), "ticks-edges")
    roots = contract(both.filter("da <= 2 and db <= 2").select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    inner = F.when(F.col("da") <= 2, F.col("ia")).when(F.col("db") <= 2, F.col("ib"))
    placed = both.withColumn("node", inner).join(roots, "node", "left").withColumn("part", F.coalesce("root", "node"))
    ends = F.sum(F.col("da").eqNullSafe(1).cast("int") + F.col("db").eqNullSafe(1).cast("int")).alias("tips")
    meets = F.sum((F.col("da") > 2).cast("int") + (F.col("db") > 2).cast("int")).alias("meets")
    short = placed.filter("part is not null").groupBy("part").agg(F.sum("length").alias("all"), ends, meets).filter((F.col("tips") == 1) & (F.col("meets") == 1) & (F.col("all") < least))
    return placed.join(short.select("part"), "part", "left_anti").select("label", "a", "b")


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over edges p, q in the order of label, part and length: those that join two pieces of what came before (Kruskal)."""
    last, up = None, {}

    def root(v: int) -> int:
        while (above := up.get(v, v)) != v:
            up[v] = v = up.get(above, above)
        return v

    for batch in batches:
        keep = []
        for label, part, p, q in zip(*(batch.column(c).to_pylist() for c in ("label", "part", "p", "q")), strict=True):
            if (label, part) != last:
                last, up = (label, part), {}
            p, q = root(p), root(q)
            up[p] = q
            keep.append(p != q)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["label", "part", "a", "b"])


def without_loops(edges: DataFrame, resolution: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """edges (label, a, b) of the shortest forest with the same pieces: each loop is cut at its longest edge, of equal ones at the last by (a, b).

    A label of up to EDGES edges is sorted by length and done in one pass of a task; one shuffle deals all labels to tasks. A
    larger one is dealt by cells, which cuts the loops within each; what is left of it goes through Boruvka's rounds: every
    piece picks its shortest edge outwards, what is picked is contracted, and of edges between the same two pieces the shortest
    stays. Pieces at least halve each round, and the edges left get fewer. Repeated edges count once; edges from a node to
    itself go. Nodes go by a 64-bit hash. A task holds the nodes of one label's part; labels beyond EDGES are broadcast.
    """
    square = sum((((F.col(f"a.{x}") - F.col(f"b.{x}")) * r) ** 2) for x, r in zip(AXES, resolution, strict=True))
    each = edges.select("label", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
    ends = {"p": F.xxhash64("label", "a"), "q": F.xxhash64("label", "b"), "length": F.sqrt(square)}
    large = each.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > EDGES)
    place = F.pmod(F.xxhash64(*[F.floor(F.col(f"a.{x}") / CELL) for x in AXES]), 4 * F.ceil(F.col("n") / EDGES))
    dealt = each.join(F.broadcast(large), "label", "left").select("label", F.coalesce(place + 1, F.lit(0)).cast("bigint").alias("part"), "a", "b").repartition("label", "part")
    schema = dealt.schema
    thin = materialise(dealt.withColumns(ends).sortWithinPartitions("label", "part", "length", "a", "b").mapInArrow(_joining, schema), "loops-thin")
    kept, open_ = thin.filter("part = 0").select("label", "a", "b"), thin.filter("part > 0")
    if open_.isEmpty():
        return kept
    each = open_.withColumns(ends).select("p", "q", F.struct("length", "label", "a", "b").alias("e"))
    shortest = lambda df: df.groupBy(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).agg(F.min("e").alias("e"))
    left = materialise(shortest(each), "loops-left")
    while not left.isEmpty():
        ends = left.select(F.explode(F.array("p", "q")).alias("piece"), F.struct("e", "p", "q").alias("s"))
        picked = materialise(ends.groupBy("piece").agg(F.min("s").alias("s")).select("s.*").distinct(), "loops-picked")
        kept = kept.unionByName(picked.select("e.label", "e.a", "e.b"))
        roots = materialise(contract(picked.select(F.col("p").alias("a"), F.col("q").alias("b"))), "loops-roots")
        for end in "pq":
            left = left.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}")), end)
        left = materialise(shortest(left.filter("rp != rq").select(F.col("rp").alias("p"), F.col("rq").alias("q"), "e")), "loops-left")
        drop(roots)
    return kept


def swc_lines(nodes: DataFrame) -> DataFrame:
    """SWC lines (id, type, x, y, z, radius, parent) of nodes with columns label, node, x, y, z, radius, parent."""
    return nodes.select("label", "node", F.concat_ws(" ", F.col("node").cast("string"), F.lit("0"), *[F.col(a).cast("string") for a in AXES], F.col("radius").cast("string"), F.col("parent").cast("string")).alias("line"))


def box_contacts(vol: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """For each label and cell a bit for each side of the cell that it touches: -x, +x, -y, +y, -z, +z."""
    own = cell(size)
    bits = F.lit(0)
    for i, (a, s) in enumerate(zip(AXES, size, strict=True)):
        bits = bits + F.when(F.col(a) % s == 0, 1 << 2 * i).otherwise(0) + F.when(F.col(a) % s == s - 1, 2 << 2 * i).otherwise(0)
    return vol.groupBy("label", *[c.alias(n) for n, c in own.items()]).agg(F.bit_or(bits).cast("bigint").alias("sides"))


def connectivity_graph(vol: DataFrame) -> DataFrame:
    """For each voxel a bit for each of 13 later neighbours (of 26) that has its label."""
    half = [tuple(map(int, s)) for s in STEPS if tuple(s[::-1]) > (0, 0, 0)]
    each = F.array(*[F.struct(F.lit(i).alias("bit"), *[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, s, strict=True)]) for i, s in enumerate(half)])
    out = vol.select("label", *[F.col(a).alias(f"_{a}") for a in AXES], F.explode(each).alias("s"))
    there = out.select("label", "_x", "_y", "_z", "s.bit", *[(F.col(f"_{a}") + F.col(f"s.d{a}")).alias(a) for a in AXES])
    met = there.join(vol.select("label", *AXES), ["label", *AXES])
    return met.groupBy(F.col("_x").alias("x"), F.col("_y").alias("y"), F.col("_z").alias("z")).agg(F.sum(F.pow(F.lit(2.0), "bit")).cast("bigint").alias("bits"))
