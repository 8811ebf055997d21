"""Leaf directory: feature rows in leaves of bounded size, found through a tree of boxes.

The rows are split level by level, each node along the feature in which it is
widest (between its outer quantiles), at quantiles of that feature (``FAN`` parts at most; at the middle where
quantiles cannot part it).  A node of at most ``leaf_rows`` rows, or of one
feature point, is a leaf, so leaves stay that small whatever the number of rows;
the number of levels follows its logarithm.  While nodes have more than ``BLOCK``
rows, a level is one partial + final aggregation by node, and rows learn their node
by a join with the level's cuts (broadcast while they are few, else shuffled).  Below
that, the rows of a node are in one task, which splits them by their ranks.

The directory is one table keyed by (g, level, path): each inner node has a row
with its cuts, its children's boxes and their row counts by tag.  A node's path is its
parent's and its number, so no path needs more than the table itself.

``candidates`` gathers query points into small cells (``_cells``) and walks the
cells' boxes down the levels.  At each, the least radius within which whole boxes
hold k rows bounds the answer, and only boxes that come within it are opened; of
the leaves a cell ends with, its points of one leaf keep those within their radius as
a box, and of these few each point those within its own.  So a cell sees a few nodes of each level, and a point no row of another leaf.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisa.session import cut_lineage

FAN = 32
#: Nodes of a level up to which their cuts or children are broadcast (some 1 KB each).
SMALL_NODES = 1 << 14
#: Relative error of the quantiles is 1 / ACCURACY; a node that comes out too large is split again.
ACCURACY = 400
#: Rows of a node that one task splits further, and the levels that are split before it is looked what is left.
BLOCK = 1 << 15
LEVELS_AT_ONCE = 2
#: The widest feature between the outer quantiles, so that a few stragglers do not hide where the rows are; else over all.
WIDEST = "CAST(IF(array_max(inner) > 0, array_position(inner, array_max(inner)), array_position(wide, array_max(wide))) AS INT)"
#: Neighbouring leaves whose points are walked together, as one cell.
SLAB = 16
EPS = 1e-9


@dataclass
class Directory:
    """``rows``: g, t, c0.. and what they carry, with their leaf's path; ``nodes``: g, level, path, children."""

    rows: DataFrame
    nodes: DataFrame
    dims: int
    sizes: list[int]  # inner nodes of each level

    def save(self, path: str) -> None:
        """Rows grouped by leaf, nodes, and (last) the small table that makes the directory readable."""
        spark = self.rows.sparkSession
        self.rows.repartition("g", "path").sortWithinPartitions("g", "path").write.parquet(f"{path}/rows")
        self.nodes.write.parquet(f"{path}/nodes")
        spark.createDataFrame([(self.dims, list(self.sizes))], "dims int, sizes array<int>").coalesce(1).write.parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Directory:
        about = spark.read.parquet(f"{path}/about").first()
        return Directory(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/nodes"), about.dims, list(about.sizes))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= SMALL_NODES else df


def _parts(n: str, most: str) -> str:
    """SQL: 4, 8, ... FAN parts of n rows, twice as many as parts of at most ``most`` rows are wanted, so that uneven parts need no further level."""
    return f"CAST(least({FAN}, pow(2, ceil(log2({n} / {most})) + 1)) AS INT)"


def _cuts(open_rows: DataFrame, dims: int, most: int) -> DataFrame:
    """(g, path, dim, cuts) of the nodes of more than ``most`` rows."""
    every = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(dims):
        aggs += [F.min(f"c{i}").alias(f"lo{i}"), F.max(f"c{i}").alias(f"hi{i}"), F.percentile_approx(f"c{i}", every, ACCURACY).alias(f"q{i}")]
    nodes = open_rows.groupBy("g", "path").agg(*aggs)
    of = lambda name: "array(" + ", ".join(f"{name}{i}" for i in range(dims)) + ")"
    nodes = nodes.withColumn("wide", F.expr("array(" + ", ".join(f"hi{i} / 2 - lo{i} / 2" for i in range(dims)) + ")"))
    nodes = nodes.filter((F.col("n") > most) & (F.array_max("wide") > 0))
    nodes = nodes.withColumn("inner", F.expr("array(" + ", ".join(f"q{i}[{FAN - 2}] / 2 - q{i}[0] / 2" for i in range(dims)) + ")"))
    nodes = nodes.withColumn("dim", F.expr(WIDEST))
    nodes = nodes.select("g", "path", "dim", "n", *(F.expr(f"element_at({of(c)}, dim)").alias(c) for c in ("lo", "hi", "q")))
    nodes = nodes.withColumn("parts", F.expr(_parts("n", str(most))))
    cuts = F.expr(f"array_sort(array_distinct(filter(q, (x, i) -> (i + 1) % ({FAN} DIV parts) = 0 AND x < hi)))")
    middle = F.expr("IF(lo / 2 + hi / 2 < hi, greatest(lo, lo / 2 + hi / 2), lo)")
    return nodes.select("g", "path", "dim", F.when(F.size(cuts) > 0, cuts).otherwise(F.array(middle)).alias("cuts"))


def _split(rows: DataFrame, dims: int, leaf_rows: int) -> DataFrame:
    """One level further for every node of more than ``leaf_rows`` rows, by the ranks of its rows within its block.

    Rows of one value have one rank, so they stay together; the greatest value goes to the last part and the least to
    the first, so a node of more than one point always splits.
    """
    every, plain = range(dims), rows.columns
    node = Window.partitionBy("g", "block", "path")
    for i in every:
        rows = rows.withColumn(f"rank{i}", F.rank().over(node.orderBy(f"c{i}")))
    rows = rows.select("*", F.count(F.lit(1)).over(node).alias("n"), *(f(f"c{i}").over(node).alias(f"{o}{i}") for i in every for f, o in ((F.min, "lo"), (F.max, "hi"))))
    # the least value of the last part and the greatest of the first: the outer quantiles
    outer = [f"max(IF(rank{i} <= n / {FAN}, c{i}, lo{i}))" for i in every], [f"max(IF(rank{i} <= n - n / {FAN}, c{i}, lo{i}))" for i in every]
    rows = rows.select("*", *(F.expr(x).over(node).alias(f"{o}{i}") for o, xs in zip(("p", "q"), outer) for i, x in enumerate(xs)))
    wide = "array(" + ", ".join(f"hi{i} / 2 - lo{i} / 2" for i in every) + ")"
    inner = "array(" + ", ".join(f"q{i} / 2 - p{i} / 2" for i in every) + ")"
    rows = rows.withColumn("wide", F.expr(wide)).withColumn("inner", F.expr(inner)).withColumn("dim", F.expr(WIDEST))
    of = lambda name: "element_at(array(" + ", ".join(f"{name}{i}" for i in every) + "), dim)"
    part = F.expr(f"IF({of('c')} = {of('hi')}, parts - 1, CAST(floor(({of('rank')} - 1) * parts / n) AS INT))")
    rows = rows.withColumn("parts", F.expr(_parts("n", str(leaf_rows)))).withColumn("part", part)
    more = (F.col("n") > leaf_rows) & (F.array_max("wide") > 0)
    return rows.withColumn("path", F.when(more, F.concat_ws(".", "path", F.col("part").cast("string"))).otherwise(F.col("path"))) \
               .withColumn("dims", F.when(more, F.concat("dims", F.array("dim"))).otherwise(F.col("dims"))).select(*plain)


def build(points: DataFrame, dims: int, leaf_rows: int) -> Directory:
    """Directory of ``points``: g, t (tag), c0..c<dims - 1> (finite doubles), and other columns to carry."""
    # few bytes, but much work for each: as many files as tasks, so that every level is read by all cores
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # what is carried is one column, so that none of its names can meet one used here
    shape = ["g", "t", *(f"c{i}" for i in range(dims))]
    carried = [c for c in points.columns if c not in shape]
    rows = points.select(*shape, *([F.struct(*carried).alias("kept")] if carried else []))
    plain = [F.col(c) if c in shape else F.col("kept").getField(c).alias(c) for c in points.columns] + [F.col("path")]
    rows = rows.withColumn("path", F.lit("")).withColumn("dims", F.expr("CAST(array() AS ARRAY<INT>)")).withColumn("open", F.lit(True))
    rows = cut_lineage(rows.repartition(tasks))
    block = max(BLOCK, leaf_rows)
    value = F.element_at(F.array(*[F.col(f"c{i}") for i in range(dims)]), F.col("dim"))
    while not rows.filter("open").groupBy("g", "path").count().filter(F.col("count") > block).isEmpty():
        cuts = cut_lineage(_cuts(rows.filter("open"), dims, block))
        n = cuts.count()
        if n == 0:
            break
        rows = rows.drop("open").join(_small(cuts, n), ["g", "path"], "left").withColumn("open", F.col("cuts").isNotNull())
        rows = rows.withColumn("value", value)
        down = F.concat("path", F.lit("."), F.expr("size(filter(cuts, c -> c < value))").cast("string"))
        rows = rows.withColumn("path", F.when(F.col("open"), down).otherwise(F.col("path")))
        rows = rows.withColumn("dims", F.when(F.col("open"), F.concat("dims", F.array("dim"))).otherwise(F.col("dims"))).drop("dim", "cuts", "value")
        if n > SMALL_NODES:
            rows = cut_lineage(rows)
    # what is small enough for a task is split there: its rows stay where they are, level after level
    rows = rows.drop("open").withColumn("block", F.col("path")).repartition(tasks, "g", "block")
    while True:
        for _ in range(LEVELS_AT_ONCE):
            rows = _split(rows, dims, leaf_rows)
        rows = cut_lineage(rows)
        one = functools.reduce(lambda a, b: a & b, [F.min(f"c{i}") == F.max(f"c{i}") for i in range(dims)])
        nodes = rows.groupBy("g", "path").agg(F.count(F.lit(1)).alias("n"), one.alias("one"), F.max(F.size("dims")).alias("depth"))
        at = nodes.agg(F.count_if((F.col("n") > leaf_rows) & ~F.col("one")).alias("open"), F.max("depth").alias("depth")).first()
        if not at.open:
            break
        rows = rows.repartition(tasks, "g", "block")
    nodes = _directory(rows, dims, at.depth or 0)
    by_level = nodes.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_level.agg(F.array_sort(F.collect_list(F.struct("level", "n"))).alias("all")).first()["all"]
    return Directory(rows.select(*plain), nodes, dims, [x.n for x in sizes])


def _directory(rows: DataFrame, dims: int, depth: int) -> DataFrame:
    every = range(dims)
    merged = [F.first("dims").alias("dims"), F.sum("n").alias("n"), *(F.min(f"lo{i}").alias(f"lo{i}") for i in every), *(F.max(f"hi{i}").alias(f"hi{i}") for i in every)]
    # each level below reads the same exchange of this aggregation
    cells = rows.groupBy("g", "path", "t").agg(F.first("dims").alias("dims"), F.count(F.lit(1)).alias("n"), *(F.min(f"c{i}").alias(f"lo{i}") for i in every),
                                               *(F.max(f"c{i}").alias(f"hi{i}") for i in every))
    cells = cells.withColumn("leaf", F.lit(True)).withColumn("depth", F.size("dims"))
    box = F.struct("path", "leaf", F.array(*(F.col(f"lo{i}") for i in every)).alias("lo"), F.array(*(F.col(f"hi{i}") for i in every)).alias("hi"), "tags")
    whole = [F.first("dims").alias("dims")] + [F.min(f"lo{i}").alias(f"lo{i}") for i in every] + [F.max(f"hi{i}").alias(f"hi{i}") for i in every] + [F.collect_list(F.struct("t", "n")).alias("tags")]
    out, below = None, None
    for at in range(depth - 1, -1, -1):
        kids = cells.filter(F.col("depth") == at + 1).drop("depth")
        kids = kids if below is None else kids.unionByName(below)
        parent = F.substring_index("path", ".", at + 1)
        boxes = kids.groupBy("g", "path", "leaf").agg(*whole).select("g", parent.alias("parent"), F.col("dims")[at].alias("dim"), box.alias("box"))
        mine = boxes.groupBy("g", F.col("parent").alias("path")).agg(F.first("dim").alias("dim"), F.collect_list("box").alias("children")).withColumn("level", F.lit(at))
        out = mine if out is None else out.unionByName(mine)
        below = kids.groupBy("g", parent.alias("path"), "t").agg(*merged).withColumn("leaf", F.lit(False))
    if out is None:
        kind = rows.schema["g"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"g {kind}, path string, dim int, children array<struct<path:string>>, level int, cuts array<double>")
    # rows of part j lie above those of the parts before it, so the greatest of these are the cuts (numbers may be left out)
    number = "CAST(substring_index(x.path, '.', -1) AS INT)"
    cuts = f"""transform(sequence(0, array_max(transform(children, x -> {number})) - 1), j ->
        array_max(transform(filter(children, x -> {number} <= j), x -> element_at(x.hi, dim))))"""
    return cut_lineage(out.withColumn("cuts", F.expr(cuts)))


def _cells(directory: Directory, asked: DataFrame) -> tuple[DataFrame, list[str]]:
    """``asked`` with the columns that say in which cell a point lies, their names, and the leaf it would be in (``own``).

    A point goes down the cuts to its leaf.  ``SLAB`` neighbouring leaves of a node have one box, if it is about as
    wide as their rows are dense (else each has its own); beside the box, cells are as wide as that box is (at least half
    an even share of the node's), so points of a cell lie as near each other as the rows of a few leaves.
    """
    every = range(directory.dims)
    value = F.element_at(F.array(*[F.col(f"q{i}") for i in every]), F.col("dim"))
    state = asked.withColumn("home", F.lit(""))
    for at, size in enumerate(directory.sizes):
        level = _small(directory.nodes.filter(F.col("level") == at).select("g", F.col("path").alias("home"), "dim", "cuts"), size)
        state = state.join(level, ["g", "home"], "left").withColumn("value", value)
        down = F.concat("home", F.lit("."), F.expr("size(filter(cuts, c -> c < value))").cast("string"))
        state = state.withColumn("home", F.when(F.col("cuts").isNotNull(), down).otherwise(F.col("home"))).drop("dim", "cuts", "value")
    share = ", ".join(f"(array_max(transform(children, x -> x.hi[{i}])) - array_min(transform(children, x -> x.lo[{i}]))) / (2 * size(children))" for i in every)
    usual = ", ".join(f"array_sort(transform(filter(children, x -> x.leaf), x -> x.hi[{i}] - x.lo[{i}]))[size(filter(children, x -> x.leaf)) DIV 2]" for i in every)
    leaf = directory.nodes.select("g", F.col("path").alias("node"), F.explode("children").alias("b"), F.expr(f"greatest({share}, 0D)").alias("share"),
                                  F.expr(f"array({usual})").alias("usual")).filter("b.leaf")
    slab = Window.partitionBy("g", "node", F.expr(f"CAST(substring_index(b.path, '.', -1) AS INT) DIV {SLAB}"))
    leaf = leaf.select("g", "node", "b", "share", "usual", F.min("b.path").over(slab).alias("first"),
                       F.array(*(F.min(F.col("b.lo")[i]).over(slab) for i in every)).alias("lo"), F.array(*(F.max(F.col("b.hi")[i]).over(slab) for i in every)).alias("hi"))
    # an outlier or a gap among the leaves would make a box that has nothing to do with where its points lie
    dense = F.expr(" AND ".join(f"hi[{i}] - lo[{i}] <= {2 * SLAB} * usual[{i}]" for i in every))
    leaf = leaf.select("g", "share", F.col("b.path").alias("home"), *(F.when(dense, F.col(c)).otherwise(F.col(f"b.{o}")).alias(c) for c, o in (("first", "path"), ("lo", "lo"), ("hi", "hi"))))
    leaf = leaf.withColumn("unit", F.expr("greatest(" + ", ".join(f"hi[{i}] - lo[{i}]" for i in every) + ", share)"))
    state = state.join(_small(leaf, sum(directory.sizes)), ["g", "home"], "left").withColumn("own", F.col("home")).withColumn("home", F.coalesce("first", "home"))
    beside = [F.expr(f"q{i} - greatest(least(q{i}, hi[{i}]), lo[{i}])") for i in every]
    names = [f"o{i}" for i in every]
    cell = [F.when(F.col("lo").isNull(), F.lit(0.0)).when(F.col("unit") > 0, F.rint(b / F.col("unit"))).otherwise(b) + F.lit(0.0) for b in beside]
    return state.select(*asked.columns, "own", "home", *(c.alias(n) for c, n in zip(cell, names))), ["g", "qt", "home", *names]


def candidates(directory: Directory, asked: DataFrame, k: int, may: str) -> DataFrame:
    """``asked`` (g, qt, q0.., each point once) with the ``path`` of every leaf that may hold one of its k nearest
    rows, and ``r``: the squared distance within which they lie.

    ``may`` is SQL over a row's tag {t} and the query's tag {q}.
    """
    every = range(directory.dims)
    if not directory.sizes:
        return asked.withColumn("path", F.lit("")).withColumn("r", F.lit(float("inf")))
    # a walk costs far more than its few bytes tell: a fixed number of tasks, that are not merged by size
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points, cell = _cells(directory, asked)
    points = cut_lineage(points).repartition(tasks, *cell)
    total = lambda parts: " + ".join(f"pow({x}, 2)" for x in parts)
    # between a box of points (a0.. to z0..) and a box of rows; and between a point and a box of rows
    far = total(f"greatest(abs(z{i} - b.lo[{i}]), abs(b.hi[{i}] - a{i}))" for i in every)
    near = total(f"greatest(b.lo[{i}] - z{i}, a{i} - b.hi[{i}], 0D)" for i in every)
    seen = f"""filter(transform(children, b -> named_struct('far', {far},
        'n', aggregate(b.tags, 0L, (s, e) -> s + IF({may.format(t='e.t', q='qt')}, e.n, 0L)),
        'near', {near}, 'leaf', b.leaf, 'path', b.path, 'lo', b.lo, 'hi', b.hi)), x -> x.n > 0)"""
    fewer = f"transform(done, b -> named_struct('far', coalesce({far}, double('infinity')), 'n', b.n, 'near', {near}, 'path', b.path, 'lo', b.lo, 'hi', b.hi))"
    far = total(f"greatest(abs(q{i} - b.lo[{i}]), abs(q{i} - b.hi[{i}]))" for i in every)
    near = total(f"greatest(b.lo[{i}] - q{i}, q{i} - b.hi[{i}], 0D)" for i in every)
    mine = f"transform(done, b -> named_struct('far', coalesce({far}, double('infinity')), 'n', b.n, 'near', {near}, 'path', b.path))"
    # the radius is bound by a lambda: as a column it would be put into the filter and worked out for each box
    within = f"""transform(array(aggregate(sort_array(seen), named_struct('n', 0L, 'r', 0D), (s, x) ->
        IF(s.n >= {int(k)}, s, named_struct('n', s.n + x.n, 'r', x.far)), s -> s.r)), r ->
        named_struct('r', r, 'boxes', filter(seen, x -> x.near <= r * (1 + {EPS}))))[0]"""
    node = "array<struct<far:double,n:bigint,near:double,leaf:boolean,path:string,lo:array<double>,hi:array<double>>>"
    keys = [*cell, *(f"a{i}" for i in every), *(f"z{i}" for i in every)]
    state = points.groupBy(*cell).agg(*(F.min(f"q{i}").alias(f"a{i}") for i in every), *(F.max(f"q{i}").alias(f"z{i}") for i in every))
    for at, size in enumerate(directory.sizes):
        level = _small(directory.nodes.filter(F.col("level") == at).select("g", "path", "children"), size)
        if at == 0:
            # a group whose root is a leaf has no row here: its one leaf is the root
            state = state.join(level.drop("path"), "g", "left")
            root = F.expr(f"CAST(array(named_struct('far', double('infinity'), 'n', 0L, 'near', 0D, 'leaf', true, 'path', '', 'lo', null, 'hi', null)) AS {node})")
            state = state.select(*keys, F.when(F.col("children").isNull(), root).otherwise(F.expr(seen).cast(node)).alias("seen"))
        else:
            one = state.select(*keys, "done", F.explode_outer("open").alias("path")).join(level, ["g", "path"], "left")
            one = one.withColumn("more", F.when(F.col("children").isNull(), F.expr(f"CAST(array() AS {node})")).otherwise(F.expr(seen).cast(node)))
            state = one.groupBy(*keys).agg(F.first("done").alias("done"), F.flatten(F.collect_list("more")).alias("more"))
            state = state.select(*keys, F.concat("done", "more").alias("seen"))
        state = state.select(*keys, F.explode(F.array(F.expr(within))).alias("found"))
        state = state.select(*keys, F.expr("filter(found.boxes, x -> x.leaf)").alias("done"),
                             F.expr("transform(filter(found.boxes, x -> NOT x.leaf), x -> x.path)").alias("open"))
    # a cell of several leaves ends with many: its points by leaf are boxes that are left with a few, and each point has its own radius among these
    part = [*cell, "own"]
    points = points.repartition(tasks, *part)
    boxes = points.groupBy(*part).agg(*(F.min(f"q{i}").alias(f"a{i}") for i in every), *(F.max(f"q{i}").alias(f"z{i}") for i in every))
    boxes = boxes.join(state.select(*cell, "done"), cell).repartition(tasks, *part).withColumn("seen", F.expr(fewer))
    boxes = boxes.select(*part, F.explode(F.array(F.expr(within))).alias("found")).select(*part, F.col("found.boxes").alias("done"))
    met = points.join(boxes, part).select(*asked.columns, F.expr(mine).alias("seen"))
    met = met.select(*asked.columns, F.explode(F.array(F.expr(within))).alias("found"))
    met = met.select(*asked.columns, F.col("found.r").alias("r"), F.explode(F.expr("transform(found.boxes, x -> x.path)")).alias("path"))
    return met.repartition(tasks, "g", "path")
